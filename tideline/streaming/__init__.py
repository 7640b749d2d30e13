"""Structured Streaming runs and the tables they feed."""
