"""Feeds derived from given tables, declared flows, and the catalogue of runnable queries."""
