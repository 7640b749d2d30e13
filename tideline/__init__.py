"""Tideline: change-event analytics on Spark DataFrames and Structured Streaming."""
