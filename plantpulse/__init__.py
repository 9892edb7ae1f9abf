"""Predictive-maintenance analytics on Spark DataFrames and Structured Streaming."""
