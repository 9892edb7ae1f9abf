"""Structured Streaming: replay, live scoring and live windows."""
