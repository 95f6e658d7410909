"""Structured Streaming forms of the daily refresh."""
