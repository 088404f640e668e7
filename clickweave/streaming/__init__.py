"""Structured Streaming forms of the hourly window."""
