"""Structured Streaming forms of the log operators."""
