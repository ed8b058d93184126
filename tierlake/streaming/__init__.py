"""Structured Streaming forms of landing and quality checks."""
