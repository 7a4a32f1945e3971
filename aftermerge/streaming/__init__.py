"""Structured Streaming forms of the census operators."""
