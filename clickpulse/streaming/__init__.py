"""Structured Streaming forms of the click operators."""
