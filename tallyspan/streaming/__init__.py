"""Structured Streaming versions of the period operators."""
