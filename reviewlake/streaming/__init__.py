"""Structured Streaming versions of the daily increments."""
