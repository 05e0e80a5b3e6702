"""Structured Streaming versions of cleaning and scoring."""
