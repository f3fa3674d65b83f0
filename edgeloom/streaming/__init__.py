"""Structured Streaming forms of the recurring jobs."""
