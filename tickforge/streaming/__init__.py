"""Structured Streaming forms of the incremental bar jobs."""
