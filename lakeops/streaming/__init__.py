"""Structured Streaming forms of batch jobs."""
