"""Incremental arrival of records through Structured Streaming."""
