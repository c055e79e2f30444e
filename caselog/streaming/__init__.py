"""Incremental landing with Structured Streaming."""
