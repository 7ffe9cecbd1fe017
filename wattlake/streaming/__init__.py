"""Incremental arrival with Structured Streaming."""
