"""Incremental landing and scoring with Structured Streaming."""
