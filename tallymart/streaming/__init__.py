"""Incremental ingestion and event-time revenue on Structured Streaming."""
