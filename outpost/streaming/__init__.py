"""Ordered, exactly-once ingestion with Structured Streaming."""
