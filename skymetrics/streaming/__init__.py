"""Incremental ingestion of landed daily files with Structured Streaming."""
