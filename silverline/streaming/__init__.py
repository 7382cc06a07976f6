"""Checkpointed incremental ingest with Structured Streaming."""
