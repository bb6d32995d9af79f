"""Incremental, resumable ingest with Structured Streaming."""
