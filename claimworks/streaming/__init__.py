"""Event ingest with Structured Streaming."""
