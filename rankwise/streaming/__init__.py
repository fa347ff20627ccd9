"""Incremental ingest with Structured Streaming (the reference itself has
no streaming code; see ``ingest_stream``)."""
