"""Structured Streaming variants (the reference has no streams; its only
natural streaming edge is incremental file ingest, S7)."""
