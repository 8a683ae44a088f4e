"""Streaming ingest and its progress."""
