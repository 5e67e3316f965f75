"""Structured Streaming ingest and serving."""
