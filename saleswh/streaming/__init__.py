"""Structured Streaming runners (file ingest, foreachBatch silver jobs)."""
