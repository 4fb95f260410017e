"""Structured Streaming ingest (optional): files -> micro-batches -> merge."""
