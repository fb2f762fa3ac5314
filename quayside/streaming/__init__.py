"""Structured Streaming: file-stream ingestion and the per-batch gold run."""
