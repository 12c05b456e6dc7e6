"""Incremental ingest of file datasets with Structured Streaming."""

from tidemark.streaming.ingest import ingest_new_files

__all__ = ["ingest_new_files"]
