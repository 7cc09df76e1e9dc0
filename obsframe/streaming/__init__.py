"""Incremental (file-stream) ingestion with the same normalisers as the batch path."""

from obsframe.streaming.ingest import ingest_files

__all__ = ["ingest_files"]
