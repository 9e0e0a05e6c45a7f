"""Structured Streaming entry points (incremental, exactly-once ingest)."""

from ledgerline.streaming.ingest import csv_stream, ingest_landing

__all__ = ["csv_stream", "ingest_landing"]
