"""Incremental ingest of landed page files (Structured Streaming)."""
from postings_lake.streaming.bronze_stream import LANDED_PAGE_SCHEMA, start_bronze_stream

__all__ = ["LANDED_PAGE_SCHEMA", "start_bronze_stream"]
