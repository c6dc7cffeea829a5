"""Incremental arrival of monthly slice files (ST1)."""

from cabflow.streaming.ingest import arrivals, ingest_available  # noqa: F401
