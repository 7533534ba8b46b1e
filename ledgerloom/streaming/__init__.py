"""Incremental ingest."""

from ledgerloom.streaming.evolving import ingest_evolving, read_evolving
from ledgerloom.streaming.ingest import ingest_files

__all__ = ["ingest_evolving", "ingest_files", "read_evolving"]
