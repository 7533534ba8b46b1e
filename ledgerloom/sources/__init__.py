"""Batch sources: tables, landed files, documents."""

from ledgerloom.sources.documents import documents_from_tables, read_documents
from ledgerloom.sources.files import landing_files, read_bronze, read_table

__all__ = ["documents_from_tables", "landing_files", "read_bronze", "read_documents", "read_table"]
