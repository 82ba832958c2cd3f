"""Incremental ingestion of arriving receipt files."""
