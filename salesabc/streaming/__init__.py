"""Incremental ingestion of landed order pages."""
