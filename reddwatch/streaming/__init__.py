"""Incremental ingest of landed reports."""
