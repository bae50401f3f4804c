"""Incremental form of the Bronze ingest."""
