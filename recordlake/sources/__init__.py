"""Scans: CSV drops, parquet batches, captured pages, driver tables."""
