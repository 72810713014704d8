"""Sinks: versioned parquet tables, batch files, keyed upsert."""
