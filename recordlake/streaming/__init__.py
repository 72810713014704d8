"""Incremental and streaming variants."""
