"""Incremental loads as micro-batches."""
