"""Incremental forms of the embedding and evaluation jobs."""
