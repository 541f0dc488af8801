"""Incremental runs of the batch operators."""
