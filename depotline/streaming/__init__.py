"""Incremental form of the batch operators."""
