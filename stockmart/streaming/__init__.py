"""Incremental loads from a stream of stock transactions."""
