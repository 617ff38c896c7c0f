"""Operators of a training-data pipeline over documents, benchmark items and page addresses."""
