"""Batch operators: DataFrames in, one DataFrame out."""
