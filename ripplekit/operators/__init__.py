"""Batch operators; each maps DataFrames to a typed DataFrame."""
