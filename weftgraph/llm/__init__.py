"""Operators for preparing training text and vectors, on DataFrames of documents."""
