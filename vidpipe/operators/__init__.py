"""Operators on DataFrames: validation, merging, relations, order, nested data."""
