"""Operators on DataFrames: numbering, merging, lookups, quality, paging."""
