"""Operators of a training-data pipeline: filters, near-duplicates, tokens, packing.

Nothing outside this subpackage imports it.  Every operator maps DataFrames to DataFrames;
``queries`` applies each to its whole table and derives the digest columns.
"""
