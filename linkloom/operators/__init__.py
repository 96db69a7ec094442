"""Operators on DataFrames: predicates, extraction, compaction, lookup, catalog, rate limits."""
