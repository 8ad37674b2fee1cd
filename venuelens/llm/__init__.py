"""Operators for preparing text corpora: filters, near-duplicates, counts, mixing and sharding."""
