"""Operators for large text corpora: quality, duplicates, personal data, mixing, sharding, tokens."""
