"""Operators for training-data corpora: deduplication, filters, tokenizing, mixing, search."""
