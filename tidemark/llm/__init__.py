"""Operators for building training data: filters, deduplication, archives, search, packing."""
