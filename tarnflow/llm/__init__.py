"""Operators for building training data: search, deduplication, extraction, screening, packing."""
