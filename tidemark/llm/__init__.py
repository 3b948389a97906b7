"""Operators for training-data pipelines: extraction, filtering, deduplication, tokenising and packing."""
