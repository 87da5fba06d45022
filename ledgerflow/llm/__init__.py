"""Operators for training-data pipelines: deduplication, classification, mixing, search and packing."""
