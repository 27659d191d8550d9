"""Operators for training-data pipelines: search, deduplication, filtering, mixing, sharding, archives."""
