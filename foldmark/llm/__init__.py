"""Operators of a training-data pipeline: sharding, search, cleaning, deduplication, packing, token files."""
