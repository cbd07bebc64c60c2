"""Operators of a training-data pipeline: packing, search, deduplication, classification."""
