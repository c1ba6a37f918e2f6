"""Operators of a training-data pipeline: packing, filtering, near-duplicates, formatting, token files."""
