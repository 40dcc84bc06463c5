"""Operators of a training-data pipeline: packing, scoring, filtering, dedup, search, extraction."""
