"""Batch/streaming DataFrame operators."""
