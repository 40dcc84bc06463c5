"""Predicate helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pin_filter(pred: Column, ts_col: str) -> Column:
    """A filter that references the event-time column, so that Catalyst does
    not push it below ``withWatermark``.  Without it, the watermark of a
    split stream advances only on the rows that survive the filter."""
    return F.when(F.col(ts_col).isNotNull(), pred).otherwise(F.lit(False))
