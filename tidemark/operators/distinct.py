"""Distinct visitors per window: exact, hash-bitmap, HLL sketch, running."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.hashing import BITMAP_BITS, bitmap_offset
from tidemark.functions.time import duration_us, to_micros, ts_type_of
from tidemark.operators.sequence import time_bucket
from tidemark.operators.windows import window_end_col


def _end(df, ts, size):
    return window_end_col(ts, duration_us(size), ts_type_of(df, ts)).alias("window_end")


def uv_exact(df: DataFrame, user: str = "user_id", ts: str = "ts", size="1 hour",
             out: str = "uv") -> DataFrame:
    """Exact distinct users per tumbling window.  Planned as two
    aggregations (dedup on (window, user) with partial aggregation, then a
    count per window), so no window's user set is held in one place."""
    return df.groupBy(_end(df, ts, size)).agg(F.count_distinct(user).alias(out))


def uv_bitmap(df: DataFrame, user: str = "user_id", ts: str = "ts", size="1 hour",
              bits: int = BITMAP_BITS, out: str = "uv", method: str = "distinct") -> DataFrame:
    """Distinct bitmap offsets per window: what a single-hash bitmap of
    ``2**bits`` bits counts (ids colliding on an offset count once).

    ``method="distinct"``: distinct count of offsets.  ``method="bitmaps"``:
    Spark's bitmap aggregates: one fixed-size bitmap per (window, offset
    bucket) built with ``bitmap_construct_agg`` (mergeable partial
    aggregates), ``bitmap_count`` per bucket, summed per window; memory
    per group is bounded by the bucket bitmap, never by the user count.
    """
    offs = df.select(_end(df, ts, size), bitmap_offset(user, bits).alias("_off"))
    if method == "distinct":
        return offs.groupBy("window_end").agg(F.count_distinct("_off").alias(out))
    # one row per (window, offset) first: sparse ids then fill no partial bitmap per task
    per_bucket = (offs.distinct().groupBy("window_end", F.bitmap_bucket_number("_off").alias("_bk"))
                  .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_off"))).alias("_n")))
    return per_bucket.groupBy("window_end").agg(F.sum("_n").cast("bigint").alias(out))


def uv_hll(df: DataFrame, user: str = "user_id", ts: str = "ts", size="1 hour",
           rsd: float = 0.01, out: str = "uv") -> DataFrame:
    """Approximate distinct users (HyperLogLog++), fixed memory per window."""
    return df.groupBy(_end(df, ts, size)).agg(
        F.approx_count_distinct(user, rsd).alias(out))


def uv_sketches(df: DataFrame, user: str = "user_id", ts: str = "ts", size="1 hour",
                lg_k: int = 12) -> DataFrame:
    """Mergeable HLL sketch per window (binary), to roll hours into days
    with ``hll_union_agg`` without re-reading rows."""
    return df.groupBy(_end(df, ts, size)).agg(F.hll_sketch_agg(user, lg_k).alias("sketch"))


def uv_running(df: DataFrame, user: str = "user_id", ts: str = "ts", seq: str = "seq",
               size="1 hour", out: str = "uv", sub_bucket="1 minute",
               distinct_on: str = "user", bits: int = BITMAP_BITS) -> DataFrame:
    """One row per input row: distinct users of its window seen so far
    (inclusive), in ``(ts, seq)`` order.  ``distinct_on="bitmap"`` counts
    distinct bitmap offsets instead (what a running single-hash bitmap
    reports: ids colliding on an offset count once).

    First sightings come from an aggregation (min ``(ts, seq)`` per
    (window, user), partial aggregation absorbs hot users).  They are
    unioned into the rows as ``+1`` markers ordered just before the row
    they mark, and each sub-bucket of a window starts with one marker for all
    sightings in earlier ones; a prefix sum per (window, sub-bucket) counts up to
    each row.  Rows are shuffled once, and not joined.
    """
    d = df.withColumn("window_end", _end(df, ts, size))
    ident = user
    if distinct_on == "bitmap":
        d = d.withColumn("_off", bitmap_offset(user, bits))
        ident = "_off"
    one = F.lit(1).cast("bigint").alias("_v")
    firsts = (d.groupBy("window_end", ident)
              .agg(F.min(F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"))).alias("_f"))
              .select("window_end", F.col("_f.t").alias("_t"), (F.col("_f.s") * 2).alias("_o"), one)
              .withColumn("_b", time_bucket("_t", sub_bucket)))
    # sightings up to each sub-bucket that has some, handed to the sub-buckets after it up to the next
    w = Window.partitionBy("window_end").orderBy("_b")
    last = F.floor((to_micros("window_end") - 1) / F.lit(duration_us(sub_bucket))).cast("bigint")
    per = firsts.groupBy("window_end", "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = per.select("window_end", "_b", F.lead("_b").over(w).alias("_nb"),
                      F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_v"))
    begins = F.col("_b") + 1
    ends = F.coalesce("_nb", last)
    carried = upto.where(begins <= ends).select("window_end", F.explode(F.sequence(begins, ends)).alias("_b"), "_v")
    rows = d.drop("_off").withColumns({"_t": F.col(ts), "_o": F.col(seq) * 2 + 1, "_v": F.lit(0).cast("bigint"),
                                       "_b": time_bucket(ts, sub_bucket), "_row": F.lit(1)})
    marks = firsts.withColumn("_row", F.lit(0)).unionByName(
        carried.withColumn("_row", F.lit(-1)), allowMissingColumns=True)
    u = rows.unionByName(marks, allowMissingColumns=True)
    # the carried count first, then rows by time and order, a marker just before its row
    order = Window.partitionBy("window_end", "_b").orderBy(
        F.col("_row") >= 0, "_t", "_o").rowsBetween(Window.unboundedPreceding, 0)
    return (u.withColumn(out, F.sum("_v").over(order)).where(F.col("_row") == 1)
            .drop("_t", "_o", "_v", "_b", "_row"))


def uv_rollup(sketches: DataFrame, size="1 day", out: str = "uv") -> DataFrame:
    """Roll per-window HLL sketches (``uv_sketches``) up to longer tumbling
    windows by sketch union, without re-reading rows."""
    ntz = ts_type_of(sketches, "window_end")
    # a window ending at e holds instants up to e - 1 microsecond
    last = (F.col("window_end") - F.expr("INTERVAL 1 MICROSECONDS")).alias("_last")
    return (sketches.select(last, "sketch")
            .select(window_end_col("_last", duration_us(size), ntz).alias("window_end"), "sketch")
            .groupBy("window_end").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out)))
