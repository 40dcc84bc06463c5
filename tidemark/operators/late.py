"""Late data: per-row watermarks over arrival order.

A watermark ``wm`` seen by a row is the max event time of the rows that
arrived before it minus the disorder bound.  A window is closed for a row
once ``end - 1 ms + lateness <= wm``; a row is *late* when every window it
belongs to is closed (it would go to the late side output), and it is
counted only in windows still open for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.time import duration_us, interval, to_micros, ts_type_of
from tidemark.operators.sequence import bucket_maxima, order_buckets, rejoin, running_max_before
from tidemark.operators.windows import sweep_ranges, window_end_col

ONE_MS = "1 millisecond"
# A table of arrival buckets up to this long (two years of minutes) is broadcast; a longer one is joined.
BROADCAST_BUCKETS = 1 << 20


def latest_window_end(ts: str, size, slide, ntz: bool) -> F.Column:
    """End of the last window that holds ``ts``: it starts at the latest slide up to ``ts``."""
    pane_end = window_end_col(ts, duration_us(slide or size), ntz)
    return pane_end + F.expr(f"INTERVAL {duration_us(size) - duration_us(slide or size)} MICROSECONDS")


def with_row_watermark(df: DataFrame, ts: str = "ts", arrival: str = "arrival", seq: str = "seq",
                       disorder="2 seconds", out: str = "wm", bucket="1 second") -> DataFrame:
    d = running_max_before(df, arrival, seq, ts, "_maxts", bucket)
    return d.withColumn(out, F.col("_maxts") - interval(disorder)).drop("_maxts")


def _floor_div(c: F.Column, by: int) -> F.Column:
    """Whole-number division of microseconds, rounded down."""
    return F.call_function("div", c - F.pmod(c, F.lit(by)), F.lit(by))


def _row_windows(ts: str, size_us: int, slide_us: int) -> tuple[F.Column, F.Column]:
    """Numbers of the first and last window that hold ``ts``; window i starts at ``i * slide``."""
    m = to_micros(ts)

    return _floor_div(m - F.lit(size_us), slide_us) + 1, _floor_div(m, slide_us)


def with_newest_closed(df: DataFrame, ts: str = "ts", arrival: str = "arrival", seq: str = "seq",
                       size="10 minutes", slide=None, disorder="2 seconds", lateness="60 seconds",
                       out: str = "newest_closed", bucket="1 minute") -> DataFrame:
    """Add ``out``: the number of the newest window closed when the row arrived, kept to the row's
    own windows (one less than its first where none of them is closed).  NULL for rows without a time;
    rows without an arrival come before all others.

    A bucket's rows see watermarks between that of its first arrival and that of its end
    (one row a bucket; how many there can be at most is looked up first, by the span of the
    arrivals, and short tables are broadcast).  Where both close the same windows of a row, that is its
    answer, in a map over the scan; the other rows are ordered within the bucket, together with
    those that carry the watermark over a closing.
    """
    size_us, slide_us = duration_us(size), duration_us(slide or size)
    shift = duration_us(ONE_MS) - duration_us(lateness) - size_us - duration_us(disorder)

    def closed(newest: F.Column) -> F.Column:
        """The newest window closed once ``newest`` is the greatest time seen."""
        return _floor_div(newest + F.lit(shift), slide_us)
    d = order_buckets(df, arrival, bucket)
    bounds = bucket_maxima(d, ts).select(
        "_b", closed(to_micros("_carry")).alias("_from"),
        closed(to_micros(F.greatest("_carry", "_bm"))).alias("_to"))
    span = d.agg(F.max("_b") - F.min("_b")).first()[0]
    if span is None or span + 2 <= BROADCAST_BUCKETS:   # no more buckets than that, one for no arrival
        bounds = F.broadcast(bounds)
    first, last = _row_windows(ts, size_us, slide_us)

    def own(newest: F.Column) -> F.Column:
        return F.when(F.col(ts).isNotNull(), F.greatest(F.least(newest, last), first - 1))
    least, most = own(F.coalesce("_from", first - 1)), own(F.coalesce("_to", first - 1))
    d = rejoin(d.drop("_c"), bounds, ["_b"])
    settled = least.eqNullSafe(most)
    raises = F.coalesce(closed(to_micros(ts)) > F.col("_from"), F.col(ts).isNotNull())
    before = Window.partitionBy("_b").orderBy(arrival, seq).rowsBetween(Window.unboundedPreceding, -1)
    ordered = (d.where(~settled | (raises & (~F.col("_from").eqNullSafe(F.col("_to")))))
               .withColumn("_in", F.max(closed(to_micros(ts))).over(before)).where(~settled)
               .withColumn(out, own(F.coalesce(F.greatest("_in", "_from"), first - 1))).drop("_in"))
    return d.where(settled).withColumn(out, least).unionByName(ordered).drop("_b", "_from", "_to")


def split_late(df: DataFrame, ts: str = "ts", arrival: str = "arrival", seq: str = "seq",
               size="10 minutes", slide=None, disorder="2 seconds", lateness="60 seconds",
               bucket="1 minute") -> DataFrame:
    """Add ``is_late``: all of the row's windows were closed when it
    arrived.  For sliding windows the last window (the latest end) decides."""
    d = with_newest_closed(df, ts, arrival, seq, size, slide, disorder, lateness, "_closed", bucket)
    return d.withColumn("is_late", all_closed(ts, "_closed", size, slide)).drop("_closed")


def all_closed(ts: str, newest_closed: str, size, slide=None) -> F.Column:
    """Whether a row of :func:`with_newest_closed` is late."""
    _, last = _row_windows(ts, duration_us(size), duration_us(slide or size))
    return F.coalesce(F.col(newest_closed) >= last, F.lit(False))


def mark_late(df: DataFrame, ts: str, wm: str, size, slide=None, lateness="60 seconds") -> DataFrame:
    """:func:`split_late` for rows that carry their watermark in column ``wm``,
    e.g. one computed on a wider stream."""
    last_end = latest_window_end(ts, size, slide, ts_type_of(df, ts))
    closed = last_end - interval(ONE_MS) + interval(lateness) <= F.col(wm)
    return df.withColumn("is_late", F.coalesce(closed, F.lit(False)))


def sliding_count_with_lateness(df: DataFrame, key: str, ts: str = "ts", arrival: str = "arrival",
                                seq: str = "seq", size="10 minutes", slide="5 seconds",
                                disorder="1 second", lateness="60 seconds",
                                bucket="1 minute", newest_closed: str | None = None) -> DataFrame:
    """Final (fully refined) count per key and sliding window: each row
    counts in the windows that were still open for it on arrival.

    The closed windows of a row are a prefix of its ``size/slide`` windows
    (they end earliest), so rows are first counted per (key, pane, newest
    closed window) and only those counts are expanded to windows.
    ``newest_closed`` names a column of :func:`with_newest_closed` (same size, slide and lateness)
    computed on a wider stream, e.g. before a filter, as the watermark sees every row.
    """
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    d = df if newest_closed else with_newest_closed(
        df, ts, arrival, seq, size, slide, disorder, lateness, "_closed", bucket)
    _, last = _row_windows(ts, size_us, slide_us)
    pc = (d.select(key, last.alias("_l"), F.col(newest_closed or "_closed").alias("_k"))
          .groupBy(key, "_l", "_k").agg(F.count(F.lit(1)).alias("_n")))

    def end(window):
        return window * F.lit(slide_us) + F.lit(size_us)
    # open windows of a group: those after _k up to _l
    ranges = pc.where(F.col("_k") < F.col("_l")).select(
        key, end(F.col("_k") + 1).alias("_a"), end(F.col("_l") + 1).alias("_z"), "_n")
    return sweep_ranges(ranges, key, slide_us, ts_type_of(df, ts), "cnt")
