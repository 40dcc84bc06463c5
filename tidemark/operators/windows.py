"""Windowed counts: tumbling, sliding (with pane pre-aggregation) and the
two-phase salted count.

Windows are epoch aligned ``[start, end)``; rows are reported by
``window_end``; only non-empty windows appear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.hashing import salt as salt_expr
from tidemark.functions.time import duration_us, from_micros, to_micros, ts_type_of


# Window ends per time chunk of a sweep (``sweep_ranges``).
SWEEP_CHUNK = 4096


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def window_end_col(ts: str, size_us: int, ntz: bool) -> F.Column:
    """End of the tumbling window containing ``ts``."""
    m = to_micros(ts)
    return from_micros(m - F.pmod(m, F.lit(size_us)) + F.lit(size_us), ntz)


def tumbling_count(df: DataFrame, keys, ts: str = "ts", size="1 hour",
                   out: str = "cnt") -> DataFrame:
    """Count per key and tumbling window -> (keys..., window_end, cnt)."""
    keys = _keys(keys)
    ntz = ts_type_of(df, ts)
    end = window_end_col(ts, duration_us(size), ntz).alias("window_end")
    return df.groupBy(*keys, end).agg(F.count(F.lit(1)).alias(out))


def sliding_count(df: DataFrame, keys, ts: str = "ts", size="1 hour", slide="5 minutes",
                  out: str = "cnt", panes: bool | None = None, method: str | None = None) -> DataFrame:
    """Count per key and sliding window -> (keys..., window_end, cnt).

    Pane form (default when size is a multiple of slide): count per slide-wide pane first (map-side partial aggregation, one
    shuffle of pane counts), then expand each *pane count* to the
    ``size/slide`` windows that contain it and sum.  This replaces
    ``rows x size/slide`` expanded rows with ``panes x size/slide``.
    The direct form is Spark's ``window()`` expansion.
    """
    keys = _keys(keys)
    size_us, slide_us = duration_us(size), duration_us(slide)
    ntz = ts_type_of(df, ts)
    fanout, rem = divmod(size_us, slide_us)
    if panes is None:
        panes = rem == 0
    if panes and rem != 0:
        raise ValueError("pane form needs size to be a multiple of slide")
    if method is None:
        method = "sweep" if panes else "direct"
    if method == "sweep":
        return _sweep_count(df, keys, ts, size_us, slide_us, ntz, out)
    if method == "direct" or not panes:
        w = F.window(F.col(ts), f"{size_us} microseconds", f"{slide_us} microseconds")
        return (df.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias(out))
                .select(*keys, F.col("w.end").alias("window_end"), out))
    m = to_micros(ts)
    pane = (m - F.pmod(m, F.lit(slide_us))).alias("pane")
    pc = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("_n"))
    # Pane [p, p+slide) lies in the windows ending at p+slide, ..., p+size.
    ex = (pc.select(*keys, "_n", "pane", F.explode(F.sequence(F.lit(1), F.lit(fanout))).alias("_i"))
          .select(*keys, "_n", (F.col("pane") + F.col("_i").cast("bigint") * F.lit(slide_us)).alias("_end")))
    return (ex.groupBy(*keys, "_end").agg(F.sum("_n").cast("bigint").alias(out))
            .select(*keys, from_micros(F.col("_end"), ntz).alias("window_end"), out))


def salted_count(df: DataFrame, keys, ts: str = "ts", size="1 hour", buckets: int = 8,
                 salt_cols=None, out: str = "cnt") -> DataFrame:
    """Two-phase count for a hot key: count per (salt, key, window), then
    total per (key, window).  ``salt`` is a deterministic hash of
    ``salt_cols`` (default: all columns but ``ts``) into ``buckets``."""
    keys = _keys(keys)
    ntz = ts_type_of(df, ts)
    cols = salt_cols or [c for c in df.columns if c != ts] or [ts]
    end = window_end_col(ts, duration_us(size), ntz).alias("window_end")
    first = df.groupBy(salt_expr(cols, buckets).alias("_salt"), *keys, end).agg(
        F.count(F.lit(1)).alias("_n"))
    return first.groupBy(*keys, "window_end").agg(F.sum("_n").cast("bigint").alias(out))


def _sweep_count(df: DataFrame, keys, ts: str, size_us: int, slide_us: int, ntz: bool,
                 out: str) -> DataFrame:
    """Sliding counts by a sweep over change points: a pane ``[p, p+slide)``
    with ``n`` rows adds ``n`` to the window ends ``p+slide .. p+size``."""
    m = to_micros(ts)
    pane = (m - F.pmod(m, F.lit(slide_us))).alias("_p")
    pc = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("_n"))
    ranges = pc.select(*keys, (F.col("_p") + F.lit(slide_us)).alias("_a"),
                       (F.col("_p") + F.lit(size_us + slide_us)).alias("_z"), "_n")
    return sweep_ranges(ranges, keys, slide_us, ntz, out)


def sweep_ranges(ranges: DataFrame, keys, slide_us: int, ntz: bool, out: str = "cnt") -> DataFrame:
    """Sum weighted ranges of window ends: each row adds ``_n`` to the ends
    ``_a, _a+slide, ..., < _z`` (epoch micros).  Returns one row per key and
    window end with a positive total.

    Ranges are cut at the borders of time chunks (``SWEEP_CHUNK`` ends each),
    so a key's chunks are swept apart, on any number of tasks and with no
    totals carried over.  Each piece becomes two change points (``+n`` at its
    start, ``-n`` at its end); a running sum over a chunk's change points gives
    the total of each stretch of ends, expanded to rows map-side.  Only
    change points are shuffled, never one row per (range, end), and a window
    holds at most ``SWEEP_CHUNK + 1`` of them whatever the row volume.
    """
    keys = _keys(keys)
    width = F.lit(SWEEP_CHUNK * slide_us)

    def chunk(c):
        return c - F.pmod(c, width)
    chunks = F.explode(F.sequence(chunk(F.col("_a")), chunk(F.col("_z") - F.lit(slide_us)), width))
    pieces = ranges.where(F.col("_a") < F.col("_z")).select(*keys, "_a", "_z", "_n", chunks.alias("_ch"))
    deltas = pieces.select(*keys, "_ch", F.explode(F.array(
        F.struct(F.greatest("_a", "_ch").alias("t"), F.col("_n").alias("d")),
        F.struct(F.least(F.col("_z"), F.col("_ch") + width).alias("t"), (-F.col("_n")).alias("d")),
    )).alias("_e")).select(*keys, "_ch", "_e.t", "_e.d")
    # dealt by chunk once, for the sum and for the sweep
    cp = deltas.repartition(*keys, "_ch").groupBy(*keys, "_ch", "t").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*keys, "_ch").orderBy("t")
    runs = cp.select(*keys, "t", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_c"),
                     F.lead("t").over(w).alias("_nt"))
    live = runs.where(F.col("_c") > 0)
    ends = F.explode(F.sequence(F.col("t"), F.col("_nt") - F.lit(slide_us), F.lit(slide_us)))
    return live.select(*keys, ends.alias("_end"), F.col("_c").cast("bigint").alias(out)).select(
        *keys, from_micros(F.col("_end"), ntz).alias("window_end"), out)
