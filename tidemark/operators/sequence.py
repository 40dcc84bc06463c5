"""Order-dependent work per key, split over (key, time bucket).

A per-key ``Window.partitionBy(key)`` sends a hot key's whole history to
one task.  The helpers here partition by ``(key, time bucket)`` instead and
stitch bucket boundaries with a small per-bucket table (one row per
non-empty bucket: counts, tails, first matches), which is itself ordered
per key.  Rows are ordered by ``(ts, seq)``; ``seq`` breaks ties.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.functions.time import duration_us, to_micros

DEFAULT_BUCKET = "1 minute"


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def time_bucket(ts: str, bucket) -> F.Column:
    us = duration_us(bucket)
    return F.floor(to_micros(ts) / F.lit(us)).cast("bigint")


def rejoin(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """``df`` with the columns of ``table``, whose rows are one for each value of ``on``
    in ``df``; null is a value like others, so no row is lost."""
    names = {c: f"_on_{c}" for c in on}
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return df.join(table.withColumnsRenamed(names), same).drop(*names.values())


def halo(df: DataFrame, ts: str, before_us: int = 0, after_us: int = 0, factor: int = 4) -> DataFrame:
    """Rows copied into every time bucket that needs them, for order work in
    which a row looks back at most ``before_us`` and ahead at most
    ``after_us`` microseconds: one window over ``(keys, _hb)`` then sees all
    that matters to its home rows (``_home``), without any join.

    Buckets are ``factor`` reaches wide, so at most about ``1/factor`` of the
    rows are copied.  Rows without a time share one bucket of their own.
    """
    width = F.lit(max(factor * (before_us + after_us), 1))
    m = to_micros(ts)

    def start(c):
        return c - F.pmod(c, width)
    spread = F.sequence(start(m - F.lit(after_us)), start(m + F.lit(before_us)), width)
    return df.withColumn("_hb", F.explode_outer(spread)).withColumn("_home", F.col("_hb").eqNullSafe(start(m)))


def home_rows(df: DataFrame) -> DataFrame:
    """The rows of :func:`halo` without the copies."""
    return df.where("_home").drop("_hb", "_home")


def bucket_offsets(df: DataFrame, keys, bucket_col: str, value=None) -> DataFrame:
    """Per (keys, bucket): ``_bn`` = rows (or sum of ``value``) in the
    bucket and ``_boff`` = the same summed over the key's earlier buckets."""
    keys = _keys(keys)
    v = F.count(F.lit(1)) if value is None else F.sum(value)
    cnt = df.groupBy(*keys, bucket_col).agg(v.cast("bigint").alias("_bn"))
    w = Window.partitionBy(*keys).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    return cnt.withColumn("_boff", F.coalesce(F.sum("_bn").over(w), F.lit(0)).cast("bigint"))


def running_sum(df: DataFrame, keys, ts: str, seq: str, value: str, out: str,
                bucket=DEFAULT_BUCKET) -> DataFrame:
    """``out`` = sum of ``value`` over the key's rows up to and including
    the current one in ``(ts, seq)`` order (a prefix sum split by bucket)."""
    keys = _keys(keys)
    d = df.withColumn("_b", time_bucket(ts, bucket))
    off = bucket_offsets(d, keys, "_b", F.col(value)).select(*keys, "_b", "_boff")
    w = (Window.partitionBy(*keys, "_b").orderBy(ts, seq)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rejoin(d, off, [*keys, "_b"])
            .withColumn(out, (F.col("_boff") + F.sum(value).over(w)).cast("bigint"))
            .drop("_b", "_boff"))


def with_neighbors(df: DataFrame, keys, ts: str, seq: str, fields, n: int = 1, out: str = "_prev",
                   direction: str = "preceding", bucket=DEFAULT_BUCKET, n_after: int = 0,
                   out_after: str = "_next") -> DataFrame:
    """Add ``out``: array of the ``n`` nearest earlier rows of the same key
    (``direction="following"``: later rows) as structs of
    ``(ts, seq, *fields)`` in time order (oldest first).  With
    ``n_after > 0`` (and ``direction="preceding"``) also add ``out_after``
    with the ``n_after`` nearest later rows in the same pass.

    Within a bucket the neighbours come from a bounded window frame; across
    a bucket boundary from the tails / heads of the nearest non-empty
    buckets, a table with at most ``n`` entries per bucket.
    """
    keys = _keys(keys)
    if direction == "following":
        n_before, n_after, out_after = 0, n, out
    else:
        n_before = n
    fields = [f for f in fields if f not in (ts, seq)]
    ev = F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"), *[F.col(f) for f in fields])
    order = F.struct(F.col(ts), F.col(seq))
    d = df.withColumn("_b", time_bucket(ts, bucket))
    if n_before <= 1 and n_after <= 1:
        # one neighbour each way: bounded partial aggregation, no sort
        aggs = []
        if n_before:
            aggs.append(F.array(F.max_by(ev, order)).alias("_tail"))
        if n_after:
            aggs.append(F.array(F.min_by(ev, order)).alias("_head"))
        edges = d.groupBy(*keys, "_b").agg(*aggs)
    else:
        wk = Window.partitionBy(*keys, "_b")
        e = d
        aggs = []
        if n_before:
            e = e.withColumn("_rd", F.row_number().over(wk.orderBy(F.col(ts).desc(), F.col(seq).desc())))
            aggs.append(F.sort_array(F.collect_list(F.when(F.col("_rd") <= n_before, ev))).alias("_tail"))
        if n_after:
            e = e.withColumn("_ra", F.row_number().over(wk.orderBy(ts, seq)))
            aggs.append(F.sort_array(F.collect_list(F.when(F.col("_ra") <= n_after, ev))).alias("_head"))
        edges = e.groupBy(*keys, "_b").agg(*aggs)
    wb = Window.partitionBy(*keys).orderBy("_b")
    carry_cols = []
    if n_before:
        carry_cols.append(F.flatten(F.collect_list("_tail").over(wb.rowsBetween(-n_before, -1))).alias("_cb"))
    if n_after:
        carry_cols.append(F.flatten(F.collect_list("_head").over(wb.rowsBetween(1, n_after))).alias("_ca"))
    carry = edges.select(*keys, "_b", *carry_cols)
    j = rejoin(d, carry, [*keys, "_b"])
    wi = Window.partitionBy(*keys, "_b").orderBy(ts, seq)
    if n_before:
        allv = F.concat(F.col("_cb"), F.collect_list(ev).over(wi.rowsBetween(-n_before, -1)))
        j = j.withColumn(out, F.slice(allv, F.greatest(F.size(allv) - F.lit(n_before) + 1, F.lit(1)), n_before))
    if n_after:
        allv = F.concat(F.collect_list(ev).over(wi.rowsBetween(1, n_after)), F.col("_ca"))
        j = j.withColumn(out_after, F.slice(allv, 1, n_after))
    return j.drop("_b", "_cb", "_ca")


def next_match(df: DataFrame, keys, ts: str, seq: str, is_target, out: str = "_next",
               bucket=DEFAULT_BUCKET) -> DataFrame:
    """Add ``out``: struct ``(ts, seq)`` of the first later row of the same
    key for which ``is_target`` holds (NULL if none), skipping other rows."""
    keys = _keys(keys)
    tgt = F.when(is_target, F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq")))
    d = df.withColumn("_b", time_bucket(ts, bucket)).withColumn("_tgt", tgt)
    firsts = d.groupBy(*keys, "_b").agg(F.min("_tgt").alias("_bmin"))
    # "all later rows" is written as a running frame over the reversed order:
    # Spark evaluates UNBOUNDED PRECEDING frames incrementally, but
    # recomputes UNBOUNDED FOLLOWING frames for every row.
    wb = Window.partitionBy(*keys).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = firsts.select(*keys, "_b", F.min("_bmin").over(wb).alias("_carry"))
    wi = (Window.partitionBy(*keys, "_b").orderBy(F.col(ts).desc(), F.col(seq).desc())
          .rowsBetween(Window.unboundedPreceding, -1))
    return (rejoin(d, carry, [*keys, "_b"])
            .withColumn(out, F.coalesce(F.min("_tgt").over(wi), F.col("_carry")))
            .drop("_b", "_tgt", "_carry"))


def order_buckets(df: DataFrame, order_ts: str, bucket="1 second", coarse="1 hour") -> DataFrame:
    """Add ``_b`` and ``_c``, the fine and the coarse bucket of a global order by ``order_ts``: time
    buckets, or blocks of 2^16 / 2^26 positions of a numeric ``order_ts`` (arrival position)."""
    if isinstance(df.schema[order_ts].dataType, (T.TimestampType, T.TimestampNTZType)):
        ratio = max(duration_us(coarse) // duration_us(bucket), 1)
        d = df.withColumn("_b", time_bucket(order_ts, bucket))
    else:
        ratio = 1 << 10
        d = df.withColumn("_b", F.floor(F.col(order_ts) / F.lit(1 << 16)).cast("bigint"))
    return d.withColumn("_c", F.floor(F.col("_b") / F.lit(ratio)).cast("bigint"))


def bucket_maxima(d: DataFrame, value: str) -> DataFrame:
    """(_b, _bm, _carry) per fine bucket of :func:`order_buckets`: the max of ``value`` in it and
    in all buckets before it (NULL for the first).  Fine buckets are scanned inside coarse ones;
    the table of coarse buckets, one row each, is the only unpartitioned step."""
    fine = d.groupBy("_c", "_b").agg(F.max(value).alias("_bm"))
    coarse_t = fine.groupBy("_c").agg(F.max("_bm").alias("_cm"))
    c_carry = coarse_t.select("_c", F.max("_cm").over(
        Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)).alias("_cc"))
    f_carry = fine.select("_c", "_b", "_bm", F.max("_bm").over(
        Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_fc"))
    return rejoin(f_carry, c_carry, ["_c"]).select(
        "_b", "_bm", F.greatest(F.col("_fc"), F.col("_cc")).alias("_carry"))  # greatest skips NULLs


def running_max_before(df: DataFrame, order_ts: str, seq: str, value: str, out: str,
                       bucket="1 second", coarse="1 hour") -> DataFrame:
    """``out`` = max of ``value`` over all rows strictly before the current
    one in global ``(order_ts, seq)`` order (NULL for the first row).

    A global order has no key, so it is split twice by time: rows are
    ranked only inside fine buckets (``bucket``); the maxima of earlier
    fine buckets come from :func:`bucket_maxima`.
    """
    d = order_buckets(df, order_ts, bucket, coarse)
    wi = Window.partitionBy("_b").orderBy(order_ts, seq).rowsBetween(Window.unboundedPreceding, -1)
    j = rejoin(d, bucket_maxima(d, value).drop("_bm"), ["_b"]).withColumn("_in", F.max(value).over(wi))
    return j.withColumn(out, F.greatest(F.col("_in"), F.col("_carry"))).drop("_b", "_c", "_carry", "_in")
