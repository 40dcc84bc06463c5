"""Interval joins and payment/receipt reconciliation.

``right.ts`` must lie in ``[left.ts - lower, left.ts + upper]`` (both ends
inclusive) and the keys must be equal.  Besides the key, both sides are
joined on a time bucket of width ``lower + upper``: one side keeps its own
bucket and the other is copied into the (at most two) buckets its partners
can fall in.  Only rows that are close in time meet, so a hot key does not
compare all of its rows pairwise.  Each pair is found exactly once (the
non-copied side has one bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.time import duration_us, interval, to_micros


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _bucketed_pairs(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str, rts: str,
                    lower, upper, copy_side: str, how: str) -> DataFrame:
    lo, hi = duration_us(lower), duration_us(upper)
    width = max(lo + hi, 1)
    if copy_side == "right":
        # right row r pairs with left rows whose ts is in [r - hi, r + lo].
        kept = left.withColumn("_bk", F.floor(to_micros(lts) / width))
        m = to_micros(rts)
        copied = right.withColumn("_bk", F.explode(F.sequence(
            F.floor((m - F.lit(hi)) / width), F.floor((m + F.lit(lo)) / width))))
        a, b = kept, copied
    else:
        # left row l pairs with right rows whose ts is in [l - lo, l + hi].
        kept = right.withColumn("_bk", F.floor(to_micros(rts) / width))
        m = to_micros(lts)
        copied = left.withColumn("_bk", F.explode(F.sequence(
            F.floor((m - F.lit(lo)) / width), F.floor((m + F.lit(hi)) / width))))
        a, b = copied, kept
    cond = ((a[lkey] == b[rkey]) & (a["_bk"] == b["_bk"])
            & (b[rts] >= a[lts] - interval(lower)) & (b[rts] <= a[lts] + interval(upper)))
    out = a.join(b, cond, how)
    return out.drop("_bk") if how in ("left_anti", "left_semi") else out.drop(a["_bk"]).drop(b["_bk"])


def interval_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str = "ts",
                  rts: str = "ts", lower="5 seconds", upper="5 seconds",
                  how: str = "inner", lprefix: str = "l_", rprefix: str = "r_") -> DataFrame:
    """Interval join; ``how`` in inner / left_anti / right_anti / full.
    Output columns are the inputs' columns with ``lprefix`` / ``rprefix``
    (anti joins return only their side, prefixed)."""
    L, R = _prefixed(left, lprefix), _prefixed(right, rprefix)
    lk, rk, lt, rt = lprefix + lkey, rprefix + rkey, lprefix + lts, rprefix + rts
    if how == "inner":
        return _bucketed_pairs(L, R, lk, rk, lt, rt, lower, upper, "right", "inner")
    if how == "left_anti":
        return _bucketed_pairs(L, R, lk, rk, lt, rt, lower, upper, "right", "left_anti")
    if how == "right_anti":
        # Swap roles so the right side keeps a single bucket per row.
        return _bucketed_pairs(R, L, rk, lk, rt, lt, upper, lower, "right", "left_anti")
    if how == "full":
        # a left row has one bucket, so an outer join also finds the left rows without a partner
        found = _bucketed_pairs(L, R, lk, rk, lt, rt, lower, upper, "right", "left")
        ronly = interval_join(left, right, lkey, rkey, lts, rts, lower, upper, "right_anti", lprefix, rprefix)
        return found.unionByName(ronly, allowMissingColumns=True)
    raise ValueError(f"unsupported join type {how!r}")


def reconcile(orders: DataFrame, receipts: DataFrame, lower="5 seconds", upper="5 seconds",
              key: str = "tx_id", ts: str = "ts") -> DataFrame:
    """Pays (non-empty ``tx_id``) matched with receipts of the same
    transaction within the interval, plus both exception lists, tagged
    ``matched`` / ``pay_without_receipt`` / ``receipt_without_pay``."""
    pays = orders.where(F.coalesce(F.col(key), F.lit("")) != "")
    full = interval_join(pays, receipts, key, key, ts, ts, lower, upper, "full", "o_", "r_")
    tag = (F.when(F.col("o_" + key).isNotNull() & F.col("r_" + key).isNotNull(), F.lit("matched"))
           .when(F.col("r_" + key).isNull(), F.lit("pay_without_receipt"))
           .otherwise(F.lit("receipt_without_pay")))
    return full.withColumn("tag", tag)
