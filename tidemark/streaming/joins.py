"""Stream-stream interval joins (reconciliation of pays and receipts).

Both sides carry watermarks; the time-range condition lets Spark evict
join state once the watermark passes ``ts + bound``.  Outer joins emit
unmatched rows once the watermark has passed their interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.time import interval


def interval_join_stream(left: DataFrame, right: DataFrame, key: str = "tx_id", lower="5 seconds",
                         upper="5 seconds", how: str = "inner") -> DataFrame:
    L = left.select(*[F.col(c).alias("o_" + c) for c in left.columns])
    R = right.select(*[F.col(c).alias("r_" + c) for c in right.columns])
    cond = ((F.col("o_" + key) == F.col("r_" + key))
            & (F.col("r_ts") >= F.col("o_ts") - interval(lower))
            & (F.col("r_ts") <= F.col("o_ts") + interval(upper)))
    return L.join(R, cond, how)


def reconcile_stream(orders: DataFrame, receipts: DataFrame, lower="5 seconds", upper="5 seconds",
                     key: str = "tx_id") -> DataFrame:
    """Full outer interval join tagged like ``operators.joins.reconcile``
    (valid for transaction ids that occur once per side)."""
    pays = orders.where(F.when(F.col("ts").isNotNull(), F.col(key) != F.lit("")).otherwise(F.lit(False)))
    j = interval_join_stream(pays, receipts, key, lower, upper, "full_outer")
    tag = (F.when(F.col("o_" + key).isNotNull() & F.col("r_" + key).isNotNull(), F.lit("matched"))
           .when(F.col("r_" + key).isNull(), F.lit("pay_without_receipt"))
           .otherwise(F.lit("receipt_without_pay")))
    return j.withColumn("tag", tag)
