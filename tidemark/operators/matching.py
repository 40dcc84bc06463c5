"""One-to-one reconciliation of two sides of a transaction, where a match uses up its partner.

In ``(ts, seq)`` order each row takes the earliest waiting row of the other
side within reach; otherwise it waits until its reach has passed.  What
waits at a point in time depends on all that came before, so a key's rows
can't simply be cut into pieces.  They are cut all the same, into time
buckets several reaches wide, each matched apart on the guess that nothing
waits where it begins.  Where the bucket before did leave rows waiting, the
bucket is matched again with them put in front, until no bucket leaves
anything but what its successor started from.  A row that waits never
outlives the next bucket, and a guess is right wherever a key pauses, so a
few rounds over ever fewer buckets are enough, and a key of any size is
spread over its buckets.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.time import duration_us, from_micros, to_micros, ts_type_of
from tidemark.session import reliable_checkpoint

# Reaches per bucket: at most about one row in so many waits where a bucket ends.
BUCKET_REACHES = 16

_FOUND = ("tx_id string, bucket bigint, waiting boolean, pay_t bigint, pay_seq bigint, "
          "receipt_t bigint, receipt_seq bigint")


class Matcher:
    """Matches the rows of one bucket, given in order; ``pay_reach`` and ``receipt_reach`` tell how
    long after its own time a waiting row can still be matched."""

    def __init__(self, pay_reach: int, receipt_reach: int):
        self.reach = (receipt_reach, pay_reach)
        self.queue: deque[tuple[int, int | None]] = deque()     # of one side only, earliest first
        self.pays = False                                       # which side waits

    def _end(self, t: int) -> int:
        return t + self.reach[self.pays]

    def _alone(self, row: tuple, waiting: bool = False) -> tuple:
        return (waiting, *row, None, None) if self.pays else (waiting, None, None, *row)

    def add(self, is_pay: bool, t: int, seq: int | None) -> list[tuple]:
        """The rows that this one decides: (waiting, pay_t, pay_seq, receipt_t, receipt_seq)."""
        out = []
        while self.queue and self._end(self.queue[0][0]) < t:
            out.append(self._alone(self.queue.popleft()))
        if self.queue and self.pays != is_pay:
            other = self.queue.popleft()
            out.append((False, t, seq, *other) if is_pay else (False, *other, t, seq))
        else:
            self.pays = is_pay
            self.queue.append((t, seq))
        return out

    def finish(self, end: int) -> list[tuple]:
        """What is left: rows that can be matched from time ``end`` on still wait."""
        out = [self._alone(row, self._end(row[0]) >= end) for row in self.queue]
        self.queue.clear()
        return out


def _matched(rows: DataFrame, pay_reach: int, receipt_reach: int, width: int) -> DataFrame:
    """``rows`` (tx_id, bucket, t, seq, is_pay) matched within each (tx_id, bucket)."""
    names = [c.split()[0] for c in _FOUND.split(", ")]
    types = [pa.string(), pa.int64(), pa.bool_(), *[pa.int64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, here = Matcher(pay_reach, receipt_reach), None
        out: list[tuple] = []

        def table() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[] for _ in names]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            for tx, bucket, t, seq, is_pay in zip(*(c.to_pylist() for c in b.columns)):
                if (tx, bucket) != here:
                    if here is not None:
                        out.extend((*here, *r) for r in matcher.finish(here[1] + width))
                    here = (tx, bucket)
                out.extend((tx, bucket, *r) for r in matcher.add(is_pay, t, seq))
            yield table()
        if here is not None:
            out.extend((*here, *r) for r in matcher.finish(here[1] + width))
            yield table()

    return (rows.select("tx_id", "bucket", "t", "seq", "is_pay").repartition("tx_id", "bucket")
            .sortWithinPartitions("tx_id", "bucket", "t", "seq", F.col("is_pay").desc()).mapInArrow(run, _FOUND))


def _carried(found: DataFrame, width: int) -> DataFrame:
    """Rows that wait where a bucket ends, as rows at the front of the next."""
    is_pay = F.col("pay_t").isNotNull()
    return found.where("waiting").select(
        "tx_id", (F.col("bucket") + F.lit(width)).alias("bucket"), F.coalesce("pay_t", "receipt_t").alias("t"),
        F.when(is_pay, F.col("pay_seq")).otherwise(F.col("receipt_seq")).alias("seq"), is_pay.alias("is_pay"))


def _differing(new: DataFrame, old: DataFrame) -> DataFrame:
    """The buckets whose rows differ between two tables."""
    signed = new.withColumn("_s", F.lit(1)).unionByName(old.withColumn("_s", F.lit(-1)))
    return (signed.groupBy(*new.columns).agg(F.sum("_s").alias("_s")).where("_s <> 0")
            .select("tx_id", "bucket").distinct())


def reconcile_one_to_one(orders: DataFrame, receipts: DataFrame, lower="5 seconds", upper="5 seconds",
                         key: str = "tx_id", ts: str = "ts", seq: str = "seq", bucket=None) -> DataFrame:
    """(tx_id, tag, pay_ts, pay_seq, receipt_ts, receipt_seq): pays (non-empty ``key``) and receipts
    matched one to one, a receipt within ``[pay - lower, pay + upper]``, and both lists of
    what found no partner (tags as in ``reconcile``).  The streaming form is ``Reconcile1to1``.

    Equal ``(ts, seq)`` put pays first.  Rows without a time, and receipts without a
    key, have no partner and are reported alone; repeated rows each take their own
    partner.  ``bucket`` (default: 16 times the longer reach) must be longer than either.
    """
    lo, hi = duration_us(lower), duration_us(upper)
    width = duration_us(bucket) if bucket is not None else BUCKET_REACHES * max(lo, hi, 1)
    if width <= max(lo, hi):
        raise ValueError("a bucket must be longer than the interval's reaches")
    ntz = ts_type_of(orders, ts)

    def side(df: DataFrame, is_pay: bool) -> DataFrame:
        return df.select(F.col(key).cast("string").alias("tx_id"), to_micros(ts).alias("t"),
                         F.col(seq).cast("bigint").alias("seq"), F.lit(is_pay).alias("is_pay"))
    both = side(orders.where(F.coalesce(F.col(key), F.lit("")) != ""), True).unionByName(side(receipts, False))
    placed = F.col("t").isNotNull() & F.col("tx_id").isNotNull()
    # narrow rows, read again in every round
    rows = reliable_checkpoint(both.where(placed).withColumn(
        "bucket", F.col("t") - F.pmod(F.col("t"), F.lit(width))))
    match: Callable[[DataFrame], DataFrame] = lambda df: reliable_checkpoint(_matched(df, hi, lo, width))
    on = ["tx_id", "bucket"]
    rounds, redone = [match(rows)], []
    left = rounds[0]                    # what each bucket leaves, by its last round
    begun = rows.where("false").select("tx_id", "bucket", "t", "seq", "is_pay")
    while True:
        front = reliable_checkpoint(_carried(left, width).select(*begun.columns))
        changed = reliable_checkpoint(_differing(front, begun))
        if changed.isEmpty():
            break
        again = rows.unionByName(front).join(changed, on, "left_semi")
        rounds.append(match(again))
        redone.append(changed)
        left = reliable_checkpoint(left.where("waiting").join(changed, on, "left_anti")
                                   .unionByName(rounds[-1].where("waiting")))
        begun = front
    found = rounds[0].withColumn("_round", F.lit(0))
    for i, more in enumerate(rounds[1:], 1):
        found = found.unionByName(more.withColumn("_round", F.lit(i)))
    if redone:
        last = redone[0].withColumn("_last", F.lit(1))
        for i, more in enumerate(redone[1:], 2):
            last = last.unionByName(more.withColumn("_last", F.lit(i)))
        last = last.groupBy(*on).agg(F.max("_last").alias("_last"))
        found = found.join(last, on, "left").where(F.col("_round") == F.coalesce("_last", F.lit(0)))
    alone = both.where(~placed)
    loose = alone.select("tx_id", *(F.when(F.col("is_pay") == side_is_pay, F.col(c)).alias(n)
                                    for side_is_pay, c, n in ((True, "t", "pay_t"), (True, "seq", "pay_seq"),
                                                              (False, "t", "receipt_t"), (False, "seq", "receipt_seq"))),
                         F.when(F.col("is_pay"), "pay_without_receipt").otherwise("receipt_without_pay").alias("tag"))
    tag = (F.when(F.col("pay_t").isNull(), "receipt_without_pay").when(F.col("receipt_t").isNull(), "pay_without_receipt")
           .otherwise("matched"))
    out = found.where("NOT waiting").withColumn("tag", tag).select(*loose.columns).unionByName(loose)
    return out.select("tx_id", "tag", from_micros(F.col("pay_t"), ntz).alias("pay_ts"), "pay_seq",
                      from_micros(F.col("receipt_t"), ntz).alias("receipt_ts"), "receipt_seq")
