"""Running distinct visitors on a stream: one row per input row, the visitors of its window so far.

Two chained stateful operators.  The first is keyed by (window, page of the
bitmap): it holds one page's bits, waits until the watermark has passed a
row, and marks the rows that set a bit, in ``(ts, seq)`` order.  The second
is keyed by window and adds the marks up.  What the watermark passes in a
micro-batch leaves the first operator in that micro-batch, so the second
sorts each batch's rows and keeps nothing but a number per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F, types as T

from tidemark.functions.hashing import BITMAP_BITS, bitmap_offset
from tidemark.functions.time import duration_us, from_micros, to_micros
from tidemark.streaming.processors import EventOrder, OneTimer, prepare

PAGE_BITS = 15          # 4 KiB a page


class FirstSightings(EventOrder):
    """Marks the rows whose bit of the page ``key = (window end in us, page)`` wasn't set before."""

    MEMORY = "bits binary"
    COLS = T.StructType().add("bit", "integer").add("window_us", "long").add("ts", "timestamp")

    def __init__(self, page_bytes: int):
        self.page_bytes = page_bytes

    def step(self, key, memory, r):
        bits = bytearray(memory[0][0]) if memory else bytearray(self.page_bytes)
        byte, mask = r["bit"] >> 3, 1 << (r["bit"] & 7)
        first = not bits[byte] & mask
        if first:
            bits[byte] |= mask
            memory[:] = [(bytes(bits),)]
        self.window_us = r["window_us"]
        return [Row(window_us=r["window_us"], ts_us=r["ts_us"], seq=r["seq"], first=int(first), ts=r["ts"])]

    def expire(self, key, memory, now):
        if key[0] <= now:       # no row of the window can come
            memory.clear()
        self.window_us = key[0]
        return []

    def deadline(self, memory):
        return self.window_us if memory else None


class RunningTotal(OneTimer):
    """The marks of a window's rows so far; given each micro-batch's rows of ``key = (window end in us,)``."""

    def init(self, handle):
        super().init(handle)
        self.total = handle.getValueState("total", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        n = self.total.get()[0] if self.total.exists() else 0
        out = []
        for r in sorted(rows, key=lambda r: (r["ts_us"], r["seq"] is not None, r["seq"])):
            n += r["first"]
            out.append(Row(window_us=key[0], seq=r["seq"], ts=r["ts"], uv=n))
        self.total.update((n,))
        self._arm(-(-key[0] // 1000))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.clear()
        self.total.clear()
        return iter([])


def uv_running_stream(df: DataFrame, user: str = "user_id", ts: str = "ts", seq: str = "seq", size="1 hour",
                      distinct_on: str = "user", bits: int = BITMAP_BITS) -> DataFrame:
    """(seq, ts, window_end, uv) per row of a stream with a watermark: distinct users of its
    tumbling window up to and including it in ``(ts, seq)`` order, as ``uv_running`` reports for a
    finished input.  ``distinct_on="bitmap"`` counts bitmap offsets (ids that share one count once);
    ``"user"`` has a page of one bit per user.  Null users are one user.  Rows without a time, and
    rows later than the watermark, have no window."""
    size_us = duration_us(size)
    m = to_micros(ts)
    d = prepare(df.withColumn("window_us", m - F.pmod(m, F.lit(size_us)) + F.lit(size_us)), ts)
    if distinct_on == "bitmap":
        offset = bitmap_offset(user, bits).cast("bigint")
        d = d.withColumn("page", F.shiftright(offset, PAGE_BITS)).withColumn(
            "bit", (offset % (1 << PAGE_BITS)).cast("int"))
        page_bytes = 1 << PAGE_BITS - 3
    elif distinct_on == "user":
        d = d.withColumn("page", F.col(user)).withColumn("bit", F.lit(0))
        page_bytes = 1
    else:
        raise ValueError(distinct_on)
    given = d.select("window_us", "page", "bit", "ts_us", "ts_ms", F.col(seq).cast("bigint").alias("seq"),
                     F.col(ts).alias("ts"))
    marked = given.groupBy("window_us", "page").transformWithState(
        FirstSightings(page_bytes), "window_us bigint, ts_us bigint, seq bigint, first int, ts timestamp",
        "Append", "EventTime", eventTimeColumnName="ts")
    counted = marked.groupBy("window_us").transformWithState(
        RunningTotal(), "window_us bigint, seq bigint, ts timestamp, uv bigint", "Append", "EventTime")
    return counted.select("seq", "ts", from_micros(F.col("window_us"), False).alias("window_end"), "uv")
