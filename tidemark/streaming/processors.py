"""``transformWithState`` processors for the stateful jobs.

Every processor is an ``EventOrder``: rows of a key wait in state until the
watermark has passed them and are then handled in ``(ts, seq)`` order, so
neither micro-batch borders nor arrival order (within the watermark delay)
change the output.  A key has one timer, at its earliest waiting row or
deadline.  Times in state are epoch microseconds, those of timers and
results milliseconds.  Rows without a time have no place in this order and
are left out by ``prepare``.

A key's rows all pass through its state, in one task.  Where what a pattern
reports depends on rows a bounded time away only, ``spread=True`` keys the
state by (key, time bucket) instead, with copies of the rows that matter
across a bucket's borders (``sequence.halo``, as in the batch form): a key
with very many rows is then dealt over its buckets, and no bucket's state
outlives it by more than the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidemark.functions.time import duration_us
from tidemark.operators.sequence import halo


def prepare(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``ts_us`` and ``ts_ms`` (epoch micro- and milliseconds, for state and timers)."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return (df.withColumn("ts_us", us).where(F.col("ts_us").isNotNull())
            .withColumn("ts_ms", F.floor(F.col("ts_us") / 1000).cast("bigint")))


def _ms(us: int | None) -> int | None:
    return None if us is None else us // 1000


def _by_key(df: DataFrame, key: str, spread: bool, before: int = 0, after: int = 0):
    """Rows grouped for a processor: by key, or by (key, time bucket) with copies of the rows
    that a bucket's own rows look back or ahead to."""
    d = prepare(df)
    return halo(d, "ts", before, after).groupBy(key, "_hb") if spread else d.groupBy(key)


class OneTimer(StatefulProcessor):
    """A processor whose keys have one timer each, kept in state so that it can be moved."""

    def init(self, handle):
        self.handle = handle
        self.timer = handle.getValueState("timer", "ms bigint")

    def _arm(self, at) -> None:
        """Set the key's one timer to the watermark ``at`` (None: no timer)."""
        old = self.timer.get()[0] if self.timer.exists() else None
        if at == old:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if at is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(at)       # fires when the watermark has reached it
            self.timer.update((at,))

    def close(self):
        pass


class EventOrder(OneTimer):
    """Hands a key's rows to ``step`` in event-time order.

    Subclasses keep their state in a short list of tuples of ``MEMORY`` and
    define ``step(key, memory, row) -> outputs`` (changing ``memory`` in
    place), and, where a deadline can pass without a row,
    ``expire(key, memory, now) -> outputs`` for deadlines up to ``now`` and
    ``deadline(memory)``, the earliest one left; all times in microseconds.

    ``spread`` tells that keys are (key, time bucket); rows then carry ``_home``, false for copies.
    """

    spread = False

    MEMORY = ""
    COLS = T.StructType().add("event_type", "string")   # what ``step`` reads of a row, beside times and seq

    def init(self, handle):
        super().init(handle)
        times = T.StructType([T.StructField(c, T.LongType()) for c in ("ts_us", "ts_ms", "seq")])
        cols = [*self.COLS, *([T.StructField("_home", T.BooleanType())] if self.spread else [])]
        schema = T.StructType([*times, *(f for f in cols if f.name not in times.names)])
        self.names = schema.names
        self.pending = handle.getListState("pending", schema)
        self.memory = handle.getListState("memory", self.MEMORY)

    def step(self, key, memory, r):
        raise NotImplementedError

    def expire(self, key, memory, now):
        return []

    def deadline(self, memory):
        return None

    @staticmethod
    def _due(us: int) -> int:
        """The first watermark after which no row of this time can arrive."""
        return -(-us // 1000)

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(r[c] for c in self.names) for r in rows]
        if held:
            self.pending.appendList(held)
            first = min(self._due(r[0]) for r in held)
            self._arm(min(first, self.timer.get()[0]) if self.timer.exists() else first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()      # it has just fired
        held = [tuple(r) for r in self.pending.get()] if self.pending.exists() else []
        memory = [tuple(r) for r in self.memory.get()] if self.memory.exists() else []
        out, later = [], []
        for r in sorted(held, key=lambda r: (r[0], r[2] is not None, r[2])):
            if self._due(r[0]) <= now:
                out += self.step(key, memory, dict(zip(self.names, r)))
            else:
                later.append(r)
        out += self.expire(key, memory, now * 1000)
        for state, items in ((self.pending, later), (self.memory, memory)):
            if items:
                state.put(items)
            else:
                state.clear()
        ahead = [t for t in (later[0][0] if later else None, self.deadline(memory)) if t is not None]
        self._arm(self._due(min(ahead)) if ahead else None)
        return iter(out)


# ------------------------------------------------------------------ daily cap

class DailyCap(EventOrder):
    """Per key: pass the first ``cap`` rows of each local day, warn on the
    ``cap``-th, drop the rest; state evicted at the next local midnight.
    Input needs ``local_day`` (int day number) and ``next_midnight_ms``;
    output columns are ``tag`` then those of ``cols`` (a schema)."""

    MEMORY = "day int, n bigint, midnight_ms bigint"

    def __init__(self, cap: int, cols: T.StructType):
        self.cap = cap
        self.out = cols.names
        self.COLS = T.StructType(list(cols) + [T.StructField("next_midnight_ms", T.LongType())])

    def step(self, key, memory, r):
        n = memory[0][1] + 1 if memory and memory[0][0] == r["local_day"] else 1
        memory[:] = [(r["local_day"], n, r["next_midnight_ms"])]
        row = {c: r[c] for c in self.out}
        tags = ["pass"] * (n <= self.cap) + ["warning"] * (n == self.cap)
        return [Row(tag=t, **row) for t in tags]

    def expire(self, key, memory, now):
        memory[:] = [m for m in memory if m[2] * 1000 > now]
        return []

    def deadline(self, memory):
        return memory[0][2] * 1000 if memory else None


def daily_cap_stream(clicks: DataFrame, cap: int = 100, tz: str = "Asia/Shanghai",
                     keys=("user_id", "ad_id"), extra=(), salts: int = 1) -> DataFrame:
    """Tagged output (``pass`` / ``warning``) with the event time ``ts``
    kept as the event-time column, so a windowed aggregation can follow.

    With ``salts`` above 1 a key's rows are first capped in that many parts, dealt by a hash of time
    and ``seq``: a row among the first ``cap`` of its key and day is so in its part, too, so the
    cap of the whole key then sees at most ``salts * cap`` rows a day, however hot the key is.
    """
    from tidemark.functions.time import local_day, next_local_midnight

    def capped(rows: DataFrame, *by) -> DataFrame:
        d = prepare(rows).withColumn(
            "local_day", F.datediff(local_day("ts", tz), F.lit("1970-01-01")).cast("int")).withColumn(
            "next_midnight_ms",
            F.floor(F.unix_micros(next_local_midnight("ts", tz, ntz=False)) / 1000).cast("bigint"))
        cols = T.StructType([T.StructField(c, d.schema[c].dataType)
                             for c in [*keys, "ts_ms", "seq", "local_day", "ts", *extra]])
        schema = T.StructType([T.StructField("tag", T.StringType()), *cols])
        return d.groupBy(*keys, *by).transformWithState(
            DailyCap(cap, cols), schema, "Append", "EventTime", eventTimeColumnName="ts")
    if salts > 1:
        dealt = clicks.withColumn("_salt", F.pmod(F.xxhash64("ts", "seq"), F.lit(salts)))
        clicks = capped(dealt, "_salt").where("tag = 'pass'").drop("tag")
    return capped(clicks)


# ------------------------------------------------------------------ order timeout

ORDER_OUT = "order_id bigint, create_ms bigint, deadline_ms bigint, status string"


class OrderTimeout(EventOrder):
    """One open order per key: ``create`` opens (a later create before the
    deadline replaces it), ``pay`` strictly before the deadline reports
    ``payed``; the deadline reports ``timeout``."""

    MEMORY = "create_us bigint, deadline_us bigint"

    def __init__(self, within="15 minutes", spread: bool = False):
        self.within, self.spread = duration_us(within), spread

    def step(self, key, memory, r):
        t, out = r["ts_us"], self.expire(key, memory, r["ts_us"])
        if r["event_type"] == "create":     # a copy only ends what is open
            memory[:] = [(t, t + self.within)] if r.get("_home", True) else []
        elif r["event_type"] == "pay" and memory:
            c, end = memory.pop()
            out.append(Row(order_id=key[0], create_ms=_ms(c), deadline_ms=_ms(end), status="payed"))
        return out

    def expire(self, key, memory, now):
        if not memory or memory[0][1] > now:
            return []
        c, end = memory.pop()
        return [Row(order_id=key[0], create_ms=_ms(c), deadline_ms=_ms(end), status="timeout")]

    def deadline(self, memory):
        return memory[0][1] if memory else None


def order_timeout_stream(orders: DataFrame, within="15 minutes", key: str = "order_id",
                         spread: bool = False) -> DataFrame:
    return _by_key(orders, key, spread, after=duration_us(within)).transformWithState(
        OrderTimeout(within, spread), ORDER_OUT, "Append", "EventTime")


# ------------------------------------------------------------------ login failures

BURST_OUT = "user_id bigint, first_ms bigint, last_ms bigint, n_fails bigint"


class FailBurst(EventOrder):
    """First failure opens a burst with deadline ``+horizon`` (inclusive);
    failures join it, a success before the deadline cancels it; at the
    deadline it is reported when it holds ``min_fails`` or more."""

    MEMORY = "first_us bigint, last_us bigint, n bigint"

    def __init__(self, horizon="5 seconds", min_fails: int = 2):
        self.h = duration_us(horizon)
        self.min_fails = min_fails

    def step(self, key, memory, r):
        t, out = r["ts_us"], self.expire(key, memory, r["ts_us"])
        if r["event_type"] != "fail":
            memory.clear()
        elif memory:
            memory[0] = (memory[0][0], t, memory[0][2] + 1)
        else:
            memory.append((t, t, 1))
        return out

    def expire(self, key, memory, now):
        if not memory or self.deadline(memory) > now:
            return []
        first, last, n = memory.pop()
        return [Row(user_id=key[0], first_ms=_ms(first), last_ms=_ms(last), n_fails=n)] if n >= self.min_fails else []

    def deadline(self, memory):
        return memory[0][0] + self.h + 1 if memory else None


PAIR_OUT = "user_id bigint, first_ms bigint, last_ms bigint"


class FailPair(EventOrder):
    """Two failures in a row at most ``within`` apart; a success resets."""

    MEMORY = "us bigint"

    def __init__(self, within="2 seconds", spread: bool = False):
        self.w, self.spread = duration_us(within), spread

    def step(self, key, memory, r):
        t, last = r["ts_us"], memory[0][0] if memory else None
        memory.clear()
        if r["event_type"] != "fail":
            return []
        memory.append((t,))
        if last is None or t - last > self.w or not r.get("_home", True):
            return []
        return [Row(user_id=key[0], first_ms=_ms(last), last_ms=_ms(t))]

    def expire(self, key, memory, now):
        memory[:] = [m for m in memory if m[0] + self.w >= now]     # no pair can follow
        return []

    def deadline(self, memory):
        return memory[0][0] + self.w + 1 if memory else None


def fail_bursts_stream(logins: DataFrame, horizon="5 seconds", min_fails: int = 2) -> DataFrame:
    return prepare(logins).groupBy("user_id").transformWithState(
        FailBurst(horizon, min_fails), BURST_OUT, "Append", "EventTime")


def fail_pairs_stream(logins: DataFrame, within="2 seconds", spread: bool = False) -> DataFrame:
    return _by_key(logins, "user_id", spread, before=duration_us(within)).transformWithState(
        FailPair(within, spread), PAIR_OUT, "Append", "EventTime")


# ------------------------------------------------------------------ 1:1 reconciliation

RECON_OUT = ("tx_id string, tag string, pay_ms bigint, pay_seq bigint, receipt_ms bigint, "
             "receipt_seq bigint")


class Reconcile1to1(EventOrder):
    """Pays and receipts of one transaction id, matched one to one: each
    row, in event-time order, takes the earliest waiting row of the other
    side within the interval (consumed on match); otherwise it waits until
    the watermark passes its own ts + the interval and is then reported
    unmatched.  Input: a tagged union with ``side`` in {"pay", "receipt"}.
    """

    MEMORY = "side string, us bigint, seq bigint"
    COLS = T.StructType().add("side", "string")

    def __init__(self, lower="5 seconds", upper="5 seconds"):
        self.lo, self.hi = duration_us(lower), duration_us(upper)

    def _row(self, key, tag, p=None, r=None):
        return Row(tx_id=key[0], tag=tag, pay_ms=_ms(p[1]) if p else None, pay_seq=p[2] if p else None,
                   receipt_ms=_ms(r[1]) if r else None, receipt_seq=r[2] if r else None)

    def _end(self, m) -> int:
        """When a waiting row can no longer be matched: a receipt lies in [pay - lower, pay + upper]."""
        return m[1] + (self.hi if m[0] == "pay" else self.lo) + 1

    def step(self, key, memory, r):
        me = (r["side"], r["ts_us"], r["seq"])
        out = self.expire(key, memory, me[1])
        other = next((m for m in memory if m[0] != me[0]), None)    # all that wait are within reach
        if other is None:
            memory.append(me)
            return out
        memory.remove(other)
        pay, receipt = (me, other) if me[0] == "pay" else (other, me)
        return out + [self._row(key, "matched", pay, receipt)]

    def expire(self, key, memory, now):
        gone = [m for m in memory if self._end(m) <= now]
        memory[:] = [m for m in memory if self._end(m) > now]
        return [self._row(key, "pay_without_receipt", p=m) if m[0] == "pay"
                else self._row(key, "receipt_without_pay", r=m) for m in gone]

    def deadline(self, memory):
        return min(map(self._end, memory), default=None)


def reconcile_1to1_stream(pays: DataFrame, receipts: DataFrame, lower="5 seconds", upper="5 seconds",
                          key: str = "tx_id") -> DataFrame:
    """Tagged union of both sides (same watermark column ``ts``), matched
    one to one per transaction id."""
    u = (pays.select(F.col(key).alias("tx_id"), "ts", "seq", F.lit("pay").alias("side"))
         .unionByName(receipts.select(F.col(key).alias("tx_id"), "ts", "seq", F.lit("receipt").alias("side"))))
    return prepare(u).groupBy("tx_id").transformWithState(
        Reconcile1to1(lower, upper), RECON_OUT, "Append", "EventTime")


RUN_OUT = "user_id bigint, first_ms bigint, last_ms bigint, n_fails bigint"


class ConsecutiveFails(EventOrder):
    """``n`` failures in a row (no other event of the key between) whose
    last minus first is strictly below ``within``; overlapping runs all
    reported.  State: the key's last ``n - 1`` failures of the current run."""

    MEMORY = "us bigint"

    def __init__(self, n: int = 2, within="2 seconds", spread: bool = False):
        self.n, self.w, self.spread = n, duration_us(within), spread

    def step(self, key, memory, r):
        if r["event_type"] != "fail":
            memory.clear()
            return []
        run = [*memory, (r["ts_us"],)]
        memory[:] = run[-(self.n - 1):] if self.n > 1 else []
        if len(run) < self.n or run[-1][0] - run[-self.n][0] >= self.w or not r.get("_home", True):
            return []
        return [Row(user_id=key[0], first_ms=_ms(run[-self.n][0]), last_ms=_ms(run[-1][0]), n_fails=self.n)]

    def expire(self, key, memory, now):
        memory[:] = [m for m in memory if m[0] + self.w > now]      # no run can start there
        return []

    def deadline(self, memory):
        return memory[0][0] + self.w if memory else None


def consecutive_fails_stream(logins: DataFrame, n: int = 2, within="2 seconds", spread: bool = False) -> DataFrame:
    return _by_key(logins, "user_id", spread, before=duration_us(within)).transformWithState(
        ConsecutiveFails(n, within, spread), RUN_OUT, "Append", "EventTime")


FOLLOW_OUT = "order_id bigint, start_ms bigint, end_ms bigint, deadline_ms bigint, matched boolean"


class FollowedBy(EventOrder):
    """``begin(start).followedBy(end).within(T)``: every open ``start`` is
    matched by the first later ``end`` strictly before its deadline; a
    ``start`` whose deadline passes first is reported as timed out."""

    MEMORY = "us bigint"

    def __init__(self, within="15 minutes", start: str = "create", end: str = "pay", spread: bool = False):
        self.w, self.start, self.end, self.spread = duration_us(within), start, end, spread

    def _row(self, key, start, end=None):
        return Row(order_id=key[0], start_ms=_ms(start), end_ms=_ms(end), deadline_ms=_ms(start + self.w),
                   matched=end is not None)

    def step(self, key, memory, r):
        t, out = r["ts_us"], self.expire(key, memory, r["ts_us"])
        if r["event_type"] == self.start:
            if r.get("_home", True):        # a copy starts in its own bucket
                memory.append((t,))
        elif r["event_type"] == self.end:
            out += [self._row(key, m[0], t) for m in memory]
            memory.clear()
        return out

    def expire(self, key, memory, now):
        out = [self._row(key, m[0]) for m in memory if m[0] + self.w <= now]
        memory[:] = [m for m in memory if m[0] + self.w > now]
        return out

    def deadline(self, memory):
        return memory[0][0] + self.w if memory else None


def followed_by_stream(orders: DataFrame, within="15 minutes", key: str = "order_id", spread: bool = False) -> DataFrame:
    return _by_key(orders, key, spread, after=duration_us(within)).transformWithState(
        FollowedBy(within, spread=spread), FOLLOW_OUT, "Append", "EventTime")
