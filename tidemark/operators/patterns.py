"""Event-pattern operators over a key's timeline in ``(ts, seq)`` order.

Every pattern is bounded by a duration, so by default rows are copied
across the borders of time buckets (``sequence.halo``) and one window over
``(key, bucket)`` decides: one shuffle, no join.  A bucket is some multiple
of the pattern's duration; where that is long and a single key holds very
many rows, pass ``bucket`` (e.g. ``"1 minute"``) for the stitched form of
``with_neighbors`` / ``next_match``, which splits a key finer and joins a
per-bucket table.  The streaming forms are the processors in
``tidemark.streaming.processors``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.time import duration_us, interval, to_micros
from tidemark.operators.sequence import halo, home_rows, next_match, with_neighbors
from tidemark.session import reliable_checkpoint


def _is(col, value):
    return F.col(col) == F.lit(value)


def _neighbors(df: DataFrame, key: str, ts: str, seq: str, event: str, n: int, out: str, within,
               direction: str = "preceding", bucket=None) -> DataFrame:
    """``with_neighbors`` for neighbours at most ``within`` away (farther ones may be missing)."""
    if bucket is not None:
        return with_neighbors(df, key, ts, seq, [event], n, out, direction, bucket)
    reach = duration_us(within)
    back = direction == "preceding"
    d = halo(df, ts, reach, 0) if back else halo(df, ts, 0, reach)
    ev = F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq"), F.col(event))
    w = Window.partitionBy(key, "_hb").orderBy(ts, seq)
    w = w.rowsBetween(-n, -1) if back else w.rowsBetween(1, n)
    return home_rows(d.withColumn(out, F.collect_list(ev).over(w)))


def login_fail_pairs(df: DataFrame, key: str = "user_id", ts: str = "ts", seq: str = "seq",
                     event: str = "event_type", fail: str = "fail", within="2 seconds",
                     inclusive: bool = True, bucket=None) -> DataFrame:
    """Two failures in a row (no other event of the key between) at most
    ``within`` apart (``<=``; strict ``<`` with ``inclusive=False``)."""
    d = _neighbors(df, key, ts, seq, event, 1, "_p", within, bucket=bucket)
    prev = F.get(F.col("_p"), 0)
    gap_ok = (F.col(ts) <= prev["ts"] + interval(within)) if inclusive else (
        F.col(ts) < prev["ts"] + interval(within))
    hit = _is(event, fail) & (F.size("_p") == 1) & (prev[event] == F.lit(fail)) & gap_ok
    return d.where(hit).select(key, prev["ts"].alias("first_ts"), F.col(ts).alias("last_ts"),
                               F.lit(2).cast("bigint").alias("n_fails"))


def match_consecutive(df: DataFrame, n: int = 2, key: str = "user_id", ts: str = "ts",
                      seq: str = "seq", event: str = "event_type", fail: str = "fail",
                      within="2 seconds", bucket=None) -> DataFrame:
    """Every run of ``n`` consecutive matching events of a key whose last
    minus first is strictly below ``within``; overlapping runs all
    reported."""
    if n == 1:
        return df.where(_is(event, fail) & F.col(ts).isNotNull()).select(
            key, F.col(ts).alias("first_ts"), F.col(ts).alias("last_ts"), F.lit(1).cast("bigint").alias("n_fails"))
    d = _neighbors(df, key, ts, seq, event, n - 1, "_p", within, bucket=bucket)
    prev_all = F.forall("_p", lambda e: e[event] == F.lit(fail))
    first_ts = F.get(F.col("_p"), 0)["ts"]
    hit = _is(event, fail) & (F.size("_p") == n - 1) & prev_all & (
        F.col(ts) < first_ts + interval(within))
    return d.where(hit).select(key, first_ts.alias("first_ts"), F.col(ts).alias("last_ts"),
                               F.lit(n).cast("bigint").alias("n_fails"))


def match_next(df: DataFrame, key: str = "user_id", ts: str = "ts", seq: str = "seq",
               event: str = "event_type", fail: str = "fail", within="2 seconds",
               bucket=None) -> DataFrame:
    """``begin(fail).next(fail).within(T)``: a failure whose very next event
    of the key is a failure less than ``within`` later."""
    d = _neighbors(df, key, ts, seq, event, 1, "_n", within, "following", bucket)
    nxt = F.get(F.col("_n"), 0)
    hit = _is(event, fail) & (F.size("_n") == 1) & (nxt[event] == F.lit(fail)) & (
        nxt["ts"] < F.col(ts) + interval(within))
    return d.where(hit).select(key, F.col(ts).alias("first_ts"), nxt["ts"].alias("last_ts"))


def followed_by(df: DataFrame, key: str = "order_id", ts: str = "ts", seq: str = "seq",
                event: str = "event_type", start: str = "create", end: str = "pay",
                within="15 minutes", bucket=None) -> DataFrame:
    """``begin(start).followedBy(end).within(T)`` with both outcomes: every
    ``start`` row with the first later ``end`` row of its key (other rows
    skipped); ``matched`` when that row is strictly less than ``within``
    later, else timed out at ``deadline = start ts + within``."""
    d = df.where(F.col(event).isin(start, end))
    if bucket is not None:
        d = next_match(d, key, ts, seq, _is(event, end), "_nx", bucket)
    else:
        # a running frame over the reversed order is evaluated incrementally
        later = (Window.partitionBy(key, "_hb").orderBy(F.col(ts).desc(), F.col(seq).desc())
                 .rowsBetween(Window.unboundedPreceding, -1))
        target = F.when(_is(event, end), F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq")))
        d = home_rows(halo(d, ts, 0, duration_us(within)).withColumn("_nx", F.min(target).over(later)))
    d = d.where(_is(event, start))
    deadline = F.col(ts) + interval(within)
    ok = F.coalesce(F.col("_nx.ts") < deadline, F.lit(False))
    return d.select(key, F.col(ts).alias("start_ts"), F.col(seq).alias("start_seq"),
                    F.when(ok, F.col("_nx.ts")).alias("end_ts"),
                    deadline.alias("deadline"), ok.alias("matched"))


def order_paid(df: DataFrame, **kw) -> DataFrame:
    r = followed_by(df, **kw).where("matched")
    return r.select(r.columns[0], "start_ts", "end_ts")


def order_timeout(df: DataFrame, **kw) -> DataFrame:
    r = followed_by(df, **kw).where(~F.col("matched"))
    return r.select(r.columns[0], "start_ts", "deadline")


def order_timeout_state(df: DataFrame, key: str = "order_id", ts: str = "ts", seq: str = "seq",
                        event: str = "event_type", start: str = "create", end: str = "pay",
                        within="15 minutes", bucket=None) -> DataFrame:
    """Timer semantics with one open order per key: a ``start`` opens it
    (a later ``start`` before the deadline replaces it silently), an
    ``end`` strictly before the deadline closes it as ``payed``; reaching
    the deadline first reports ``timeout``; an ``end`` with nothing open is
    ignored.  Each start's fate is decided by the key's next start/end row.
    """
    d = df.where(F.col(event).isin(start, end))
    d = _neighbors(d, key, ts, seq, event, 1, "_n", within, "following", bucket).where(_is(event, start))
    nxt = F.get(F.col("_n"), 0)
    deadline = F.col(ts) + interval(within)
    status = (F.when(F.size("_n") == 0, F.lit("timeout"))
              .when(nxt["ts"] >= deadline, F.lit("timeout"))
              .when(nxt[event] == F.lit(end), F.lit("payed")))
    return (d.select(key, F.col(ts).alias("create_ts"), deadline.alias("deadline"), status.alias("status"))
            .where(F.col("status").isNotNull()))


def login_fail_bursts(df: DataFrame, key: str = "user_id", ts: str = "ts", seq: str = "seq",
                      event: str = "event_type", fail: str = "fail", horizon="5 seconds",
                      min_fails: int = 2) -> DataFrame:
    """Failure bursts with a timer: the first failure opens a burst with a
    deadline ``horizon`` later (inclusive); failures up to the deadline
    join it; a success up to the deadline cancels it; at the deadline the
    burst is reported if it holds at least ``min_fails`` failures.  The
    next failure after the deadline opens a new burst.  Rows without a time
    take no part.

    (1) A *segment* is a run of failures with no success between and gaps of
    at most ``horizon``; its first failure always opens a burst.  Within one
    segment all that a burst needs lies within two horizons of its first
    failure, so one shuffle into haloed time buckets gives every failure the
    burst it would open: size, last row, cancellation, and the failure that
    would open the next one.  (2) Which failures do open one follows from
    the pointers to the next: marked from the segments' heads by pointer
    doubling, one round more than the logarithm of the most bursts in one
    segment.  Each round runs as the query is built, cut by a reliable
    checkpoint; no segment, however long, is gathered in one task.
    """
    h = duration_us(horizon)
    at = F.col("_m")
    d = halo(df.where(F.col(ts).isNotNull()), ts, h, 2 * h)
    d = d.withColumn("_m", to_micros(ts)).withColumn("_f", F.col(event).eqNullSafe(fail))
    w = Window.partitionBy(key, "_hb").orderBy(ts, seq)
    d = d.select("*", F.lag("_f").over(w).alias("_pf"), F.lag("_m").over(w).alias("_pm"),
                 F.lead("_f").over(w).alias("_nf"), F.lead("_m").over(w).alias("_nm"))
    d = d.where("_f").withColumn("_head", F.coalesce(~F.col("_pf") | (at > F.col("_pm") + F.lit(h)), F.lit(True)))
    d = d.withColumn("_seg", F.sum(F.col("_head").cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    seg = Window.partitionBy(key, "_hb", "_seg")
    up, down = seg.orderBy("_m"), seg.orderBy(at.desc())
    until = up.rangeBetween(Window.unboundedPreceding, h)
    success = F.when(~F.col("_nf"), F.col("_nm"))
    # a burst opens at the first failure of its instant: those before it are strictly earlier
    d = d.select("*", F.max(F.struct(F.col(ts), F.col(seq), success.alias("stop"))).over(until).alias("_last"),
                 (F.count(F.lit(1)).over(until)
                  - F.count(F.lit(1)).over(up.rangeBetween(Window.unboundedPreceding, -1))).alias("_n"),
                 F.min(F.struct(F.col(ts), F.col(seq))).over(
                     down.rangeBetween(Window.unboundedPreceding, -(h + 1))).alias("_nx"))
    stop = F.col("_last.stop")
    ident = [F.col(key).alias("k")]
    fails = reliable_checkpoint(home_rows(d).select(
        key, F.col(ts).alias("first_ts"), F.col(f"_last.{ts}").alias("last_ts"), F.col("_n").alias("n_fails"), "_head",
        F.coalesce(stop <= at + F.lit(h), F.lit(False)).alias("_cancelled"),
        F.struct(*ident, F.col(ts).alias("t"), F.col(seq).alias("s")).alias("_id"),
        F.when(F.col("_nx").isNotNull(), F.struct(
            *ident, F.col(f"_nx.{ts}").alias("t"), F.col(f"_nx.{seq}").alias("s"))).alias("_to")))
    bursts = fails.where("_head")
    starts = _chained(bursts.select("_id"), fails.where(F.col("_to").isNotNull()).select("_id", "_to"))
    if starts is not None:
        bursts = bursts.unionByName(fails.join(starts, "_id", "left_semi"))
    return (bursts.where((F.col("n_fails") >= min_fails) & ~F.col("_cancelled"))
            .select(key, "first_ts", "last_ts", "n_fails"))


def _chained(heads: DataFrame, jump: DataFrame) -> DataFrame | None:
    """All ``_id`` reached from ``heads`` by one or more pointers ``_id -> _to``
    (no chains that meet), ``None`` if there are none: before round k all at a distance
    below ``2**k`` are marked and ``jump`` spans ``2**k`` pointers."""
    steps = []
    while True:
        marked = reduce(DataFrame.unionByName, steps, heads)
        step = reliable_checkpoint(marked.join(jump, "_id").select(F.col("_to").alias("_id")))
        if step.isEmpty():
            return reduce(DataFrame.unionByName, steps) if steps else None
        steps.append(step)
        a, b = jump.alias("a"), jump.alias("b")
        jump = reliable_checkpoint(a.join(b, F.col("a._to") == F.col("b._id")).select("a._id", "b._to"))
