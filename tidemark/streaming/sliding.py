"""Sliding counts on streams from a ring of pane counts per key.

A row is counted once, in its slide-wide pane.  A key's panes and the next
window end to report are its whole state; when the watermark passes an end,
the count of that window is the running total of the panes in it: the pane
that enters is added and the one that leaves taken off.  No row is expanded
to the windows it lies in, whatever size / slide is, and no micro-batch
compiles a projection per window.

With ``lateness`` the operator itself decides which rows come too late:
those whose last window its own watermark has closed are passed on, tagged
``late``; every other row is counted in the windows still open, and a window
that was reported before is reported anew.  One decision, so a row is either
counted or late, never both or neither.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, functions as F, types as T

from tidemark.functions.time import duration_us
from tidemark.streaming.processors import OneTimer


class PaneRing:
    """Counts of panes ``[p, p + slide)`` and the windows ``[e - size, e)`` over them, ``e`` and ``p``
    multiples of ``slide``; windows with ends up to ``reported`` are done (None: no window is)."""

    def __init__(self, size: int, slide: int, panes: dict[int, int] | None = None, reported: int | None = None):
        self.size, self.slide = size, slide
        self.panes = panes or {}
        self.reported = reported

    def pane(self, t: int) -> int:
        return t - t % self.slide

    def counts(self, first: int, last: int) -> Iterator[tuple[int, int]]:
        """(end, count) of the windows with rows whose end lies in [first, last], by a running total."""
        panes = sorted(self.panes)
        total, enter, leave = 0, 0, 0
        end = first
        while end <= last:
            while enter < len(panes) and panes[enter] < end:
                total += self.panes[panes[enter]]
                enter += 1
            while leave < enter and panes[leave] < end - self.size:
                total -= self.panes[panes[leave]]
                leave += 1
            if total:
                yield end, total
                end += self.slide
            elif enter < len(panes):
                end = max(end, panes[enter]) + self.slide       # no window before holds a row
                end -= end % self.slide
            else:
                return

    def _next(self) -> int:
        """The first end that isn't reported; any end without rows before it is left out."""
        first = min(self.panes, default=0) + self.slide
        return first if self.reported is None else max(first, self.reported + self.slide)

    def due(self, until: int) -> list[tuple[int, int]]:
        """Windows not reported yet that end by ``until``; they count as reported from now on."""
        last = until - until % self.slide
        if self.reported is not None and last <= self.reported:
            return []
        out = list(self.counts(self._next(), last))
        self.reported = last
        return out

    def drop_before(self, first_end: int) -> None:
        """Forget panes that lie in no window with end ``first_end`` or later."""
        self.panes = {p: n for p, n in self.panes.items() if p + self.size >= first_end}

    def next_due(self) -> int | None:
        """The end of the next window to report."""
        last = max(self.panes, default=0) + self.size
        return next((e for e, _ in self.counts(self._next(), last)), None) if self.panes else None


class SlidingCounts(OneTimer):
    """Reports (key, window_end, cnt); see the module.  Input rows carry ``ts_us``.

    Without ``lateness_us`` each window is reported once, when the watermark
    reaches its end, and no row counts as late (an operator before has
    ordered them, or Spark has dropped them)."""

    def __init__(self, keys: list[str], size_us: int, slide_us: int, lateness_us: int | None, carried: list[str]):
        self.keys, self.size, self.slide = keys, size_us, slide_us
        self.lateness, self.carried = lateness_us, carried
        # a window whose last instant (a millisecond before its end) the watermark has reached is due
        self.slack = 0 if lateness_us is None else 1000

    def init(self, handle):
        super().init(handle)
        self.state = handle.getValueState("ring", "reported bigint, panes array<bigint>, counts array<bigint>")

    def _load(self) -> PaneRing:
        if not self.state.exists():
            return PaneRing(self.size, self.slide)
        reported, panes, counts = self.state.get()
        return PaneRing(self.size, self.slide, dict(zip(panes, counts)), reported)

    def _save(self, ring: PaneRing) -> None:
        """Store the ring and set the timer: when the next window is due, or when the last one closes."""
        if not ring.panes:
            self.state.clear()
            self._arm(None)
            return
        self.state.update((ring.reported, list(ring.panes), list(ring.panes.values())))
        due = ring.next_due()
        at = due - self.slack if due is not None else min(ring.panes) + self.size - self.slack + (self.lateness or 0)
        self._arm(-(-at // 1000))

    def _first_open(self, watermark: int) -> int:
        """The earliest window end that can still be refined."""
        closed = watermark + self.slack - (self.lateness or 0)
        return closed - closed % self.slide + self.slide

    def _rows(self, key, windows: Iterable[tuple[int, int]]) -> list[Row]:
        import datetime as dt
        base = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        empty = dict.fromkeys(self.carried)
        return [Row(**dict(zip(self.keys, key)), tag="count", window_end=base + dt.timedelta(microseconds=e), cnt=n, **empty)
                for e, n in windows]

    def handleInputRows(self, key, rows, timerValues):
        watermark = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
        ring, out = self._load(), []
        first_open = self._first_open(watermark)
        if self.lateness is not None:       # what has closed is reported without the rows that come now
            out += self._rows(key, ring.due(first_open - self.slide))
        refined: set[int] = set()
        for r in rows:
            pane = ring.pane(r["ts_us"])
            if self.lateness is not None:
                if pane + self.size < first_open:
                    out.append(Row(**dict(zip(self.keys, key)), tag="late", window_end=None, cnt=None,
                                   **{c: r[c] for c in self.carried}))
                    continue
                if pane < ring.reported:
                    refined.add(pane)
            ring.panes[pane] = ring.panes.get(pane, 0) + 1
        # windows that were reported, are open, and hold one of these panes
        ends = {e for p in refined for e in range(max(p + self.slide, first_open),
                                                  min(p + self.size, ring.reported) + self.slide, self.slide)}
        if ends:
            out += self._rows(key, ((e, n) for e, n in ring.counts(min(ends), max(ends)) if e in ends))
        self._save(ring)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()      # it has just fired
        ring = self._load()
        out = self._rows(key, ring.due(watermark + self.slack))
        first_open = self._first_open(watermark)
        ring.drop_before(first_open if self.lateness is not None else ring.reported + self.slide)
        self._save(ring)
        return iter(out)


def sliding_counts(df: DataFrame, keys, ts: str = "ts", size="1 hour", slide="5 minutes", lateness=None,
                   carried=()) -> DataFrame:
    """Sliding counts of a stream that has a watermark (see ``event_time``).

    Without ``lateness``: (keys..., window_end, cnt), each window with rows once,
    when the watermark reaches its end; late rows were dropped by Spark.

    With ``lateness`` (for queries in ``update`` mode): tagged rows.  ``count`` rows hold (keys..., window_end, cnt) and
    replace earlier ones of the same key and window; ``late`` rows hold the keys
    and the columns named in ``carried`` of an input row whose last window had
    closed (its end - 1 ms + ``lateness`` was not after the watermark, the greatest
    event time of earlier micro-batches minus the delay).

    ``size`` must be a multiple of ``slide``.  Rows without a time are in no window.
    """
    keys, carried = [keys] if isinstance(keys, str) else list(keys), list(carried)
    size_us, slide_us = duration_us(size), duration_us(slide)
    if size_us % slide_us:
        raise ValueError("size must be a multiple of slide")
    us = F.unix_micros(F.col(ts).cast("timestamp")).alias("ts_us")
    out = T.StructType([*(T.StructField(k, df.schema[k].dataType) for k in keys), T.StructField("tag", T.StringType()),
                        T.StructField("window_end", T.TimestampType()), T.StructField("cnt", T.LongType()),
                        *(T.StructField(c, df.schema[c].dataType) for c in carried)])
    if lateness is None:
        given = df.where(F.col(ts).isNotNull()).select(*keys, us, ts)
        counted = given.groupBy(*keys).transformWithState(
            SlidingCounts(keys, size_us, slide_us, None, []), out, "Append", "EventTime")
        return counted.select(*keys, "window_end", "cnt")
    # The watermark column is replaced by values computed from it, so that Spark keeps every row
    # for the operator to decide on; the watermark goes on advancing below.
    plain = [F.timestamp_micros(us).alias(c) if c == ts else F.col(c) for c in carried]
    given = df.where(F.col(ts).isNotNull()).select(*keys, us, *plain)
    return given.groupBy(*keys).transformWithState(
        SlidingCounts(keys, size_us, slide_us, duration_us(lateness), carried), out, "Update", "EventTime")
