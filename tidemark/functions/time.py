"""Time helpers: durations, epoch-micro arithmetic, calendar days.

Windows are epoch aligned with offset 0 (``[start, end)``), as in Spark's
``window()``.  All arithmetic is on epoch microseconds so that both
``timestamp`` and ``timestamp_ntz`` inputs work; the session zone is UTC, so
casting ``timestamp_ntz`` to ``timestamp`` keeps the wall-clock value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

_UNIT_US = {
    "microsecond": 1, "millisecond": 1000, "ms": 1000, "second": 1_000_000, "s": 1_000_000,
    "sec": 1_000_000, "minute": 60_000_000, "min": 60_000_000, "m": 60_000_000,
    "hour": 3_600_000_000, "h": 3_600_000_000, "day": 86_400_000_000, "d": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(spec) -> int:
    """'1 day', '6 hours', '5 s', 300 (seconds), or a timedelta -> microseconds."""
    if isinstance(spec, (int, float)):
        return int(round(spec * 1_000_000))
    if hasattr(spec, "total_seconds"):
        return int(round(spec.total_seconds() * 1_000_000))
    total = 0
    parts = re.findall(r"(\d+(?:\.\d+)?)\s*([a-zA-Z]+)", str(spec))
    if not parts:
        raise ValueError(f"bad duration {spec!r}")
    for num, unit in parts:
        u = unit.lower()
        if u not in _UNIT_US and u.endswith("s"):
            u = u[:-1]
        if u not in _UNIT_US:
            raise ValueError(f"bad duration unit in {spec!r}")
        total += int(round(float(num) * _UNIT_US[u]))
    return total


def interval(spec) -> Column:
    """A day-time interval literal column for ``spec``."""
    us = duration_us(spec)
    # A literal (not a function call), so that stream-stream joins can read
    # it as a constant range bound for state eviction.
    return F.expr(f"INTERVAL {us} MICROSECONDS")


def to_micros(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def from_micros(c, ntz: bool = True) -> Column:
    out = F.timestamp_micros(c)
    return out.cast("timestamp_ntz") if ntz else out


def ts_type_of(df: DataFrame, col: str) -> bool:
    """True when ``col`` is ``timestamp_ntz``."""
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def java_ts_string(c) -> Column:
    """``java.sql.Timestamp.toString`` rendering for whole-millisecond
    values: ``yyyy-MM-dd HH:mm:ss.S`` with trailing zeros of the fraction
    dropped (at least one digit)."""
    c = F.col(c) if isinstance(c, str) else c
    base = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    frac = F.regexp_replace(F.date_format(c, "SSS"), "0+$", "")
    return F.concat(base, F.lit("."), F.when(frac == "", F.lit("0")).otherwise(frac))


def local_day(c, tz: str = "Asia/Shanghai") -> Column:
    """Calendar day of a UTC instant in zone ``tz``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.from_utc_timestamp(c.cast("timestamp"), tz))


def next_local_midnight(c, tz: str = "Asia/Shanghai", ntz: bool = True) -> Column:
    """The UTC instant of the next local midnight after ``c``."""
    c = F.col(c) if isinstance(c, str) else c
    local_mid = F.date_add(local_day(c, tz), 1).cast("timestamp")
    out = F.to_utc_timestamp(local_mid, tz)
    return out.cast("timestamp_ntz") if ntz else out
