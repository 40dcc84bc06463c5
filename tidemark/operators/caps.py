"""Daily click cap with a blacklist warning.

Per key and local calendar day, the first ``cap`` rows pass, the
``cap``-th row also raises a warning, the rest of that day is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.time import local_day


def _ranked(df: DataFrame, keys, ts: str, seq: str, cap: int, tz: str) -> DataFrame:
    """The first ``cap`` rows of each (keys, local day), ranked.

    The rank limit is applied in each task before the shuffle
    (``WindowGroupLimit``), so a hot key sends ``cap`` rows a task at most.
    Rows with a null key or time are groups of their own and are kept."""
    d = df.withColumn("local_day", local_day(ts, tz))
    w = Window.partitionBy(*keys, "local_day").orderBy(ts, seq)
    return d.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= cap)


def daily_cap(df: DataFrame, keys, ts: str = "ts", seq: str = "seq", cap: int = 100,
              tz: str = "Asia/Shanghai") -> DataFrame:
    """Rows that pass the cap (original columns plus ``local_day``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _ranked(df, keys, ts, seq, cap, tz).drop("_rank")


def daily_cap_warnings(df: DataFrame, keys, ts: str = "ts", seq: str = "seq", cap: int = 100,
                       tz: str = "Asia/Shanghai") -> DataFrame:
    """One warning row per (keys, local day) that reached the cap."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    r = _ranked(df, keys, ts, seq, cap, tz).where(F.col("_rank") == cap)
    return r.select(*keys, "local_day", F.col(ts).alias("warn_ts"), F.col(seq).alias("warn_seq"),
                    F.lit(f"clicked {cap} times or more today").alias("warning"))
