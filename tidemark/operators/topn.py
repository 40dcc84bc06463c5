"""Top-N per window.

Batch: ``row_number() <= N`` over ``(window_end)`` ordered by count desc,
key asc.  Spark plans this with a partial ``WindowGroupLimit`` before the
shuffle, so each map task ships at most N rows per window: the final
ranking of a window never sees more than ``N x map partitions`` rows, no
matter how many keys the window holds.

Streaming: ranking functions are not supported on streams;
``tidemark.streaming.windows.topn_sink`` ranks the windows that an
append-mode count finished in a micro-batch, by the same rank limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def topn_per_window(counts: DataFrame, key: str, n: int = 5, window_col: str = "window_end",
                    count_col: str = "cnt", rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(window_col).orderBy(F.col(count_col).desc(), F.col(key).asc())
    return (counts.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def topn_report(topn: DataFrame, key: str, window_col: str = "window_end", count_col: str = "cnt",
                rank_col: str = "rank", key_label: str = "ItemId") -> DataFrame:
    """Rank lines as text: ``TOP i <label>=<key> heat=<count>`` plus the
    window end rendered like ``java.sql.Timestamp.toString``."""
    from tidemark.functions.time import java_ts_string
    return topn.select(
        window_col, rank_col, key, count_col,
        java_ts_string(window_col).alias("window_end_text"),
        F.format_string(f"TOP %d {key_label}=%s heat=%d", F.col(rank_col),
                        F.col(key).cast("string"), F.col(count_col)).alias("line"))
