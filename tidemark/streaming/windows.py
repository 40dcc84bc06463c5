"""Streaming windowed counts, top-N of finished windows, distinct users and the
upserting late-refined top-N sink."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.hashing import salt as salt_expr
from tidemark.functions.time import duration_us
from tidemark.session import reliable_checkpoint
from tidemark.streaming.upserts import UpsertTable


def _no_table(error: AnalysisException) -> bool:
    """Whether a read failed because nothing was written yet; any other error must surface."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def event_time(df: DataFrame, ts: str = "ts", delay="0 seconds") -> DataFrame:
    """Watermark on ``ts``; ``timestamp_ntz`` is cast to ``timestamp`` first
    (watermarks need it; the session zone is UTC, so values are kept)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{duration_us(delay)} microseconds")


def sliding_count_stream(df: DataFrame, keys, ts: str = "ts", size="1 hour", slide="5 minutes",
                         panes: bool = False) -> DataFrame:
    """Windowed count keeping the ``w`` window struct (needed by a chained
    aggregation as its event-time column).

    Pane form (``panes=True``; size a multiple of slide): count per
    slide-wide tumbling pane, then a chained windowed sum over
    ``window_time(pane)`` (the pane's last instant, which lies in exactly
    the windows that contain the pane).  The pane form chains two stateful
    aggregations, which Spark allows in append mode only; the direct form
    serves ``update`` mode too."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us, slide_us = duration_us(size), duration_us(slide)
    if panes and size_us % slide_us:
        raise ValueError("pane form needs size to be a multiple of slide")
    sz, sl = f"{size_us} microseconds", f"{slide_us} microseconds"
    if not panes:
        return df.groupBy(F.window(F.col(ts), sz, sl).alias("w"), *keys).agg(F.count(F.lit(1)).alias("cnt"))
    pc = df.groupBy(F.window(F.col(ts), sl).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    return (pc.groupBy(F.window(F.window_time("pane"), sz, sl).alias("w"), *keys)
            .agg(F.sum("_n").cast("bigint").alias("cnt")))


def finished_counts(counts: DataFrame, key: str) -> DataFrame:
    """``(window_end, key, cnt)`` of ``sliding_count_stream`` in append mode, for ``topn_sink``."""
    return counts.select(F.col("w.end").alias("window_end"), key, F.col("cnt").cast("bigint").alias("cnt"))


def topn_sink(batch: DataFrame, batch_id: int, path: str, key: str, n: int = 5) -> None:
    """``foreachBatch`` body for append-mode counts: a window's keys all
    finish in the same micro-batch, so its best ``n`` follow by a rank limit
    (applied before the shuffle too), with no window gathered anywhere.  Rows
    ``(window_end, rank, key, cnt)`` go to ``path/batch=<id>``, overwritten when the
    batch is replayed."""
    topn_from_counts(batch, key, n).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def uv_stream(df: DataFrame, user="user_id", ts: str = "ts", size="1 hour") -> DataFrame:
    """Exact distinct users per tumbling window on a stream: deduplicate
    (window, user) within the watermark, then count per window (chained,
    append mode).  ``user`` may be any expression of one, such as its
    bitmap offset.  State is one row per (window, user) until the window
    closes; ``approx_count_distinct`` is the fixed-memory alternative."""
    w = F.window(F.col(ts), f"{duration_us(size)} microseconds")
    who = F.col(user) if isinstance(user, str) else user
    firsts = df.select(w.alias("w"), who.alias("who")).dropDuplicates(["w", "who"])
    return firsts.groupBy("w").agg(F.count(F.lit(1)).alias("uv")).select(
        F.col("w.end").alias("window_end"), "uv")


def salted_count_stream(df: DataFrame, ts: str = "ts", size="1 hour", buckets: int = 8, salt_cols=("seq",),
                        out: str = "cnt") -> DataFrame:
    """(window_end, count) of all rows per tumbling window in two chained aggregations (append
    mode): per (window, salt), then per window, which sees ``buckets`` rows a window."""
    sz = f"{duration_us(size)} microseconds"
    first = df.groupBy(F.window(F.col(ts), sz).alias("w"), salt_expr(list(salt_cols), buckets).alias("salt")).agg(
        F.count(F.lit(1)).alias("_n"))
    total = first.groupBy(F.window(F.window_time("w"), sz).alias("w")).agg(F.sum("_n").cast("bigint").alias(out))
    return total.select(F.col("w.end").alias("window_end"), out)


def upsert_counts(batch: DataFrame, batch_id: int, path: str, keys=("window_end", "url")) -> None:
    """``foreachBatch`` body for ``update`` mode: the batch holds the latest counts of changed
    (window, key) pairs, which replace earlier ones in the :class:`UpsertTable` at ``path``."""
    UpsertTable(batch.sparkSession, path, keys).commit(batch, batch_id)


def topn_from_counts(counts: DataFrame, key: str, n: int = 5) -> DataFrame:
    w = Window.partitionBy("window_end").orderBy(F.col("cnt").desc(), F.col(key).asc())
    return (counts.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)
            .select("window_end", "rank", key, "cnt"))


def uv_upsert(batch: DataFrame, batch_id: int, path: str) -> None:
    """``foreachBatch`` body for an ``update``-mode UV stream: keep the
    latest ``(window_end, uv)`` per window in a parquet table."""
    upsert_counts(batch, batch_id, path, keys=("window_end",))


def split_late_batch(batch: DataFrame, batch_id: int, state_path: str, out_path: str,
                     ts: str = "ts", order: str = "seq", size="10 minutes", slide=None,
                     disorder="2 seconds", lateness="60 seconds", seq: str = "seq") -> None:
    """``foreachBatch`` body delivering the late rows Spark would drop.

    The watermark a row sees is the max event time of all earlier rows
    (previous batches: a one-row state table per batch under
    ``state_path``; this batch: the prefix max in ``order``) minus
    ``disorder``.  Rows whose windows are all closed go to
    ``out_path/late/batch=<id>``, the rest to ``out_path/on_time/batch=<id>``;
    both are overwritten when a batch is replayed.
    """
    from tidemark.functions.time import interval
    from tidemark.operators.late import ONE_MS, latest_window_end
    from tidemark.operators.sequence import running_max_before
    from tidemark.functions.time import ts_type_of
    import os
    spark = batch.sparkSession
    try:
        prev = (spark.read.parquet(state_path).where(F.col("batch") < batch_id)
                .agg(F.max("max_ts")).first()[0])
    except AnalysisException as e:
        if not _no_table(e):
            raise
        prev = None
    d = running_max_before(batch, order, seq, ts, "_mx")
    carried = F.lit(prev).cast(batch.schema[ts].dataType) if prev is not None else F.lit(None).cast(
        batch.schema[ts].dataType)
    best = F.greatest(F.col("_mx"), carried)  # greatest skips NULLs
    wm = best - interval(disorder)
    last_end = latest_window_end(ts, size, slide, ts_type_of(batch, ts))
    closed = F.coalesce(last_end - interval(ONE_MS) + interval(lateness) <= wm, F.lit(False))
    marked = d.withColumn("is_late", closed).drop("_mx")
    marked = reliable_checkpoint(marked)
    marked.where("is_late").write.mode("overwrite").parquet(os.path.join(out_path, "late", f"batch={batch_id}"))
    marked.where("NOT is_late").write.mode("overwrite").parquet(
        os.path.join(out_path, "on_time", f"batch={batch_id}"))
    mx = batch.agg(F.max(ts).alias("max_ts")).withColumn("batch", F.lit(batch_id))
    mx.write.mode("overwrite").parquet(os.path.join(state_path, f"b={batch_id}"))


def upsert_topn(batch: DataFrame, batch_id: int, counts_path: str, topn_path: str, key: str = "url",
                n: int = 5) -> None:
    """``foreachBatch`` body for the late-refined top-N: commit the changed (window, key) counts, re-rank
    the windows this batch touched, and commit their rows, which replace the windows' earlier
    ones.  Each of the two tables knows the batch by its id, so a replay completes what is missing.

    Counts only grow, so a key outside a window's best ``n`` can enter only with a count that this
    batch brings: the new best are among the old best and the batch's rows, and the counts table
    is never read again."""
    spark = batch.sparkSession
    counts, top = UpsertTable(spark, counts_path, ("window_end", key)), UpsertTable(spark, topn_path, ("window_end",))
    cached = batch.persist()
    try:
        counts.commit(cached, batch_id)
        rows = cached.select("window_end", key, "cnt")
        days = [r[0] for r in cached.select(F.to_date("window_end")).distinct().collect()]      # days of one batch
        best = top.read(days) if days else None
        if best is not None:
            touched = best.join(rows.select("window_end").distinct(), "window_end", "left_semi")
            rows = rows.unionByName(touched.select("window_end", key, "cnt").join(
                rows.select("window_end", key), ["window_end", key], "left_anti"))
        top.commit(topn_from_counts(rows, key, n), batch_id)
    finally:
        cached.unpersist()
