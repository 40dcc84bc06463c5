"""Replay helpers for bounded inputs.

A bounded file replay with ``availableNow`` stops before the final
watermark passes the last windows and timers.  ``write_replay_files``
deals a DataFrame to time slices, one file and so one micro-batch each, in
a single write, and adds two slices with one far-future row each, so the
last real windows close and all timers fire; callers filter the sentinel
key out.  The order of the slices is set in the files' times, which is what a
file stream goes by.
"""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.time import duration_us
from tidemark.session import scratch_path

#: The sentinel's time, or the last row's time plus the horizon, whichever is later.
SENTINEL_TS = dt.datetime(2100, 1, 1)
SLICE = "_slice"


def _position(df: DataFrame, col: str) -> F.Column:
    """A time (or a number) as a whole number."""
    kind = df.schema[col].dataType
    timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    return F.unix_micros(F.col(col).cast("timestamp")) if timed else F.col(col).cast("bigint")


def write_replay_files(df: DataFrame, n_files: int, sentinel: dict | None, ts: str = "ts",
                       path: str | None = None, order_col: str | None = None, horizon="400 days") -> str:
    """Write ``df`` as up to ``n_files`` time slices, in event-time order (or
    ``order_col`` order, e.g. an arrival time), plus two sentinel slices (none when
    ``sentinel`` is None); returns the root folder (read it with ``read_replay``).

    The sentinel lies ``horizon`` beyond the last row, so that must be longer than any
    window, timer and delay of the query.  Rows without a time come first.  The rows are
    read once for the range of times and once for the write."""
    spark = df.sparkSession
    root = path or scratch_path(spark, "replay")
    at = _position(df, order_col or ts)
    lo, hi, last = df.agg(F.min(at), F.max(at), F.max(F.col(ts).cast("timestamp"))).first()
    slice_no = F.lit(0) if lo is None or lo == hi else F.least(
        F.floor((at - F.lit(lo)) * F.lit(n_files) / F.lit(hi - lo)), F.lit(n_files - 1))
    placed = F.when(at.isNull(), F.lit(0)).otherwise(slice_no.cast("int"))
    rows = df.withColumn(SLICE, F.format_string("%07d", placed))
    if sentinel is not None:
        beyond = max([SENTINEL_TS] + [last + dt.timedelta(microseconds=duration_us(horizon))] * (last is not None))
        row = {c: None for c in df.columns} | sentinel
        for i in range(2):
            flush = spark.createDataFrame([tuple(row[c] for c in df.columns)], df.schema).withColumn(
                ts, F.lit(beyond.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(df.schema[ts].dataType))
            rows = rows.unionByName(flush.withColumn(SLICE, F.lit(f"{n_files + i:07d}")))
    rows.repartition(n_files + 2, SLICE).write.partitionBy(SLICE).parquet(root)
    _set_order(spark, root)
    return root


def _set_order(spark: SparkSession, root: str) -> None:
    """Give the slices' files times a second apart, in the order of their names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found, names = fs.listFiles(folder, True), []
    while found.hasNext():
        names.append(found.next().getPath())
    names = sorted((p for p in names if p.getName().startswith("part-")), key=lambda p: p.toString())
    start = int(time.time()) - len(names)
    for i, p in enumerate(names):
        fs.setTimes(p, (start + i) * 1000, -1)


def read_replay(spark: SparkSession, root: str, schema) -> DataFrame:
    """Stream the replay's slices one per micro-batch, in order."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(root))


def run_to_memory(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame over all available input and return the
    collected sink as a batch DataFrame."""
    spark = df.sparkSession
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def write_tagged(batch: DataFrame, batch_id: int, sinks: dict[str, str], tag_col: str = "tag",
                 fmt: str = "parquet") -> None:
    """``foreachBatch`` body fanning a tagged stream out to one folder per
    tag (the side outputs of the reference jobs).  Idempotent per batch:
    each batch writes under ``batch=<id>`` with overwrite, so a replayed
    batch after a failure replaces its own output."""
    for tag, path in sinks.items():
        (batch.where(F.col(tag_col) == tag).drop(tag_col).write.mode("overwrite")
         .format(fmt).save(os.path.join(path, f"batch={batch_id}")))
