"""Helpers shared by the operators: table reads, written intermediates, batch text access."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path

# Rows per Arrow batch handed to Python: documents can be long, so batches stay small.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read
    back: computed once, lineage cut, survives the loss of an executor."""
    path = scratch_path(df.sparkSession, name)
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []


def clean_up(spark: SparkSession) -> int:
    """Delete all that :func:`written` wrote in this process, and tell how many tables.  A
    result reads some of them: call this when the results have been used or saved."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    gone = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def id_crc(id_col: str) -> Column:
    """crc32 of the id's decimal text, the key of every train / held-out split."""
    return F.crc32(F.col(id_col).cast("string"))


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes per row, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; looked up where the code runs."""
    import public_tokenizers
    return public_tokenizers.path(name)


def hashed_sample(df: DataFrame, keys: list[str], group: str, want: int) -> DataFrame:
    """About ``want`` rows of each ``group`` value, chosen by a hash of ``keys``:
    group counts set the share, so no shuffle of rows and no hot group.
    A group of no more than ``want`` rows is taken whole."""
    counts = df.groupBy(group).count().select(F.col(group).alias("_g"), F.col("count").alias("_n"))
    h = F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (df.join(F.broadcast(counts), F.col(group) == F.col("_g"))
            .where(h * F.col("_n") < want).drop("_g", "_n"))


__all__ = ["BATCH_ROWS", "table", "written", "clean_up", "id_crc", "text_bytes", "tokenizer_path",
           "hashed_sample"]
