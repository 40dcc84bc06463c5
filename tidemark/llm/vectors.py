"""Helpers for embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import hashed_sample


def usable(col: str) -> Column:
    """Whether a vector takes part: not null or zero, all components finite."""
    odd = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(col, lambda x: x != 0), F.lit(False))


def one_per_id(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, ok) per id that isn't null: its smallest usable vector, if it has one (``ok``),
    else its smallest.  A usable vector must also have the length of the usable one with the least id."""
    rows = (df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
            .where("vec_id is not null").withColumn("ok", usable("vector")))
    least = rows.where("ok").agg(F.min(F.struct("vec_id", F.size("vector").alias("size"))).alias("m")).first()["m"]
    good = F.min(F.when(F.col("ok") & (F.size("vector") == (least["size"] if least else 0)), F.col("vector")))
    return rows.groupBy("vec_id").agg(F.coalesce(good, F.min("vector")).alias("vector"), good.isNotNull().alias("ok"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of one length as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows with rows, in double precision, the same for equal rows wherever they stand."""
    return (a * b).sum(axis=1) / (norms(a) * norms(b))


def sample_matrix(vectors: DataFrame, want: int) -> np.ndarray:
    """Unit rows of a hashed sample of about ``want`` vectors, in the order of their ids;
    vectors of another length than the first are left out."""
    rows = hashed_sample(vectors.withColumn("_all", F.lit(0)), ["vec_id"], "_all", want).select(
        "vec_id", "vector").collect()
    rows = sorted((r["vec_id"], r["vector"]) for r in rows)
    x = np.array([v for _, v in rows if len(v) == len(rows[0][1])], dtype=np.float64).reshape(
        -1, len(rows[0][1]) if rows else 1)
    return x / norms(x)[:, None] if len(x) else x
