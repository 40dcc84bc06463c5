"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells.

A vector belongs to every cell whose centre is within ``MARGIN`` of its
best one, so that near vectors on two sides of a border still meet; a pair
that meets in several cells counts in the first.  Vectors that are equal
component by component are one node with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written
from tidemark.llm.graph import components
from tidemark.llm.vectors import cosine, matrix, norms, one_per_id, sample_matrix

THRESHOLD = 0.9
# Documented bounds of what the cells are fitted on.
SAMPLE = 16_384
CELLS = 256
CELL_LEAST = 64         # sampled vectors that a cell stands for at least
ROUNDS = 8
#: Cells within this cosine of the best one.  Measured at 64 dimensions and 256 cells: of
#: pairs at 0.9 exactly 1 in 10^4 has no common cell, of pairs at 0.95 none in 10^4.
MARGIN = 0.15
BLOCK = 2048


def fit_cells(x: np.ndarray, cells: int = CELLS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres by spherical k-means; an empty cell restarts at the worst-placed vector."""
    cells = max(1, min(cells, len(x) // CELL_LEAST))
    centre = x[np.linspace(0, len(x) - 1, cells).astype(int)]
    for _ in range(rounds):
        s = x @ centre.T
        own, best = s.argmax(axis=1), s.max(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        length = norms(total)
        lost = np.flatnonzero(length < 1e-9)
        total[lost] = x[np.argsort(best)[:len(lost)]]
        centre = total / norms(total)[:, None]
    return centre


def near_cells(x: np.ndarray, centre: np.ndarray, margin: float = MARGIN) -> list[np.ndarray]:
    """The cells of each row: those within ``margin`` of its best."""
    s = (x / norms(x)[:, None]) @ centre.T
    row, cell = np.nonzero(s >= s.max(axis=1, keepdims=True) - margin)
    return np.split(cell.astype(np.int32), np.searchsorted(row, np.arange(1, len(x))))


def _bits(cells: list[np.ndarray]) -> np.ndarray:
    """Cell sets as rows of 64-bit words."""
    out = np.zeros((len(cells), CELLS // 64), "<u8")
    row = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    cell = np.concatenate(cells).astype(np.uint64)
    np.bitwise_or.at(out, (row, cell >> np.uint64(6)), np.uint64(1) << (cell & np.uint64(63)))
    return out


def _first_common(a: np.ndarray, b: np.ndarray, cell: int) -> np.ndarray:
    """Whether ``cell`` is the first that rows of ``a`` and ``b`` have in common."""
    both = a & b
    word, bit = cell >> 6, cell & 63
    below = both[:, word] & np.uint64((1 << bit) - 1)
    return (below == 0) & ~both[:, :word].any(axis=1)


def _compare(table: pa.Table) -> pa.Table:
    """(node, n, root) of vectors linked within one pair of blocks: the weight of what it is
    linked to (pairs of this cell alone), and a node it is connected to here."""
    cell, i, j = (table.column(c)[0].as_py() for c in ("cell", "i", "j"))
    ids, own = table.column("vec_id").to_numpy(), table.column("own").to_numpy()
    weight, x = table.column("weight").to_numpy(), matrix(table.column("vector"))
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), "<u8").reshape(len(ids), -1)
    unit = x / norms(x)[:, None]
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    n, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    hit = np.zeros(len(ids), bool)
    for at in range(0, len(left), 512):
        rows = left[at:at + 512]
        s = unit[rows] @ unit[right].T
        a, b = np.nonzero(s >= THRESHOLD - 1e-9)
        value = s[a, b]
        a, b = rows[a], right[b]
        sure = value >= THRESHOLD + 1e-9
        sure[~sure] = cosine(x[a[~sure]], x[b[~sure]]) >= THRESHOLD
        keep = sure & ((a < b) if i == j else (a != b))
        a, b = a[keep], b[keep]
        first = _first_common(bits[a], bits[b], cell)
        np.add.at(n, a[first], weight[b[first]])
        np.add.at(n, b[first], weight[a[first]])
        hit[a] = hit[b] = True
        while len(a):       # least root to both ends, until nothing changes
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            root = root[root]
            differ = root[a] != root[b]
            a, b = a[differ], b[differ]
    while not np.array_equal(root, root[root]):
        root = root[root]
    return pa.table({"node": pa.array(ids[hit]), "n": pa.array(n[hit]), "root": pa.array(ids[root][hit])})


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per id of ``df``.

    Vectors that are null, zero or not finite link with nothing, nor do those of another
    length than the usable one with the least id; of rows with one id the smallest usable
    vector counts; each row without an id is returned by itself, without links.  A large cell is compared in pairs of
    blocks, so it is no hot task.
    """
    every = written(one_per_id(df, id_col, vector_col), "vectors")
    good = every.where("ok")
    nodes = written(good.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight")), "nodes")
    x = sample_matrix(nodes.select("vec_id", "vector"), SAMPLE)
    shared = df.sparkSession.sparkContext.broadcast(fit_cells(x) if len(x) else None)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = near_cells(matrix(b.column(1)), shared.value)
                bits = [r.tobytes() for r in _bits(cells)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(cells, pa.list_(pa.int32())), pa.array(bits, pa.binary())],
                    names=["vec_id", "vector", "weight", "cells", "bits"])

    kind = dict(nodes.dtypes)["vector"]
    placed = written(nodes.select("vec_id", "vector", "weight")
                     .mapInArrow(place, f"vec_id bigint, vector {kind}, weight bigint, cells array<int>, bits binary"),
                     "placed")
    sizes = (placed.select(F.explode("cells").alias("cell")).groupBy("cell")
             .agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("k")))
    member = (placed.select(F.explode("cells").alias("cell"), "*").join(F.broadcast(sizes), "cell")     # CELLS rows
              .withColumn("own", F.pmod(F.xxhash64("vec_id"), "k").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
              .select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      "own", "vec_id", "weight", "vector", "bits"))
    met = written(member.groupBy("cell", "i", "j").applyInArrow(_compare, "node bigint, n bigint, root bigint"), "met")
    counts = met.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    names = roots.groupBy("root").agg(F.min("node").alias("component"))
    named = (nodes.join(counts, F.col("vec_id") == F.col("node"), "left").drop("node")
             .join(roots, F.col("vec_id") == F.col("node"), "left").drop("node")
             .join(names, "root", "left")
             .select("vector", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "vec_id").alias("component_id")))
    linked = good.join(named, "vector").select("vec_id", "n_links", "component_id")
    rest = every.where("not ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    nameless = df.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("bigint").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.lit(None).cast("bigint").alias("component_id"))
    return linked.unionByName(rest).unionByName(nameless).withColumn("kept", F.expr("vec_id <=> component_id"))
