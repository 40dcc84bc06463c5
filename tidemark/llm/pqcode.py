"""Vector codes by parts, their codebooks trained by Lloyd rounds over cover trees.

Vectors become integers (a fixed-point grid), are cut into equal consecutive
parts, and each part is coded by the nearest entry of its own codebook.
Every task turns its rows into blocks and builds, per block and part, a
cover tree once: each level's centres stand further apart than half their
parent's radius and cover its points within it.  Points lie in tree order,
so a subtree is a stretch of rows and its sum a difference of cumulative
sums.  In a round a node whose nearest entry is nearer by more than twice
the node's radius than any other gives its whole subtree to it (triangle
inequality); only ambiguous nodes descend, and only the points of ambiguous
last nodes are compared one by one.  All of that in whole numbers, so
results don't depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written

GRID = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK_ROWS = 1024           # rows of a block, whose trees are held together
LEAF_POINTS = 16            # a node of no more points isn't split
ARROW_BYTES = 1 << 24       # of blocks handed to a task's Python at once


def usable(col: str) -> F.Column:
    """Whether a vector takes part: not null, all components finite."""
    return F.coalesce(~F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def bound(dimension: int) -> int:
    """The largest magnitude of a component for which no squared distance leaves 64 bits."""
    return int((2 ** 61 / max(1, dimension)) ** 0.5)


def to_grid(vectors: list, dimension: int, parts: int) -> np.ndarray:
    """Rows of whole numbers, shorter vectors and the last part filled up with zeros."""
    width = -(-dimension // parts)
    out = np.zeros((len(vectors), width * parts), np.int64)
    top = bound(dimension)
    with np.errstate(over="ignore"):
        for row, v in zip(out, vectors):
            row[:len(v)] = np.clip(np.floor(np.asarray(v, np.float64) * GRID), -top, top)
    return out


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each entry, exact."""
    out = np.zeros((len(points), len(entries)), np.int64)
    for k in range(points.shape[1]):
        out += (points[:, k, None] - entries[None, :, k]) ** 2
    return out


@dataclass(frozen=True)
class CoverTree:
    """``order``: rows in tree order.  Node i covers the stretch [begin, end) of them within
    sqrt(reach) of row ``centre``; its children are the nodes [first, last)."""
    order: np.ndarray
    centre: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray
    reach: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, leaf_points: int = LEAF_POINTS) -> CoverTree:
        order = np.arange(len(points))
        nodes: list[list[int]] = []

        def node(centre: int, begin: int, end: int, reach: int) -> None:
            nodes.append([centre, begin, end, 0, 0, reach])

        if len(points):
            node(0, 0, len(points), int(squares(points, points[:1]).max()))
        at = 0
        while at < len(nodes):
            centre, begin, end, _, _, reach = nodes[at]
            if reach and end - begin > leaf_points:
                rest = order[begin:end].copy()
                first, stretch, pick = len(nodes), begin, centre     # a node's centre is its first child's
                while len(rest):
                    d = squares(points[rest], points[pick:pick + 1])[:, 0]
                    near = d <= reach // 4
                    child = rest[near]
                    order[stretch:stretch + len(child)] = child
                    node(pick, stretch, stretch + len(child), int(d[near].max()))
                    stretch += len(child)
                    rest = rest[~near]
                    pick = int(rest[0]) if len(rest) else -1
                nodes[at][3:5] = first, len(nodes)
            at += 1
        return cls(order, *np.array(nodes, np.int64).reshape(-1, 6).T)

    def assign(self, points: np.ndarray, entries: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
        """Stretches (begin, end, entry) given whole, and the tree-order places compared one by
        one with their entries.  Nearest by squared distance, ties to the lower index."""
        whole: list[tuple[int, int, int]] = []
        single: list[np.ndarray] = []
        # an entry equal to an earlier one is never nearest
        own = np.sort(np.unique(entries, axis=0, return_index=True)[1])
        level = np.arange(min(1, len(self.centre)))
        while len(level):
            d = squares(points[self.centre[level]], entries[own])
            best = d.argmin(axis=1)
            far = np.sqrt(d.astype(np.float64))
            least = far[np.arange(len(level)), best]
            far[np.arange(len(level)), best] = np.inf
            # rounding is far below the slack, so what passes is nearer in exact numbers too
            slack = 2 * np.sqrt(self.reach[level].astype(np.float64))
            sure = far.min(axis=1) - least > slack + 1e-6 + 1e-9 * (slack + least)
            whole += zip(self.begin[level[sure]].tolist(), self.end[level[sure]].tolist(), own[best[sure]].tolist())
            level = level[~sure]
            last = self.first[level] == self.last[level]
            single += [np.arange(b, e) for b, e in zip(self.begin[level[last]], self.end[level[last]])]
            spread = [np.arange(a, b) for a, b in zip(self.first[level[~last]], self.last[level[~last]])]
            level = np.concatenate(spread) if spread else np.zeros(0, np.int64)
        places = np.concatenate(single) if single else np.zeros(0, np.int64)
        return whole, places, own[squares(points[self.order[places]], entries[own]).argmin(axis=1)] if len(places) \
            else places

    def nearest(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """The entry of each point."""
        whole, places, found = self.assign(points, entries)
        out = np.zeros(len(points), np.int64)
        for begin, end, entry in whole:
            out[self.order[begin:end]] = entry
        out[self.order[places]] = found
        return out

    def sums(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points and their sum by entry; a whole stretch's sum is a difference of cumulative sums."""
        whole, places, found = self.assign(points, entries)
        ordered = points[self.order]
        count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        if whole:
            begin, end, entry = np.array(whole).T
            running = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(ordered, axis=0)))
            np.add.at(count, entry, end - begin)
            np.add.at(total, entry, running[end] - running[begin])
        np.add.at(count, found, 1)
        np.add.at(total, found, ordered[places])
        return count, total

    def pack(self) -> bytes:
        return np.concatenate(([len(self.order), len(self.centre)], self.order, self.centre, self.begin, self.end,
                               self.first, self.last, self.reach)).astype("<i8").tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> CoverTree:
        flat = np.frombuffer(raw, "<i8")
        points, nodes = flat[:2]
        return cls(flat[2:2 + points], *flat[2 + points:].reshape(6, nodes))


_BLOCKS = "vec_ids array<bigint>, labels array<string>, points binary, trees array<binary>"


def _blocks(dimension: int, parts: int, block_rows: int) -> Callable:
    def block(rows: list[tuple]) -> pa.RecordBatch:
        x = to_grid([v for _, _, v in rows], dimension, parts)
        trees = [CoverTree.build(p).pack() for p in np.split(x, parts, axis=1)]
        return pa.RecordBatch.from_arrays(
            [pa.array([[i for i, _, _ in rows]], pa.list_(pa.int64())),
             pa.array([[k for _, k, _ in rows]], pa.list_(pa.string())),
             pa.array([x.astype("<i8").tobytes()], pa.binary()), pa.array([trees], pa.list_(pa.binary()))],
            names=["vec_ids", "labels", "points", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for b in batches:
            waiting += zip(*(b.column(i).to_pylist() for i in range(3)))
            while len(waiting) >= block_rows:
                yield block(waiting[:block_rows])
                waiting = waiting[block_rows:]
        if waiting:
            yield block(waiting)
    return run


def _read(b: pa.RecordBatch, i: int, parts: int) -> tuple[list[np.ndarray], list[CoverTree]]:
    """Points by part, and trees, of the block in row ``i``."""
    x = np.frombuffer(b.column("points")[i].as_py(), "<i8").reshape(len(b.column("vec_ids")[i]), -1)
    return (list(np.split(x, parts, axis=1)), [CoverTree.unpack(t) for t in b.column("trees")[i].as_py()])


_SUMS = "part int, entry int, component int, count bigint, total bigint"


def _block_sums(books: np.ndarray) -> Callable:
    """Count and sum by part and entry of a task's blocks, a row a component."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                points, trees = _read(b, i, parts)
                found = [t.sums(p, book) for t, p, book in zip(trees, points, books)]
                count = np.repeat(np.array([c for c, _ in found]).ravel(), width)
                part, entry, component = (g.ravel() for g in np.indices(books.shape))
                some = count > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[some], pa.int32()), pa.array(entry[some], pa.int32()),
                     pa.array(component[some], pa.int32()), pa.array(count[some], pa.int64()),
                     pa.array(np.array([s for _, s in found]).ravel()[some], pa.int64())],
                    names=[c.split()[0] for c in _SUMS.split(", ")])
    return run


_CODES = "vec_id bigint, label string, code string, error bigint"


def _block_codes(books: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                points, trees = _read(b, i, len(books))
                found = [t.nearest(p, book) for t, p, book in zip(trees, points, books)]
                error = sum(((p - book[f]) ** 2).sum(axis=1) for p, book, f in zip(points, books, found))
                codes = np.array(found).T.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_ids")[i].values, b.column("labels")[i].values,
                     pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())],
                    names=[c.split()[0] for c in _CODES.split(", ")])
    return run


def train(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` of Lloyd; an entry without points stays."""
    for _ in range(rounds):
        sums = (blocks.mapInArrow(_block_sums(books), _SUMS).groupBy("part", "entry", "component")
                .agg(F.sum("count").alias("count"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        books = books.copy()
        for r in sums.collect():                # no more rows than the codebooks have components
            books[r["part"], r["entry"], r["component"]] = int(r["total"]) // r["count"]
    return books


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels.  Labels of at least 1/1024 of the
    rows (so at most 1,024) are broadcast, the others joined, so no hot label is one task."""
    labels = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("_n"))
    labels = written(labels, "labels").withColumnRenamed("label", "_label")
    rows = labels.agg(F.sum("_n")).first()[0] or 0
    heavy = F.broadcast(labels.where(F.col("_n") * 1024 >= rows))
    same = F.col("label").eqNullSafe(F.col("_label"))
    often = coded.join(heavy, same)
    seldom = coded.join(heavy, same, "left_anti").join(labels.where(F.col("_n") * 1024 < rows), same)
    return often.unionByName(seldom).drop("_label", "_n")


def encode(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256, label) per usable row of ``df``.

    Rows whose vector is null or holds null or non-finite components are left
    out.  Every other row is coded, repeated ids included; equal ids are ordered by their
    vectors where the first codebook is drawn, null ids come last.  Fewer rows than
    ``entries`` give a smaller codebook.  Vectors shorter than the longest count as ending
    in zeros, as does the last part where the length isn't a multiple of ``parts``; empty
    vectors are zeros.  Components beyond :func:`bound` on the grid (46,340 before scaling
    at 64 components) stay at it, so that distances fit.  Null labels are one label, and a
    label's error that leaves 64 bits is null.  An empty table gives no rows.  Columns with other names are not read.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    kept = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("vector")).where(usable("vector"))
    dimension = kept.agg(F.max(F.size("vector"))).first()[0] or parts
    blocks = written(kept.mapInArrow(_blocks(dimension, parts, block_rows), _BLOCKS), "blocks")
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    start = to_grid([r["vector"] for r in first], dimension, parts)
    books = np.stack(np.split(start, parts, axis=1))
    if first:
        books = train(blocks, books, rounds)
    coded = written(blocks.mapInArrow(_block_codes(books), _CODES), "codes")
    label_type = df.schema[label_col].dataType
    return _with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"),
        F.col("label").cast(label_type).alias("label"))
