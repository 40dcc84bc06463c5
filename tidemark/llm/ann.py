"""Approximate nearest neighbours over learned partitions.

A neighbour graph of a sample is cut into balanced parts that keep
neighbours together; a small neural classifier learns the parts from the
vectors.  Every vector is filed under its most probable part; a query is
sent to several and its candidates there are ranked by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import written
from tidemark.llm.vectors import cosine, matrix, norms, one_per_id, sample_matrix

# Documented bounds of what the index is fitted on.
SAMPLE = 8192
PARTS = 32
PART_LEAST = 128        # sampled vectors that a part stands for at least
NEIGHBOURS = 10
RECALL = 0.97           # share of a sampled query's neighbours whose parts are searched
WORST_RECALL = 0.8      # the same of all but the worst hundredth of the queries
K = 5
QUERY_STEP = 50
BLOCK, QUERY_BLOCK = 4096, 512


@dataclass(frozen=True)
class Router:
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable parts of each row."""
        return np.argsort(-self.logits(x / norms(x)[:, None]), axis=1, kind="stable")[:, :n]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` nearest other rows of each unit row."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 1024):
        s = x[i:i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Parts of about equal size that cut few edges: grown around spread-out seeds,
    then refined by moving vertices to the part of most of their neighbours while
    there is room (the surest moves first)."""
    n, room = len(x), int(np.ceil(len(x) / parts * 1.05))
    seeds = [0]
    nearest = x @ x[0]
    for _ in range(parts - 1):
        seeds.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[seeds[-1]])
    centre, part = x[seeds], np.zeros(n, np.int64)
    votes = x @ centre.T
    back = np.repeat(np.arange(n), graph.shape[1])
    for r in range(rounds):
        order = np.argsort(-(votes.max(axis=1) - np.partition(votes, -2, axis=1)[:, -2]), kind="stable")
        choice, size = np.argsort(-votes, axis=1, kind="stable"), np.zeros(parts, np.int64)
        for i in order.tolist():
            for p in choice[i].tolist():
                if size[p] < room:
                    part[i] = p
                    size[p] += 1
                    break
        centre = np.stack([x[part == p].sum(axis=0) for p in range(parts)])
        centre /= np.maximum(norms(centre), 1e-12)[:, None]
        votes = np.zeros((n, parts))
        np.add.at(votes, (back, part[graph.ravel()]), 1.0)          # edges both ways
        np.add.at(votes, (graph.ravel(), part[back]), 1.0)
        votes += (x @ centre.T) * graph.shape[1] / 2 + 0.5 * np.eye(parts)[part]
    return part


def train(x: np.ndarray, target: np.ndarray, width: int = 128, epochs: int = 40, seed: int = 5) -> list[np.ndarray]:
    """A network with one hidden layer, fitted to part probabilities by Adam."""
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], width)), np.zeros(width),
         rng.normal(0, np.sqrt(1 / width), (width, target.shape[1])), np.zeros(target.shape[1])]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    x = x * np.sqrt(x.shape[1])
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            b = order[i:i + 256]
            h = np.maximum(x[b] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - target[b]) / len(b)
            dh = (d @ w[2].T) * (h > 0)
            t += 1
            for j, g in enumerate((x[b].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[j] += 0.1 * (g - m[j])
                v[j] += 0.001 * (g * g - v[j])
                w[j] -= 2e-3 * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
    w[0] = w[0] * np.sqrt(x.shape[1])
    return w


def fit(vectors: DataFrame, sample: int = SAMPLE, parts: int = PARTS, recall: float = RECALL) -> Router | None:
    """The router of (vec_id, vector) rows, from a sample; ``None`` without vectors."""
    x = sample_matrix(vectors, sample)
    # equal vectors count once: a common one must not decide for all others how many parts to search
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]
    if not len(x):
        return None
    parts = max(1, min(parts, len(x) // PART_LEAST))
    if parts == 1:
        d = x.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    fitted = np.arange(len(x)) % 8 != 7         # the others tell how many parts to search
    k = min(NEIGHBOURS, int(fitted.sum()) - 1)
    y = x[fitted]
    graph = neighbour_graph(y, k)
    part = balanced_parts(y, graph, parts)
    target = np.zeros((len(y), parts))
    np.add.at(target, (np.repeat(np.arange(len(y)), k), part[graph.ravel()]), 0.5 / k)
    target[np.arange(len(y)), part] += 0.5
    router = Router(*train(y, target), probes=parts)
    near = neighbour_graph(x, min(K, len(x) - 1))
    filed, rank = router.parts(x, 1)[:, 0], np.empty((len(x), parts), np.int64)
    np.put_along_axis(rank, router.parts(x, parts), np.arange(parts)[None, :], axis=1)
    where = rank[np.arange(len(x))[:, None], filed[near]][~fitted]
    # enough parts for the mean, and for all but the worst hundredth of the queries
    each = np.array([(where < p).mean(axis=1) for p in range(1, parts + 1)])
    enough = (each.mean(axis=1) >= recall) & (np.quantile(each, 0.01, axis=1) >= WORST_RECALL)
    return Router(router.hidden, router.hidden_bias, router.out, router.out_bias, int(np.argmax(enough)) + 1)


def _rank(table: pa.Table) -> pa.Table:
    """The ``K`` nearest candidates of each query in one block."""
    query = table.column("query").to_numpy(zero_copy_only=False).astype(bool)
    ids, x = table.column("vec_id").to_numpy(), matrix(table.column("vector"))
    qi, q, ci, c = ids[query], x[query], ids[~query], x[~query]
    out: list[tuple] = []
    if len(qi) and len(ci):
        s = (q / norms(q)[:, None]) @ (c / norms(c)[:, None]).T
        s[qi[:, None] == ci[None, :]] = -np.inf
        k = min(K, len(ci))
        floor = np.partition(s, len(ci) - k, axis=1)[:, len(ci) - k] - 1e-9
        for i in range(len(qi)):
            close = np.flatnonzero((s[i] >= floor[i]) & np.isfinite(s[i]))
            exact = cosine(np.broadcast_to(q[i], (len(close), q.shape[1])), c[close])
            for j in np.lexsort((ci[close], -exact))[:K]:
                out.append((int(qi[i]), int(ci[close][j]), float(exact[j])))
    return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()),
                     "vec_id": pa.array([o[1] for o in out], pa.int64()),
                     "score": pa.array([o[2] for o in out], pa.float64())})


def search(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           query_step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found other vectors of each row
    whose id is divisible by ``query_step``, ranked by cosine, ties by smaller id.

    Vectors that are null, zero or not finite take no part, nor do those of another length
    than the usable one with the least id; of rows with one id the smallest usable
    vector counts; null ids take no part; a table without vectors gives no rows.  A part
    with many vectors is searched in blocks, so copies make no hot task.  Queries whose
    parts hold fewer than ``K`` others are searched again in all parts.
    """
    vectors = written(one_per_id(df, id_col, vector_col).where("ok").drop("ok"), "vectors")
    router = fit(vectors)
    if router is None:
        return vectors.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "0D AS score").where("false")
    shared = df.sparkSession.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ranked = shared.value.parts(matrix(b.column(1)), shared.value.probes).astype(np.int32)
                ranked = pa.array(list(ranked), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ranked], names=["vec_id", "vector", "parts"])

    kind = dict(vectors.dtypes)["vector"]
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)
                .select("query_id", "rank", "vec_id", "score"))
    routed = written(vectors.mapInArrow(route, f"vec_id bigint, vector {kind}, parts array<int>"), "routed")
    is_query = F.col("vec_id") % query_step == 0
    filed = routed.select(F.col("parts")[0].alias("part"), "vec_id", "vector")
    queries = routed.where(is_query)
    found = written(best(_searched(filed, queries.select(F.explode("parts").alias("part"), "vec_id", "vector"))), "found")
    short = (queries.select("vec_id", "vector").join(
        found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("_n")), "vec_id", "left")
        .where(F.coalesce("_n", F.lit(0)) < K).drop("_n"))
    if short.isEmpty():
        return found
    parts = len(router.out_bias)
    again = best(_searched(filed, short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))))
    return found.join(short, F.col("query_id") == short["vec_id"], "left_anti").unionByName(again)


def _searched(filed: DataFrame, asked: DataFrame) -> DataFrame:
    """(query_id, vec_id, score): the ``K`` nearest in each block of every part asked for; both
    sides are (part, vec_id, vector)."""
    sizes = (filed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
             .join(asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks")),
                   "part"))
    sizes = F.broadcast(sizes)      # one row a part

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def of(n: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")

    candidates = filed.join(sizes, "part").select("part", of("blocks").alias("block"),
                                                  every("query_blocks").alias("query_block"),
                                                  F.lit(False).alias("query"), "vec_id", "vector")
    queries = asked.join(sizes, "part").select("part", every("blocks").alias("block"),
                                               of("query_blocks").alias("query_block"),
                                               F.lit(True).alias("query"), "vec_id", "vector")
    return (candidates.unionByName(queries).groupBy("part", "block", "query_block")
            .applyInArrow(_rank, "query_id bigint, vec_id bigint, score double"))
