"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): each node of ``links(a bigint, b bigint)`` with a node of its
    component, the same one for all of them.

    Each round every node takes the neighbour, or itself, that comes first in
    a hashed order, and links are drawn anew between what was taken: links
    within a group vanish and the rest shrink by a constant factor on
    average, whatever the ids are.  Rounds are written tables; a node's
    minimum is aggregated map-side first, so a node with many links is no
    hot group, and joins against it can be split.
    """
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "links")
    steps = []
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct("a", F.col("b").alias("n")), F.struct("a", F.col("a").alias("n")),
                                              F.struct(F.col("b").alias("a"), F.col("a").alias("n")),
                                              F.struct(F.col("b").alias("a"), F.col("b").alias("n")))).alias("e"))
        first = (both.groupBy(F.col("e.a").alias("node"))
                 .agg(F.min(F.struct(F.xxhash64("e.n"), F.col("e.n").alias("n"))).alias("m"))
                 .select("node", F.col("m.n").alias("root")))
        first = written(first, "roots")
        steps.append(first)
        edges = written(
            edges.join(first.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(first.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(), "links")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps.pop()
    while steps:
        later = out.select(F.col("node").alias("root"), F.col("root").alias("_later"))
        out = steps.pop().join(later, "root", "left").select(
            "node", F.coalesce("_later", "root").alias("root"))
    return out
