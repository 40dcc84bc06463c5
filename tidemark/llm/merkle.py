"""Merkle manifest of a dataset: one binary tree of hashes per language, one over their roots.

Leaves are numbered in order by a range partitioning, then cut into aligned
blocks of ``1 << HEIGHT`` leaves, each of which one task call turns into a
subtree.  Its nodes lie in van Emde Boas order: the tree is split at half
its height, the upper half stored first, then each lower subtree, all of
them recursively in the same order, so any path crosses few stretches of
memory whatever the size of a cache line.  Positions follow from arithmetic
on (depth, index) alone, for building and for reading siblings.  Block
roots are the leaves of the next level's blocks, until one block holds all
that a language has left.  Paths come back down the same blocks: each block
hands its children their way to the root.

A node is ``H`` of its children's digests (a last one without a partner is
hashed alone); ``H`` is the lowercase hex SHA-256 of its inputs, digests
taken as hex text.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import id_crc, written

HEIGHT = 10                 # of a block's subtree: 1,024 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 32                  # bytes of a digest
STEP = WIDTH + 1            # a step of a path: side, sibling
RIGHT, LEFT, ALONE = 0, 1, 2        # where the sibling stands, or that there is none


def parent(digests: bytes) -> bytes:
    """The node above one or two digests."""
    return sha256(hexlify(digests)).digest()


@cache
def places(levels: int) -> tuple[np.ndarray, ...]:
    """Where the nodes of each depth lie in a complete tree of so many levels, in van Emde Boas order."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    top, below = places(upper), places(levels - upper)
    base = (1 << upper) - 1 + np.arange(1 << upper) * ((1 << levels - upper) - 1)
    return (*top, *((base[:, None] + b[None, :]).ravel() for b in below))


def block_height(n: int, most: int) -> int:
    """Height of the blocks of a level of ``n`` nodes: what one block needs, ``most`` at most."""
    return min(most, max(0, n - 1).bit_length())


class Subtree:
    """A block's nodes in van Emde Boas order; ``count`` leaves of 1 << ``height`` exist."""

    def __init__(self, height: int, count: int, nodes: bytes | bytearray):
        self.height, self.count, self.nodes = height, count, nodes
        self.at = [p.tolist() for p in places(height + 1)]

    @classmethod
    def grow(cls, leaves: list[bytes], height: int) -> Subtree:
        tree = cls(height, len(leaves), bytearray(((2 << height) - 1) * WIDTH))
        row = leaves
        for depth in range(height, -1, -1):
            for place, digest in zip(tree.at[depth], row):
                tree.nodes[place * WIDTH:(place + 1) * WIDTH] = digest
            row = [parent(b"".join(row[i:i + 2])) for i in range(0, len(row), 2)]
        return tree

    def node(self, depth: int, i: int) -> bytes:
        place = self.at[depth][i] * WIDTH
        return bytes(self.nodes[place:place + WIDTH])

    def path(self, i: int) -> bytes:
        """Steps from leaf ``i`` up to the block's root."""
        steps, count = [], self.count
        for depth in range(self.height, 0, -1):
            if i ^ 1 < count:
                steps.append(bytes([i & 1]) + self.node(depth, i ^ 1))
            else:
                steps.append(bytes([ALONE]) + bytes(WIDTH))
            i, count = i >> 1, count + 1 >> 1
        return b"".join(steps)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that ``leaf`` and its path give."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1:at + STEP]
        leaf = parent(leaf if side == ALONE else leaf + sibling if side == RIGHT else sibling + leaf)
    return leaf


def path_digest(path: bytes) -> str:
    """H of a path's siblings."""
    return sha256(hexlify(b"".join(path[at + 1:at + STEP] for at in range(0, len(path), STEP)
                                   if path[at] != ALONE))).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The leaf over ``fields``: each ``-`` if null, else its UTF-8 bytes' count, ``:`` and the value."""
    return F.unhex(F.sha2(F.concat(*(
        F.when(f.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(f.cast("string")).cast("string"),
                                                          F.lit(":"), f.cast("string")))
        for f in fields)), 256))


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos`` (from 0, by ``order``, within each ``key``) and ``n`` (nodes of the key).

    Rows are sorted by range partitions; a position is the row's place within
    its partition's run of the key, plus the sizes of the runs before."""
    placed = (nodes.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
              .withColumn("_at", F.monotonically_increasing_id()))
    placed = written(placed, "placed").withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("key", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    key = Window.partitionBy("key")
    before = key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("key", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                       F.sum("_n").over(key).alias("n"))
    return placed.join(runs, ["key", "_part"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")) \
        .drop("_at", "_part", "_first", "_before")


def _blocks(nodes: DataFrame, carry: dict[str, str], most: int) -> DataFrame:
    """Subtrees over aligned blocks of ``nodes`` (key, pos, digest, n and the columns to carry):
    (key, block, n, count, root, nodes, and each carried column as an array in leaf order)."""
    schema = ("key string, block bigint, n bigint, count int, root binary, nodes binary"
              + "".join(f", {c} array<{t}>" for c, t in carry.items()))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos").combine_chunks()
        n = table["n"][0].as_py()
        height = block_height(n, most)
        tree = Subtree.grow(table["digest"].to_pylist(), height)
        out = {"key": table["key"][:1], "block": pa.array([table["pos"][0].as_py() >> most], pa.int64()),
               "n": table["n"][:1], "count": pa.array([tree.count], pa.int32()),
               "root": pa.array([tree.node(0, 0)], pa.binary()), "nodes": pa.array([bytes(tree.nodes)], pa.binary())}
        for c in carry:
            out[c] = pa.array([table[c].to_pylist()], pa.list_(table.schema.field(c).type))
        return pa.table(out)

    given = nodes.select("key", "pos", "digest", "n", *carry, F.shiftright("pos", most).alias("_block"))
    return given.groupBy("key", "_block").applyInArrow(run, schema)


@dataclass(frozen=True)
class Forest:
    """Trees of all keys as block tables, one a level, the leaves' first; ``carry`` names the
    leaves' further columns."""
    levels: tuple[DataFrame, ...]
    carry: dict[str, str]
    height: int

    @classmethod
    def grow(cls, nodes: DataFrame, order: list[str], carry: dict[str, str], height: int) -> Forest:
        nodes = _numbered(nodes, order)
        levels: list[DataFrame] = []
        while True:
            level = written(_blocks(nodes, carry if not levels else {}, height), "blocks")
            levels.append(level)
            above = level.where(F.col("n") > (1 << height))
            if above.isEmpty():
                return cls(tuple(levels), carry, height)
            nodes = above.select("key", F.col("block").alias("pos"), F.col("root").alias("digest"),
                                 F.shiftright(F.col("n") + ((1 << height) - 1), height).alias("n"))

    def roots(self) -> DataFrame:
        """(key, digest): the root of each key."""
        last = [level.where(F.col("n") <= (1 << self.height)).select("key", F.col("root").alias("digest"))
                for level in self.levels]
        out = last[0]
        for more in last[1:]:
            out = out.unionByName(more)
        return out

    def descend(self, above: DataFrame, schema: str, leaf_rows: Callable) -> DataFrame:
        """``leaf_rows(subtree, path above the block, subroot, root, carried lists)`` of every block of leaves,
        given ``above`` (key, path, subroot, root): what stands above each key's root."""
        way = above.withColumn("block", F.lit(0).cast("bigint"))
        children = None
        for i in range(len(self.levels) - 1, -1, -1):
            level = self.levels[i]
            ends = level.where(F.col("n") <= (1 << self.height)).select("key", "block")
            ways = ends.join(way, ["key", "block"])
            if children is not None:
                ways = ways.unionByName(children)
            met = level.join(ways, ["key", "block"])
            if i == 0:
                return met.select("n", "count", "nodes", "path", "subroot", "root_all", *self.carry).mapInArrow(
                    _over_blocks(self.height, len(self.carry), leaf_rows, [f.split()[0] for f in schema.split(", ")]), schema)
            children = written(met.select("key", "block", "n", "count", "nodes", "path", "subroot", "root_all")
                               .mapInArrow(_child_ways(self.height), _WAY), "ways")
        raise AssertionError("a forest has a level")


_WAY = "key string, block bigint, path binary, subroot binary, root_all binary"


def _child_ways(most: int) -> Callable:
    """The path of each child of upper blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, block, n, count, nodes, path, subroot, root in zip(*b.to_pydict().values()):
                tree = Subtree(block_height(n, most), count, nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * count, pa.string()),
                     pa.array([(block << most) + i for i in range(count)], pa.int64()),
                     pa.array([tree.path(i) + path for i in range(count)], pa.binary()),
                     pa.array([subroot] * count, pa.binary()), pa.array([root] * count, pa.binary())],
                    names=[f.split()[0] for f in _WAY.split(", ")])
    return run


def _over_blocks(most: int, carried: int, leaf_rows: Callable, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n, count, nodes, path, subroot, root = (b.column(k)[i].as_py() for k in range(6))
                tree = Subtree(block_height(n, most), count, nodes)
                lists = [b.column(6 + k)[i].as_py() for k in range(carried)]
                yield pa.RecordBatch.from_arrays(leaf_rows(tree, path, subroot, root, lists), names=names)
    return run


def _top_rows(tree: Subtree, path: bytes, _: bytes, root: bytes, lists: list[list]) -> list[pa.Array]:
    n = tree.count
    return [pa.array(lists[0], pa.string()), pa.array([tree.path(i) + path for i in range(n)], pa.binary()),
            pa.array([tree.node(tree.height, i) for i in range(n)], pa.binary()), pa.array([root] * n, pa.binary())]


_PROOF = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, proof binary")


def _proof_rows(tree: Subtree, above: bytes, subroot: bytes, root: bytes, lists: list[list]) -> list[pa.Array]:
    n = tree.count
    leaves = [tree.node(tree.height, i) for i in range(n)]
    paths = [tree.path(i) + above for i in range(n)]
    folded = [fold(other or leaf, path) for leaf, other, path in zip(leaves, lists[1], paths)]
    text = pa.string()
    return [pa.array(lists[0], pa.int64()), pa.array([x.hex() for x in leaves], text),
            pa.array([subroot.hex()] * n, text), pa.array([root.hex()] * n, text),
            pa.array([path_digest(p) for p in paths], text), pa.array([x.hex() for x in folded], text),
            pa.array([x == root for x in folded], pa.bool_()), pa.array(paths, pa.binary())]


@dataclass(frozen=True)
class Manifest:
    """Trees by language and the tree over their roots."""
    trees: Forest
    top: Forest

    def proofs(self) -> DataFrame:
        """A row per leaf: its digest, its language's subroot, the root, the path between as bytes
        (steps of a side byte and a sibling) and as H of its siblings, and the root refolded from
        the claimed leaf where one was given (else from the leaf itself)."""
        root = self.top.roots().select("key", F.lit(b"").alias("path"), F.col("digest").alias("subroot"),
                                       F.col("digest").alias("root_all"))
        above = written(self.top.descend(root, "key string, path binary, subroot binary, root_all binary", _top_rows),
                        "tops")
        return self.trees.descend(above, _PROOF, _proof_rows)


def build(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang",
          n_chars_col: str = "n_chars", text_col: str = "text", claimed: Column | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of all rows of ``df``: per language the leaves ascend by id, ties by leaf.

    ``claimed`` is another ``n_chars`` (of any type with the same decimal text), null where
    nothing else is claimed; proofs are then folded from the leaf that it gives.  Texts are
    read once; everything later handles digests.  Nulls in any column are fields of their own
    (null ids come first, null languages are one language, before all others); repeated rows
    are a leaf each; an empty table has no leaves and no proofs.  Columns with other names
    are not read.
    """
    fields = [F.col(c) for c in (id_col, source_col, lang_col, n_chars_col, text_col)]
    other = F.lit(None).cast("binary") if claimed is None else F.when(
        claimed.isNotNull(), leaf_digest([*fields[:3], claimed, fields[4]]))
    lang = F.col(lang_col).cast("string")
    # a null language sorts first as the empty key; ``tie`` spreads many equal rows over ranges
    leaves = written(df.select(
        F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang)).alias("key"),
        F.col(id_col).cast("bigint").alias("doc_id"), leaf_digest(fields).alias("digest"), other.alias("claimed"),
        F.monotonically_increasing_id().alias("tie")), "leaves")
    trees = Forest.grow(leaves, ["doc_id", "digest", "tie"], {"doc_id": "bigint", "claimed": "binary"}, height)
    roots = trees.roots().select(F.lit("").alias("key"), F.col("key").alias("name"), "digest")
    return Manifest(trees, Forest.grow(roots, ["name"], {"name": "string"}, height))


def tampered_chars(id_col: str = "doc_id", n_chars_col: str = "n_chars") -> Column:
    """``n_chars`` plus one where 7 divides the id's CRC-32, else null."""
    return F.when(id_crc(id_col) % 7 == 0, (F.col(n_chars_col).cast("decimal(20,0)") + 1).cast("string"))
