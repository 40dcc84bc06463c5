"""Near-duplicate documents by a multi-index Hamming join over MinHash signatures.

A signature has ``CHUNKS`` chunks of ``CHUNK`` positions of 16 bits.  By the
pigeonhole principle two signatures that differ in no more than
``2 * CHUNKS - 1`` positions have a chunk with at most one differing
position; every chunk is therefore indexed once per position left out, and
such a pair always shares a key.  Documents that share a key are compared
by their whole signatures, and what is near by signature is confirmed on
the full shingle sets.

Documents with one and the same set are one node from the start.  In a
bucket, members are first compared with one head only.  Buckets that then
still hold several components are compared in blocks, each text outside the
largest component with all texts of other components; a block gives out the
links that join components, and no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import text_bytes, written
from tidemark.llm.graph import components
from tidemark.llm.shingles import mix, shingle_sets

CHUNKS, CHUNK = 7, 5
POSITIONS = CHUNKS * CHUNK
#: Signature distance of all pairs that the index finds for certain.  At the similarity
#: of the threshold, 0.85, a pair is farther apart with probability 2e-4 and is then
#: still found unless every chunk differs in two positions (probability 4e-6).
FOUND_DISTANCE = 2 * CHUNKS - 1
#: Pairs that differ in more positions aren't near: probability 2e-5 at 0.85.
MAX_DISTANCE = 15
PERCENT = 85            # link: 100 * intersection >= PERCENT * union
BLOCK = 256             # texts compared with one head in a task
SHINGLES = 250_000      # shingles in a block of a group compared in full

_SEEDS = np.random.default_rng(20_240_501)
_XOR = _SEEDS.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)
_ODD = _SEEDS.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _SEEDS.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x POSITIONS) 16-bit signatures of non-empty sets."""
    every = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), POSITIONS), np.uint16)
    for k in range(POSITIONS):
        out[:, k] = mix(np.minimum.reduceat((every ^ _XOR[k]) * _ODD[k], at)).astype(np.uint16)
    return out


def fingerprint(s: np.ndarray) -> bytes:
    """128 bits of a set, whatever its order."""
    return (int(mix(s).sum(dtype=np.uint64)).to_bytes(8, "little")
            + int(mix(s ^ _SALT[0]).sum(dtype=np.uint64)).to_bytes(8, "little"))


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """(rows x POSITIONS) index keys: each chunk with each of its positions left out."""
    chunks = sig.reshape(len(sig), CHUNKS, CHUNK).astype(np.uint64)
    out = np.empty((len(sig), POSITIONS), np.uint64)
    for left_out in range(CHUNK):
        rest = [p for p in range(CHUNK) if p != left_out]
        value = sum(chunks[:, :, p] << np.uint64(16 * i) for i, p in enumerate(rest))
        for c in range(CHUNKS):
            k = c * CHUNK + left_out
            out[:, k] = mix(value[:, c] ^ _SALT[k])
    return out.view(np.int64)


_SIGNED = "doc_id bigint, th bigint, n_shingles bigint, fp binary, sig array<smallint>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, fp = [], []
        sig = np.zeros((b.num_rows, POSITIONS), np.int16)
        run, rows, size = [], [], 0

        def flush() -> None:
            if run:
                sig[rows] = signatures(run).view(np.int16)

        for i, s in enumerate(shingle_sets(text_bytes(b.column(2)))):
            n.append(len(s))
            fp.append(fingerprint(s))
            if len(s):
                run.append(s)
                rows.append(i)
                size += len(s)
            if size > 500_000:
                flush()
                run, rows, size = [], [], 0
        flush()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, POSITIONS, dtype=np.int32)),
                                         pa.array(sig.reshape(-1)))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()),
                                          pa.array(fp, pa.binary()), lists],
                                         names=["doc_id", "th", "n_shingles", "fp", "sig"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, key, a, b) of nodes and signatures.  Nodes that share a key within
    a batch are linked to one head right here; only the head goes on by that key
    (b: itself if it has members here, else -1), the others to parts of their own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column(0).to_numpy()
        sig = batch.column(1).flatten().to_numpy().view(np.uint16).reshape(-1, POSITIONS)
        key = chunk_keys(sig).ravel()
        a = np.repeat(node, POSITIONS)
        order = np.lexsort((a, key))
        key, a = key[order], a[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        head = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        size = np.diff(np.concatenate((head, [len(key)])))
        b = a[head][run]
        b[head] = np.where(size > 1, a[head], -1)
        part = np.where(new, key, mix((a.view(np.uint64) + key.view(np.uint64))).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (part, key, a, b)], names=["part", "key", "a", "b"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members (key, a, b = head) of keys with two nodes or more, from rows sorted by
    part, key and node; only the row before is remembered, however long a run is."""
    carry = None    # (key, head, whether the head was given out)
    for batch in batches:
        part, key, a, b = (batch.column(i).to_numpy() for i in range(4))
        star = part != key
        out = [(key[star], a[star], b[star])]
        key, a, b = key[~star], a[~star], b[~star]
        if len(key):
            new = np.concatenate(([carry is None or key[0] != carry[0]], key[1:] != key[:-1]))
            at = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            head = np.where(at >= 0, a[at], carry[1] if carry else 0)
            if carry and not new[0] and not carry[2]:
                out.append((key[:1], np.array([carry[1]]), np.array([carry[1]])))
            followed = np.concatenate((~new[1:], [False]))
            give = ~new | followed | (b >= 0)
            out.append((key[give], a[give], head[give]))
            last = at[-1]
            carry = (key[-1], head[-1], bool(give[last]) if last >= 0 else True)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)],
                                         names=["key", "a", "b"])


def _near(left: str, right: str) -> Column:
    """Whether a member and a head may be linked: by set sizes, and by the whole signatures."""
    small = F.least(f"{left}.n", f"{right}.n")
    large = F.greatest(f"{left}.n", f"{right}.n")
    apart = sum((F.col(f"{left}.sig")[i] != F.col(f"{right}.sig")[i]).cast("int") for i in range(POSITIONS))
    return (100 * small >= PERCENT * large) & (apart <= MAX_DISTANCE)


def _compare(table: pa.Table) -> pa.Table:
    """Links (a, b) between a head and the other texts of one block, on full sets."""
    hub = table.column("hub")[0].as_py()
    node = table.column("node").to_pylist()
    sets: dict[int, np.ndarray] = {}
    for i, want, s in zip(node, table.column("fp").to_pylist(), shingle_sets(text_bytes(table.column("text")))):
        if i not in sets and fingerprint(s) == want:    # else another row that bears the same id
            sets[i] = s
    head, found = sets.pop(hub), []
    for i, s in sets.items():
        both = np.intersect1d(head, s, assume_unique=True).size
        if 100 * both >= PERCENT * (head.size + s.size - both):
            found.append(i)
    return pa.table({"a": pa.array(found, pa.int64()), "b": pa.array([hub] * len(found), pa.int64())})


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) linked by their full sets.  The texts of a head's partners go to
    blocks of about ``BLOCK``, with a copy of the head's, so no head is a hot group."""
    blocks = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).alias("k"))
    need = pairs.join(blocks, "b").select(F.col("b").alias("hub"),
                                          F.pmod(F.xxhash64("a"), "k").cast("int").alias("block"),
                                          F.col("a").alias("node"))
    need = need.unionByName(blocks.select(F.col("b").alias("hub"),
                                          F.explode(F.sequence(F.lit(0), (F.col("k") - 1).cast("int"))).alias("block"),
                                          F.col("b").alias("node")))
    return written(need.join(texts, "node").select("hub", "block", "node", "fp", "text")
                   .groupBy("hub", "block").applyInArrow(_compare, "a bigint, b bigint"), "confirmed")


def _merge(table: pa.Table) -> pa.Table:
    """Links (a, b) that join the components of one pair of blocks, on full sets: one link
    for each two components that meet.  Pairs within a component aren't compared."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    rows: dict[int, int] = {}
    sets = []
    ids, want = table.column("node").to_pylist(), table.column("fp").to_pylist()
    for at, s in enumerate(shingle_sets(text_bytes(table.column("text")))):
        if ids[at] not in rows and fingerprint(s) == want[at]:  # else another row that bears the same id
            rows[ids[at]] = at
            sets.append(s)
    take = np.fromiter(rows.values(), np.int64, len(rows))
    node, own = np.fromiter(rows, np.int64, len(rows)), table.column("own").to_numpy()[take]
    comp = np.unique(table.column("root").to_numpy()[take], return_inverse=True)[1]
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    a, b = [], []
    if len(left) and len(right):
        size = np.array([len(s) for s in sets])
        every, code = np.unique(np.concatenate(sets), return_inverse=True)
        code = np.split(code, np.cumsum(size)[:-1])
        marked = np.zeros(len(every), np.int32)
        for r in left:
            meet = right[(comp[right] != comp[r]) & (100 * np.minimum(size[right], size[r])
                                                     >= PERCENT * np.maximum(size[right], size[r]))]
            if i == j:
                meet = meet[meet > r]
            for at in range(0, len(meet), BLOCK):
                some = meet[at:at + BLOCK]
                marked[code[r]] = 1
                both = np.add.reduceat(marked[np.concatenate([code[m] for m in some])],
                                       np.cumsum(size[some]) - size[some])
                marked[code[r]] = 0
                near = some[100 * both >= PERCENT * (size[r] + size[some] - both)]
                for c, first in zip(*np.unique(comp[near], return_index=True)):
                    if c != comp[r]:
                        a.append(node[r])
                        b.append(node[near[first]])
                        comp[comp == c] = comp[r]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _merged(buckets: DataFrame, roots: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that join all components which have near texts in one bucket.

    Buckets of one component need nothing.  The others are gathered by their
    smallest node, which is the same for most buckets of a family, so a text
    goes to a few groups and not to one for each key.  A group is dealt to
    blocks of about ``SHINGLES``: those outside its largest component meet
    all blocks, those inside meet the outside ones only.
    """
    placed = (buckets.select("key", "a").join(roots, F.col("a") == F.col("node"), "left")
              .select("key", "a", F.coalesce("root", "a").alias("root")))
    several = (placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("a").alias("hub"))
               .where("lo < hi").select("key", "hub"))
    met = written(placed.join(several, "key").select("hub", "a", "root").distinct()
                  .join(nodes.select(F.col("node").alias("a"), "n"), "a"), "met")
    sizes = (met.groupBy("hub", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s")).groupBy("hub")
             .agg(F.sum("s").alias("total"), F.max(F.struct("c", "root", "s")).alias("m"))
             .select("hub", "total", F.col("m.root").alias("major"), F.col("m.s").alias("inside"))
             .withColumn("split", F.col("total") > SHINGLES)
             .select("hub", "major",
                     F.expr(f"int(if(split, ceil((total - inside) / {SHINGLES}), 1))").alias("k_out"),
                     F.expr(f"int(if(split, ceil(inside / {SHINGLES}), 0))").alias("k_in")))
    dealt = (met.join(sizes, "hub").withColumn("inner", F.expr("k_in > 0 AND root = major"))
             .withColumn("own", F.expr("int(if(inner, k_out + pmod(xxhash64(a), k_in), pmod(xxhash64(a), k_out)))"))
             .withColumn("other", F.explode(F.expr("sequence(0, if(inner, k_out, k_out + k_in) - 1)")))
             .select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                     F.col("a").alias("node"), "root"))
    return written(dealt.join(texts, "node").groupBy("hub", "i", "j").applyInArrow(_merge, "a bigint, b bigint"),
                   "merged")


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signed rows, and (fp, root) of each distinct non-empty set."""
    signed = written(docs.mapInArrow(_sign, _SIGNED), "signed")
    nodes = written(signed.where("n_shingles > 0").groupBy("fp")
                    .agg(F.min(F.struct("doc_id", "th")).alias("row"), F.min("n_shingles").alias("n"),
                         F.any_value("sig").alias("sig"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = written(nodes.select("node", "sig").mapInArrow(_index, "part bigint, key bigint, a bigint, b bigint")
                      .repartition("part").sortWithinPartitions("part", "key", "a")
                      .mapInArrow(_buckets, "key bigint, a bigint, b bigint"), "buckets")
    few = nodes.select("node", "n", "sig")
    # a set's text is that of one row, found by id and text hash; rows repeated as a whole give one
    wanted = buckets.select(F.col("a").alias("node")).distinct().join(nodes.select("node", "row", "fp"), "node")
    same = (F.col("row.th") == F.col("th")) & F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
    texts = written(wanted.join(docs, same).select("node", "fp", "text"), "texts")
    if texts.count() > wanted.count():
        texts = written(texts.groupBy("node", "fp").agg(F.min("text").alias("text")), "texts")
    pairs = written(buckets.where("a <> b").select("a", "b").distinct().alias("p")
                    .join(few.alias("x"), F.expr("p.a = x.node")).join(few.alias("y"), F.expr("p.b = y.node"))
                    .where(_near("x", "y")).select("p.a", "p.b"), "pairs")
    links = _confirmed(pairs, texts)
    roots = components(links)
    more = _merged(buckets, roots, nodes, texts)
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    return signed, nodes.select("fp", "node").join(roots, "node", "left").select(
        "fp", F.coalesce("root", "node").alias("root"))


def _prepared(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, text): th, a hash of the text, tells rows of one id apart."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"),
                     F.col(text_col).alias("text"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``df``.

    A document's set holds the distinct five-word shingles of its whole text
    (fewer words: the sequence itself).  Null, empty or blank texts have no
    set and link with nothing.  A component is named by its smallest id;
    repeated rows are one component; null ids count only if a component has
    no other, and its name is null then.  Other columns are not read.
    """
    signed, roots = _linked(_prepared(df, id_col, text_col))
    worded = signed.where("n_shingles > 0")
    # one row a set first: few rows per component go on
    sets = written(worded.groupBy("fp").agg(F.min("doc_id").alias("m"), F.count("*").alias("n")).join(roots, "fp"), "sets")
    smallest = sets.groupBy("root").agg(F.min("m").alias("component"))
    named = sets.join(smallest, "root").select("fp", "component", "n")
    # sets of at least 1/1024 of the rows (so at most 1,024) are broadcast, the others joined: no hot set is a task
    rows = sets.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(named.where(F.col("n") * 1024 >= rows).drop("n"))
    slim = worded.select("doc_id", "n_shingles", "fp")
    found = slim.join(heavy, "fp").unionByName(
        slim.join(heavy, "fp", "left_anti").join(named.where(F.col("n") * 1024 < rows).drop("n"), "fp"))
    # rows without words all have the same empty set; they need no join
    return (found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
            .unionByName(signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, all its columns, per group of near-duplicates: the one with
    the smallest id (of equal ids the one with the smaller text hash).  Rows
    without words are groups of their own, but repeated rows are one."""
    signed, roots = _linked(_prepared(docs, id_col, text_col))
    choice = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("best")
    chosen = (signed.where("n_shingles > 0").groupBy("fp").agg(choice).join(roots, "fp")
              .groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.th")
              .unionByName(signed.where("n_shingles = 0").select("doc_id", "th").distinct()))
    chosen = chosen.select(F.col("doc_id").alias("_keep_id"), F.col("th").alias("_keep_th"))
    hashed = docs.withColumn("_keep_text", F.xxhash64(F.col(text_col)))
    one = Window.partitionBy(id_col, "_keep_text").orderBy(
        *[c for c, t in docs.dtypes if c not in (id_col, text_col) and "<" not in t], id_col)
    return (hashed.join(chosen, F.col(id_col).cast("bigint").eqNullSafe(F.col("_keep_id"))
                        & (F.col("_keep_text") == F.col("_keep_th")), "left_semi")
            .withColumn("_keep_row", F.row_number().over(one)).where("_keep_row = 1")
            .select(*docs.columns))
