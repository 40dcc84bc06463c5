"""Merkle manifest, vector codes and token counts against brute force and the libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import merkle, pqcode, tokencount
from tidemark.llm.catalog import op11_merkle_manifest, op12_vector_codes, op13_token_counts
from tidemark.llm.common import table

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, digest int, key string, pos int"


def h(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(r, more=0):
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(row):
    rows = [row]
    while len(rows[-1]) > 1:
        rows.append([h(*rows[-1][i:i + 2]) for i in range(0, len(rows[-1]), 2)])
    return rows


def siblings(rows, i):
    for row in rows[:-1]:
        yield i & 1, row[i ^ 1] if i ^ 1 < len(row) else None
        i >>= 1


def brute_manifest(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    names = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    for k in names:
        langs[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {k: tree([leaf(r) for r in langs[k]]) for k in names}
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for at, k in enumerate(names):
        for i, r in enumerate(langs[k]):
            path = [*siblings(trees[k], i), *siblings(top, at)]
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            found = leaf(r, bad)
            for side, other in path:
                found = h(found) if other is None else h(other, found) if side else h(found, other)
            out.append((r["doc_id"], leaf(r), trees[k][-1][0], top[-1][0], h(*(s for _, s in path if s)), found,
                        found == top[-1][0]))
    return sorted(out, key=str)


def proofs(df, **kw):
    got = merkle.build(df, claimed=merkle.tampered_chars(), **kw).proofs().collect()
    for r in got:
        assert merkle.path_digest(r["proof"]) == r["proof_sha256"]
    return sorted((tuple(r)[:7] for r in got), key=str)


def odd_docs(spark):
    """Nulls everywhere, ties, repeated rows, a text of a MB, names that clash with the operator's own."""
    rows = [(None, None, None, None, None, 1, "k", 0), (None, "s", "en", 3, "abc", 1, "k", 0), (5, "s", "", 0, "", 1, "k", 0),
            (5, None, "", None, "é😀\n", 1, "k", 0), (6, "s", "zz", 2 ** 63 - 1, "x" * 1_000_000, 1, "k", 0)]
    rows += [(7, "s", "zz", 1, "same", i, "k", i) for i in range(40)]
    rows += [(i, "s", "é" if i % 3 else None, i, f"t{i}", 0, None, 9) for i in range(-20, 60)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest(spark, height):
    df = odd_docs(spark)
    assert proofs(df, height=height) == brute_manifest(df.collect())


def test_manifest_of_one_and_of_nothing(spark):
    one = odd_docs(spark).where("n_chars > 100")
    (r,) = merkle.build(one).proofs().collect()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] == leaf(one.first())
    assert r["proof_sha256"] == h() and r["verified"]
    assert merkle.build(one.where("false")).proofs().count() == 0


def test_manifest_query(spark):
    got = op11_merkle_manifest(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(table(spark, SF_SMALL, "documents").collect())
    assert 0 < sum(not r["verified"] for r in got) < len(got)


def test_every_tampered_field_is_found(spark):
    df = odd_docs(spark).where("doc_id between 1 and 40").dropDuplicates(["doc_id"])
    for claim, want in ((F.lit("77"), False), (F.col("n_chars").cast("string"), True)):
        got = merkle.build(df, claimed=claim, height=3).proofs().collect()
        assert {r["verified"] for r in got} == {want}


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout(levels):
    """Places are a permutation; an aligned subtree at half height is one stretch."""
    at = merkle.places(levels)
    assert sorted(np.concatenate(at).tolist()) == list(range((1 << levels) - 1))
    upper = levels // 2
    for i in range(1 << upper if levels > 1 else 0):
        below = np.concatenate([at[upper + d][i << d:(i + 1) << d] for d in range(levels - upper)])
        assert below.max() - below.min() + 1 == len(below)


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = [r for r in rows if r["embedding"] is not None
            and all(v is not None and np.isfinite(v) for v in r["embedding"])]
    rows.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["embedding"]))
    size = max(len(r["embedding"]) for r in rows)
    width = -(-size // parts)
    x = [[int(np.floor(4096 * float(v))) for v in r["embedding"]] for r in rows]
    x = [v + [0] * (width * parts - len(v)) for v in x]
    cut = [[tuple(v[p * width:(p + 1) * width]) for v in x] for p in range(parts)]
    books = [[c[i] for i in range(min(entries, len(rows)))] for c in cut]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut[p]:
                groups.setdefault(nearest(p, v)[1], []).append(v)
            for i, g in groups.items():
                books[p][i] = tuple(sum(c) // len(g) for c in zip(*g))
    found = [[nearest(p, v) for v in cut[p]] for p in range(parts)]
    error = [sum(found[p][i][0] for p in range(parts)) for i in range(len(rows))]
    by_label = {}
    for r, e in zip(rows, error):
        by_label[r["label"]] = by_label.get(r["label"], 0) + e
    digest = h(",".join(str(c) for b in books for e in b for c in e))
    return sorted(((r["vec_id"], "".join(f"{found[p][i][1]:02x}" for p in range(parts)), error[i], by_label[r["label"]],
                    digest) for i, r in enumerate(rows)), key=str)


def odd_vectors(spark, n=150, size=16):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, size)).astype(np.float32)
    x[40:90] = x[3]                                     # many equal vectors, equal first entries too
    x[5] = x[3]
    rows = [(i, v.tolist(), int(i) % 4 or None, "c", 1) for i, v in enumerate(x)]
    rows += [(2, x[7].tolist(), 9, "c", 1), (2, x[2].tolist(), 9, "c", 1), (None, x[8].tolist(), 9, "c", 1)]
    rows += [(-1, None, 1, "c", 1), (-2, [float("nan")] * size, 1, "c", 1), (-3, [None] * size, 1, "c", 1),
             (-4, [float("inf")] + [0.0] * (size - 1), 1, "c", 1), (-5, [0.0] * size, 1, "c", 1),
             (-6, [1.0, -2.0, 0.3], 2, "c", 1), (-7, [], 2, "c", 1)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, code string, points int").repartition(3)


def coded(df, **kw):
    return sorted((tuple(r)[:5] for r in pqcode.encode(df, **kw).collect()), key=str)


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_vector_codes(spark, block_rows):
    df = odd_vectors(spark)
    assert coded(df, block_rows=block_rows) == brute_codes(df.collect())


@pytest.mark.parametrize("keep", ["vec_id = 3", "vec_id < 5 AND vec_id >= 0", "vec_id BETWEEN 40 AND 80", "vec_id = -7"])
def test_vector_codes_of_few_or_equal_rows(spark, keep):
    df = odd_vectors(spark).where(keep)
    assert coded(df) == brute_codes(df.collect()) or keep == "vec_id = -7"
    assert len(coded(df)) == df.count()


def test_vector_codes_length_not_a_multiple_of_parts(spark):
    df = odd_vectors(spark, size=13)
    assert coded(df) == brute_codes(df.collect())


def test_vector_codes_nothing_and_huge(spark):
    df = odd_vectors(spark)
    assert pqcode.encode(df.where("false")).count() == 0
    huge = spark.createDataFrame([(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.5] * 8, 1)],
                                 "vec_id bigint, embedding array<float>, label int")
    assert [r["error"] for r in pqcode.encode(huge).collect()] == [0, 0, 0]


def test_vector_codes_query(spark):
    want = brute_codes(table(spark, SF_SMALL, "embeddings").collect())
    assert sorted((tuple(r) for r in op12_vector_codes(spark, SF_SMALL).collect()), key=str) == want


def test_cover_tree():
    """Children part their node's stretch, lie within half its radius and stand further apart; whole
    stretches are given away."""
    rng = np.random.default_rng(0)
    x = np.concatenate([c + rng.integers(-20, 20, (60, 4)) for c in rng.integers(-4000, 4000, (9, 4))])
    t = pqcode.CoverTree.build(x, 4)
    assert sorted(t.order.tolist()) == list(range(len(x)))
    for i in range(len(t.centre)):
        d = pqcode.squares(x[t.order[t.begin[i]:t.end[i]]], x[t.centre[i]][None])[:, 0]
        assert d.max() == t.reach[i]
        kids = range(t.first[i], t.last[i])
        if len(kids):
            assert [t.begin[i], *(t.end[k] for k in kids)] == [*(t.begin[k] for k in kids), t.end[i]]
            centres = x[t.centre[list(kids)]]
            apart = pqcode.squares(centres, centres)[~np.eye(len(kids), dtype=bool)]
            assert (4 * apart > t.reach[i]).all() and all(4 * t.reach[k] <= t.reach[i] for k in kids)
    books = x[rng.integers(0, len(x), 6)]
    whole, places, _ = t.assign(x, books)
    assert sum(e - b for b, e, _ in whole) + len(places) == len(x) and len(places) < len(x) / 2
    assert (t.nearest(x, books) == pqcode.squares(x, books).argmin(axis=1)).all()
    again = pqcode.CoverTree.unpack(t.pack())
    assert all((getattr(again, f) == getattr(t, f)).all() for f in t.__dataclass_fields__)


TEXTS = [None, "", " ", "a", "<|endoftext|>", "a <|endoftext|>b", "word " * 30_000, "x" * 70_000, "\n\n \t" * 9000,
         "日本語、テキスト。" * 9000, "don't 'll  've" * 5000, "é́ 　 1½ ▁ <s>" * 4000]
VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def library_counts(vocabulary, texts):
    if vocabulary.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=tokencount.tokenizer_path(vocabulary))
        return [len(sp.encode(t or "")) for t in texts]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokencount.tokenizer_path(vocabulary))
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("vocabulary", VOCABULARIES)
def test_token_counts(spark, vocabulary):
    rows = [(i, t, "s", 1) for i, t in enumerate(TEXTS)] + [(3, "a", "s", 1)] * 2 + [(None, "a b", None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_bytes string, n_tokens int")
    got = tokencount.count_tokens(df, vocabulary=vocabulary, limit=100).collect()
    want = library_counts(vocabulary, [r[1] for r in rows])
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted(
        (str(i), len((t or "").encode()), n, n > 100) for (i, t, _, _), n in zip(rows, want))
    assert tokencount.count_tokens(df.where("false")).count() == 0


@pytest.mark.parametrize("vocabulary", VOCABULARIES)
def test_token_counts_of_split_texts(vocabulary):
    """Cut after every third character where that is safe, texts count as when whole."""
    signs = ["a", "b", "'s", ",", ");", "\"", "?'t", " ", "  ", "\n", "\t", "'", "ll", "1", "22", "<|endoftext|>", "<|", "|>", ".", "!", "é", "。", "、",
             "日", "カ", "한", " ", "　", "​", "᠎", "́", "½", "😀", "\x1c", "<s>", "▁", "<|startoftext|>"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(5000)]
    assert tokencount.token_counts(texts, vocabulary, 3, 500) == library_counts(vocabulary, texts)
    c = tokencount.counter(vocabulary)
    assert sum(len(list(tokencount.pieces(t, c.safe, c.skip, 3))) > 1 for t in texts) > 500


def test_token_counts_calls_are_balanced(monkeypatch):
    calls = []
    c = tokencount.counter()
    monkeypatch.setattr(c, "lengths", lambda ts: calls.append(sum(len(t) for t in ts)) or [1] * len(ts))
    tokencount.token_counts(["ab " * 50] * 1000 + ["word " * 100_000] + [None] * 50, piece_chars=1000, call_bytes=10_000)
    assert max(calls) <= 10_000 and sum(n > 8000 for n in calls) >= len(calls) - 1


def test_token_counts_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    want = dict(zip(texts, library_counts(tokencount.VOCABULARY, texts.values())))
    got = op13_token_counts(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) and r["n_bytes"] == len(texts[r["doc_id"]].encode()) for r in got)
