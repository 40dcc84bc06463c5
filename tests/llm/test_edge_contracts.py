"""Ordinary inputs at the edge of the contracts: samples in any order, common vectors, bad rows beside good ones,
repeated ids, long examples, scratch tables."""

import hashlib
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.test_llm import brute_components, shingles
from tidemark.llm import ann, chat, common, embdedup, html, minhash, packing, quality
from tidemark.llm.common import table


def least_loss(x, y, w, steps=4000):
    """A plain minimiser: gradient steps of a length that always lowers this convex loss."""
    scale = np.sqrt((x ** 2).max(axis=0))
    z = x / scale
    beta = np.zeros(x.shape[1])
    limit = 0.25 * np.linalg.eigvalsh((z * w[:, None]).T @ z).max() + quality.RIDGE / (scale ** 2).min()
    v, t = beta.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -500, 500)))
        new = v + (z.T @ (w * (y - p)) - quality.RIDGE * v / scale ** 2) / limit
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, beta, t = new + (t - 1) / t2 * (new - beta), new, t2
    return quality._loss(beta / scale, x, y, w)


def test_quality_fit_from_any_order(spark):
    """Whatever half of the sample makes the dictionaries, the fit reaches the least loss."""
    sf = SF_SMALL.replace("0.001", "0.01")
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").where(
        "quality IS NOT NULL AND length(text) BETWEEN 1 AND 6000").select("text", "quality").collect()
    by = {y: [r["text"].encode() for r in rows if r["quality"] == y] for y in (0, 1)}
    for seed in range(20):
        rng = np.random.default_rng(seed)
        some = {y: [by[y][i] for i in rng.permutation(len(by[y]))[:60]] for y in by}
        sizer = quality.Sizer(quality._content(some[1][::2]), quality._content(some[0][::2]))
        x = np.concatenate([sizer.features(some[y][1::2]) for y in (0, 1)])
        y = np.repeat([0.0, 1.0], [len(some[0][1::2]), len(some[1][1::2])])
        share = 0.86
        w = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum()) * len(y)
        got = quality._loss(quality._calibrate(x, y, share), x, y, w)
        assert got <= least_loss(x, y, w) * 1.001 + 1e-6


def test_quality_features_by_brute_force():
    import zstandard
    good, bad = b"a good text about things " * 40, b"buy now !!! " * 80
    texts = [b"", b"x", b"a good text " * 100, bytes(range(256)) * 5]
    got = quality.Sizer(good, bad).features(texts)
    for row, text in zip(got, texts):
        size = []
        for content in (good, bad):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            blocks = [text[i:i + quality.BLOCK] for i in range(0, len(text), quality.BLOCK)]
            d.precompute_compress(level=quality.LEVEL)
            size.append(sum(len(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False,
                                                         write_dict_id=False).compress(b)) - quality.FRAME_BYTES
                            for b in blocks))
        both = sum(size) + quality.SMOOTH_BYTES
        density = np.log(both / (2 * len(text) + quality.SMOOTH_BYTES))
        assert np.allclose(row, [1, 5 * (size[1] - size[0]) / both, density, density ** 2])


def test_quality_learns_long_and_repeated_rows(spark):
    long_bad = [(i, "junk " * 6000, 0) for i in range(1, 30)]
    good = [(100 + i, f"a quiet sentence about river number {i} and its banks " * 5, 1) for i in range(30)]
    df = spark.createDataFrame(long_bad + good + good, "doc_id bigint, text string, quality int")
    model = quality.fit(df.drop("quality"), df.select("doc_id", "quality").distinct())
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    assert len(quality.score(df, model).collect()) == 89
    assert all((got[i] >= 0.5) == (i >= 100) for i in got)


BESIDE = [(1, [1.0, 0.0]), (1, [None, 5.0]), (2, [1.0, 0.0])]


def test_bad_row_beside_a_good_one(spark):
    df = spark.createDataFrame(BESIDE + [(None, [1.0, 0.0]), (None, None), (3, [1.0, 0.0, 0.0])],
                               "vec_id bigint, embedding array<float>")
    got = embdedup.near_duplicates(df).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"]) == [
        (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(0, None, True)] * 2
    found = ann.search(df, query_step=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in found) == [(1, 1, 2), (2, 1, 1)]


def ann_truth(ids, x, q):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u[q]
    s[q] = -2
    return [ids[i] for i in np.lexsort((ids, -s.round(12)))[:5]], s


@pytest.mark.parametrize("case", ["common", "clusters"])
def test_ann_complete_and_even(spark, case):
    """One common vector, or tight clusters, beside outliers: five neighbours each, recall for outliers too."""
    rng = np.random.default_rng(5)
    if case == "common":
        x = np.concatenate([np.repeat(rng.normal(size=(1, 16)), 4000, axis=0), rng.normal(size=(100, 16))])
        outliers = range(4000, 4100)
    else:
        centres = np.repeat(rng.normal(size=(40, 16)), 100, axis=0)
        x = np.concatenate([centres + 0.02 * rng.normal(size=centres.shape), rng.normal(size=(150, 16))])
        outliers = range(4000, 4150)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.search(df, query_step=10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, len(x), 10)) and all(len(v) == 5 for v in got.values())
    ids, hits = np.arange(len(x)), []
    for q in got:
        rows = sorted(got[q])
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        assert sorted(rows, key=lambda r: (-r[2], r[1])) == rows        # nearest first, ties by smaller id
        want, s = ann_truth(ids, x, q)
        assert all(abs(s[v] - c) < 1e-9 for _, v, c in rows)
        if q in outliers:
            hits.append(len({v for _, v, _ in rows} & set(want)) / 5)
    assert np.mean(hits) >= 0.9


def test_many_texts_of_one_id(spark):
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(300):
        w = list(base)
        w[i % 100] = f"z{i}"
        rows.append((7, " ".join(w)))
    rows += [(8, rows[0][1])] * 5 + [(None, rows[1][1])] + [(9, "  "), (9, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = []
    real, minhash.written = minhash.written, lambda d, n: (lambda w: (made.append((n, w.count())), w)[1])(common.written(d, n))
    try:
        got = minhash.near_duplicates(df).collect()
    finally:
        minhash.written = real
    assert max(n for name, n in made if name == "texts") <= 300
    assert len(got) == len(rows)
    roots = brute_components({i: shingles(t or "") for i, (_, t) in enumerate(rows)})
    one = roots[0]
    for r in got:
        if r["n_shingles"] == 0:
            assert r["component_id"] == 9
    assert {r["component_id"] for r in got if r["n_shingles"]} == {7} and len({roots[i] for i in range(306)}) == 1 and one == 0


def test_packing_words_by_library():
    import random
    signs = ["a", "Z", "'s", " ", "\n", "\t", "'", "ll", "1", "22", "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "<", "|>",
             ".", "!?", "é", "ÿ", "×", "÷", "Ã", "Ä", "。", "日", "​", "́", "½", "😀", "\x1c", "\x00", "\x7f", "-", "_", "</w>", "ß", "ſ", "K"]
    rng = random.Random(3)
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(5000)] + ["", " ", "word " * 500_000, "x" * 100_000]
    t = packing.word_tokenizer()
    want = [np.array(e.ids, "<u4").tobytes() for e in t.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert t.encode_batch([x.encode() for x in texts]) == want


def test_packing_long_example_in_linear_time():
    spent = []
    for n in (1_000_000, 8_000_000):
        start = time.perf_counter()
        packer = packing.Packer(packing.Limits())
        packer.add(packing.Piece(1, memoryview(bytes(4 * n)), 0, n, 0, n))
        packer.finish()
        spent.append(time.perf_counter() - start)
        assert sum(p.length for p, _, _ in packer.out) == n
    assert spent[1] < 30 * spent[0] + 0.2


def test_packing_repeated_rows_and_null_ids(spark):
    rows = [(3, "a b")] * 3 + [(None, "c"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit(1)).withColumn("ids", F.lit("x"))
    got = packing.pack(df).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert sorted((str(r["doc_id"]), r["n"], r["m"]) for r in got) == [("3", 9, 3), ("None", 3, 2)]


def test_clean_up(spark):
    common.clean_up(spark)
    path = common.written(spark.range(5).toDF("a"), "x").inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.parquet(path).count() == 5
    assert common.clean_up(spark) == 1 and common.clean_up(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


@pytest.mark.parametrize("page, want", [
    ("a<svg><title>t</title><defs><text>d</text></defs><text>label</text><desc>x</desc></svg>b", "alabelb"),
    ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='tex'>x=2</annotation></math>", "x=2"),
    ("<p>see <svg><style>.a{}</style><text>one</text><metadata>m</metadata></svg></p><p>two", "see one\n\ntwo"),
])
def test_html_drawings_and_formulas(page, want):
    assert html.visible_text(page) == want


def test_html_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "<p>a", "t", 5)] * 3 + [(None, "<p>b", "t", 5)],
                               "page_id bigint, html string, text string, n_chars int")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html.extract(df).collect())
    assert got == [("1", "a", 1)] * 3 + [("None", "b", 1)]


def test_chat_long_text_repeated_turns_and_hot_conversation(spark):
    """A text of a million characters, a turn there twice, a third of all turns in one conversation."""
    long = "<|end|> said [INST] é " * 50_000
    rows = ([(1, 0, "user", "hi"), (1, 1, "assistant", long), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"),
             (1, 1, "assistant", "a"), (2, 0, "assistant", "")]
            + [(3, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(400)]
            + [(10 + i, 0, "user", "x") for i in range(800)])
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(8)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert len(got) == 803
    by_conv: dict = {}
    for c, t, r, x in rows:
        by_conv.setdefault(c, []).append((t, r, x))
    for c, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()


def test_chat_reads_a_mask_that_covers_part_of_a_text(spark):
    """The text under the mask is what the mask says, not what the role would bear."""
    turns = chat.format_turns(spark.createDataFrame([(1, 0, "assistant", "one two three")],
                                                    "conv_id bigint, turn bigint, role string, text string")).collect()
    mask = bytearray(turns[0]["loss_mask"])
    mask[mask.index(1)] = 0
    cut = spark.createDataFrame([(1, 0, turns[0]["ids"], bytes(mask))],
                                "conv_id bigint, turn bigint, ids binary, loss_mask binary")
    row = chat.read_turns(cut).first()
    assert row["text"] == "one two three" and row["loss"] == " two three"
    assert chat.read_back(cut).first()["loss_chars"] == len(" two three")
