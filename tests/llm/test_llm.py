"""The training-data operators against brute force, libraries, round trips and held-out labels."""

import hashlib
import re
import time
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tidemark.llm import ann, chat, embdedup, html, langid, lm, minhash, packing, quality, sentencepiece
from tidemark.llm.common import table

ODD = [None, "", "  \n", "a", "a b c d e f", "A B C d e F", "Ünï ﬁ 中文 😀\t<s></s> ▁ x", "word " * 3000, "x" * 5000]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, a column that clashes with an operator's own."""
    rows = [(i, t, "en" if i % 2 else None, "s", 1) for i, t in enumerate(ODD)] + [(3, "a", "en", "s", 1)] * 2
    rows += [(None, "a b c d e f", None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score int")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_SMALL, "documents").cache()


def rows_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_empty_tables(spark, odd):
    none = odd.where("false")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    for df in (packing.pack(none), lm.score(none), langid.predict(none, langid.fit(none)),
               sentencepiece.encode_documents(none), minhash.near_duplicates(none), minhash.keep_one(none),
               chat.read_back(chat.format_turns(spark.createDataFrame(
                   [], "conv_id bigint, turn bigint, role string, text string"))),
               quality.score(none, quality.fit(none, labels)), ann.search(vectors), embdedup.near_duplicates(vectors),
               html.extract(spark.createDataFrame([], "page_id bigint, html string"))):
        assert df.count() == 0


def test_packing(docs, odd):
    tokenizer = packing.word_tokenizer().tokenizer
    for df in (docs, odd.where("doc_id <> 3 AND doc_id IS NOT NULL")):
        want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [2] for i, t in rows_of(df)}
        got, lengths = {}, {}
        for r in sorted(packing.pack(df).collect(), key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == lengths.get(r["sequence_id"], 0)
            lengths[r["sequence_id"]] = r["offset"] + r["length"]
            assert r["doc_tokens"] == len(want[r["doc_id"]]) and r["loss_tokens"] == r["length"]
            got.setdefault(r["doc_id"], []).append((r["start"], array("I", r["ids"]).tolist()))
        for i, ids in want.items():
            assert [x for _, p in sorted(got[i]) for x in p] == ids
        assert all(n <= 4096 and n & (n - 1) == 0 for n in lengths.values())


def test_packing_limits():
    packer = packing.Packer(packing.Limits(tokens=64, segments=3, loss=20), pool=8)
    for i in range(50):
        packer.add(packing.Piece(i, bytes(4 * (i % 70 + 1)), 0, i % 70 + 1, i % 11, i % 70 + 1))
    packer.finish()
    by = {}
    for p, s, _ in packer.out:
        by.setdefault(s, []).append(p)
    assert sum(p.length for p, _, _ in packer.out) == sum(i % 70 + 1 for i in range(50))
    for ps in by.values():
        assert sum(p.length for p in ps) <= 64 and len(ps) <= 3 and sum(p.loss() for p in ps) <= 20


def test_lm_base_by_brute_force(docs, monkeypatch):
    monkeypatch.setattr(lm, "HEAVY", 500)       # so that most words go through the join
    words = {i: t.encode().lower().split() + [b""] for i, t in rows_of(docs)}
    count = {}
    for i, ws in words.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in ws:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for r in lm.score(docs).collect():
        ws = words[r["doc_id"]]
        base = sum(np.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in ws)
        assert abs(base - r["base_score"]) < 1e-6 * abs(base) and r["train_tokens"] == n
        assert r["n_tokens"] == len(ws) and r["n_known"] == sum(w in count for w in ws) and r["score"] < 0


def test_lm_normalised():
    model = lm.Model.start(np.ones(lm.CLASSES))
    one = np.full(lm.CLASSES, 3)
    p = 10 ** lm.Scorer(model).log10(np.arange(lm.CLASSES), one, one)
    assert abs(p.sum() - 1) < 1e-4


def test_lm_odd_rows(odd):
    assert lm.score(odd).count() == odd.count()


def test_langid(docs, odd):
    model = langid.fit(docs)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = [r for r in langid.predict(docs, model).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.95
    for r in langid.predict(odd, model).collect():
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (0, 1, 2)) and 0 <= r["score"] <= 1


def test_langid_phrases_by_brute_force():
    sample, text = "abracadabraabc", "abrabcxaad"
    symbols = {c: i + 2 for i, c in enumerate("abcdrx")}
    lut = np.zeros(0x110000, np.uint8)
    for c, s in symbols.items():
        lut[ord(c)] = s
    model = langid.LanguageModel(("l",), lut, (langid._automaton(
        np.array([symbols[c] for c in sample]), langid.ALPHABET + 2),))
    n, at = 0, 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at:at + k + 1] in sample:
            k += 1
        n, at = n + 1, at + k
    assert langid.phrase_counts([text, text * 100], model)[0][0, 0] == n


def language_docs(spark, starts, docs, words, seed=0):
    """Documents of invented languages, each of words over 30 letters from a code point on."""
    rng, rows = np.random.default_rng(seed), []
    for k, start in enumerate(starts):
        vocabulary = ["".join(chr(start + i) for i in rng.integers(0, 30, 4)) for _ in range(60)]
        for _ in range(docs):
            rows.append((len(rows), " ".join(rng.choice(vocabulary, words)), f"l{k:03}"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(2)


def test_langid_many_scripts(spark):
    scripts = language_docs(spark, [0x4E00 + 40 * k for k in range(68)] + [0x430, 0xAC00], 8, 20)
    model = langid.fit(scripts)
    truth = {r["doc_id"]: r["lang"] for r in scripts.collect()}
    assert len(model.languages) == 70
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in langid.predict(scripts, model).collect())
    assert langid.keep_known(scripts, model).count() == len(truth)


def test_langid_even_samples(spark):
    # one short document beside long ones; documents all beyond 20,000 characters; many short ones
    a = language_docs(spark, [0x61], 60, 1500).collect()
    b = language_docs(spark, [0x61], 12, 6000, 1).collect()
    c = language_docs(spark, [0x61], 6000, 3, 2).collect()
    rows = [(0, "aaaa bbbb", "a")] + [(0, r["text"], k) for k, d in (("a", a), ("b", b), ("c", c)) for r in d]
    given = spark.createDataFrame([(i, t, k) for i, (_, t, k) in enumerate(rows)],
                                  "doc_id bigint, text string, lang string").coalesce(2)
    model = langid.fit(given)
    assert model.languages == ("a", "b", "c")
    assert [t.size for t in model.tables] == [langid.SAMPLE_SYMBOLS] * 3
    runs = [np.full(n, i, np.uint8) for i, n in enumerate((10, 5000, 5000, 40))]
    assert np.bincount(langid._even(runs, 1001)).tolist() == [10, 476, 475, 40]
    assert np.bincount(langid._even(runs, 90_000)).tolist() == [10, 5000, 5000, 40]
    # a language with little text, as a weaker sample must not lose its documents
    few = given.where("lang <> 'b' OR doc_id % 4 = 2").withColumn("text", F.when(F.col("lang") == "b", F.substring(
        "text", 1, 400)).otherwise(F.col("text")))
    model = langid.fit(few)
    assert model.tables[1].size < 2000
    found = langid.predict(given.where("lang = 'b'").withColumn("text", F.substring("text", 500, 200)), model)
    assert all(r["lang_pred"] == "b" for r in found.collect())
    model = langid.fit(given)
    truth = {i: k for i, (_, _, k) in enumerate(rows)}
    got = [r for r in langid.predict(given, model).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got if r["doc_id"]]) > 0.98


def test_langid_keeps_short_and_unlearned(spark):
    taught = language_docs(spark, [0x61], 60, 100)
    texts = ["z", "Ok.", "Ж", "1 2", "", None, "Привет мир, как дела? Что нового сегодня?"]
    some = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for lang, want in (("lang", {0, 1, 2}), ("NULL", {0, 1, 2, 6})):
        model = langid.fit(taught.selectExpr("doc_id", "text", f"CAST({lang} AS string) AS lang"))
        assert len(model.languages) == (lang == "lang")
        assert {r["doc_id"] for r in langid.keep_known(some, model).collect()} == want


def test_sentencepiece(docs, odd):
    sp = sentencepiece.encoder().sp
    for df in (docs, odd):
        want = sorted((str(i), sp.encode(t, add_bos=True, add_eos=True)) for i, t in rows_of(df))
        got = sorted((str(r["doc_id"]), array("I", r["ids"]).tolist(), r["decoded"])
                     for r in sentencepiece.encode_documents(df).collect())
        assert [g[:2] for g in got] == want
        assert [g[2] for g in got] == [sp.decode(w[1]) for w in want]


def shingles(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_minhash(docs, odd):
    sets = {i: shingles(t) for i, t in rows_of(docs)}
    want = brute_components(sets)
    for r in minhash.near_duplicates(docs).collect():
        assert (r["component_id"], r["n_shingles"]) == (want[r["doc_id"]], len(sets[r["doc_id"]]))
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {r["component_id"] for r in got if r["doc_id"] in (4, 5) or r["doc_id"] is None} == {4}
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]


@pytest.mark.parametrize("block", [minhash.SHINGLES, 2000])
def test_minhash_family_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "SHINGLES", block)     # the smaller: groups of several blocks
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.integers(0, len(w), rng.integers(1, 5)):
            w[k] = f"z{i}{k}"
        rows.append((i, " ".join(w)))
    want = brute_components({i: shingles(t) for i, t in rows})
    assert 10 < len(set(want.values())) < 140
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_chat(spark):
    texts = ["</s>[INST] ok [/INST]", "<|turn|> <\\|end|> \\[INST] [\\/INST] <s><", None, "é😀 plain\n"]
    rows = [(c, t, r, x, "x") for c in (1, -7, None) for t, (r, x) in enumerate(
        zip(["user", "assistant", None, "assistant"], texts))]
    turns = chat.format_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, ids string"))
    for r in turns.collect():
        ids = array("I", r["ids"]).tolist()
        assert (ids[0], ids[-1]) == (chat.TURN, chat.END) and len(r["loss_mask"]) == len(ids)
    said = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x, _ in rows[:4])
    loss = (texts[1] or "") + texts[3]
    got = chat.read_back(turns).collect()
    assert len(got) == 3
    for r in got:
        assert r["n_turns"] == 4 and r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    for t in texts:
        assert chat.unescape(chat.escape(t or "")) == (t or "")


def test_quality(spark, docs, odd):
    labels = table(spark, SF_SMALL.replace("0.001", "0.01"), "labels")
    big = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    model = quality.fit(big, labels)
    got = quality.score(big, model).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([(r["score"] >= 0.3) == bool(r["quality"]) for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd, model).collect())
    one = quality.fit(big, labels.where("quality = 1"))
    assert all(r["score"] > 0.9 for r in quality.score(odd, one).collect())
    assert quality.keep_good(odd, model, 0.0).columns == odd.columns


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[200:220] = x[100] + rng.normal(size=(20, 16)).astype(np.float32) * 0.05
    x[300:310] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16),
                                                         (1003, [None] + [1.0] * 15), (7, x[7].tolist())]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), x.astype(float)


def test_ann(vectors):
    df, x = vectors
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -2)
    found, total = 0, 0
    for q in range(0, 400, 50):
        got = {r["vec_id"]: r["score"] for r in ann.search(df).where(f"query_id = {q}").collect()}
        best = np.lexsort((np.arange(400), -s[q].round(12)))[:5]
        found, total = found + len(set(best.tolist()) & set(got)), total + 5
        assert all(abs(s[q, v] - c) < 1e-9 for v, c in got.items())
    assert found / total >= 0.9


def test_embedding_dedup(vectors):
    df, x = vectors
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = (u @ u.T >= 0.9) & ~np.eye(400, dtype=bool)
    label = np.arange(400)
    for _ in range(400):
        new = np.array([min(label[i], *label[near[i]], label[i]) for i in range(400)])
        if (new == label).all():
            break
        label = new
    got = {r["vec_id"]: r for r in embdedup.near_duplicates(df).collect()}
    assert len(got) == 404
    for i in range(400):
        assert (got[i]["n_links"], got[i]["component_id"]) == (near[i].sum(), label[i])
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (1000, 1001, 1002, 1003))


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p", ""), ("<div>" * 3000 + "x", "x"), ("a &lt; b<br>c", "a < b\nc"),
    ("<p>a <b>b</b>c<p>d", "a bc\n\nd"), ("<ul><li>x<li>y<ol start=3><li>z</ol></ul>", "- x\n- y\n  3. z"),
    ("<table><tr><td>aa<td>b<tr><td>c<td>dd</table>", "aa  b\nc   dd"),
    ("<style>s</style><script>'</p>'</script><i hidden>h</i><b style='display: none'>n</b>v", "v"),
    ("<table><tr><td rowspan=2>r<td>1</tr><tr><td>2</table>", "r  1\n   2"), ("<pre> a\n  b</pre>", " a\n  b"),
])
def test_html(page, want):
    assert html.visible_text(page) == want


@pytest.mark.parametrize("tag", ["img src", "div hidden title", "div style='display:none' title"])
@pytest.mark.parametrize("quote", ["'", '"'])
def test_html_long_attributes(tag, quote):
    value = "data:x;y,<p>" + "AB>C" * 250_000
    page = f"<p>a<{tag}={quote}{value}{quote}>b</div>c"
    assert html.visible_text(page) == ("abc" if tag == "img src" else "a\n\nc")


@pytest.mark.parametrize("page, want", [
    ("<p title=it's>a</p><p class='x''>b</p><p 5\">c", "a\n\nb\n\nc"), ('a <i title="b>c <b>d</b>', 'a <i title="b>c d'),
    ("<i title = 'x>y'/hidden>n</i><i =hidden>v</i>", "v"),
])
def test_html_quotes(page, want):
    assert html.visible_text(page) == want


@pytest.mark.parametrize("part, end", [("<a ", ""), ("<a ", '="'), ("<a", ' ="'), ('<a x="1>2" ', ""), ("<b/y=c", " y='"),
                                       ("<a x='<b x=\"", ""), ("<a/", "='"), ("<a x = ", "'>")])
def test_html_broken_tags_in_linear_time(part, end):
    page = part * (1_000_000 // len(part)) + end
    start = time.perf_counter()
    html.visible_text(page)
    assert time.perf_counter() - start < 20


def test_html_pages(spark):
    pages = table(spark, SF_SMALL, "pages")
    for r in html.extract(pages).collect():
        assert r["n_chars"] == len(r["text"]) > 0 and "track(" not in r["text"]


def test_pipeline(spark):
    """The result is what plain versions of the stages keep, whole and once each."""
    docs = table(spark, SF_SMALL, "documents")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], SF_SMALL).cache())
        assert steps[-1].columns == docs.columns
    scored = quality.score(docs, quality.fit(docs, table(spark, SF_SMALL, "labels"))).where("score >= 0.3")
    assert sorted(r[0] for r in steps[1].select("doc_id").collect()) == sorted(r["doc_id"] for r in scored.collect())
    assert steps[2].count() == steps[1].count()         # every clean document is in a known language
    roots = brute_components({i: shingles(t) for i, t in rows_of(steps[2])})
    assert sorted(r["doc_id"] for r in steps[3].collect()) == sorted(set(roots.values()))
    packed = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(roots.values())
    want = {i: len(packing.word_tokenizer().tokenizer.encode(t, add_special_tokens=False).ids) + 1
            for i, t in rows_of(steps[3])}
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == want
