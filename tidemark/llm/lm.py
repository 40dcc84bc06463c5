"""Language-model scores by a log-bilinear model trained with noise contrast.

Words are counted over all training documents.  The model predicts a
token's class from the two classes before it: the most frequent words have
classes of their own, the end of a text has one, and all other words share
classes by their last letters, within which a word has its smoothed share.
Each task trains on its own documents from the same start and the models
are averaged, weighted by tokens, in two rounds that use each document
once.  Probabilities are normalised over all classes by matrix products.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import id_crc, text_bytes, written

OWN = 767               # most frequent words, each a class
SHARED = 256            # classes of all other words
CLASSES = OWN + SHARED + 1
END_CLASS = CLASSES - 1
END = b""               # the end token among words
DIMENSIONS = 16
NOISE = 32              # noise samples of a batch, shared by its tokens
STEP_TOKENS = 2048
RATE = 0.15
#: Words that make up at least 1 / HEAVY of all training tokens, so HEAVY at most, are
#: broadcast with their counts; all others are joined, and none of them is a hot key.
HEAVY = 1 << 19
FLUSH_WORDS = 200_000


def split(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased, cut at ASCII white space."""
    return text.lower().split()


def shared_class(word: bytes) -> int:
    return OWN + zlib.crc32(word[-2:]) % SHARED


@dataclass
class Vocabulary:
    """Counts that every task needs: bounded by HEAVY and CLASSES."""
    heavy: dict[bytes, int]         # place in the arrays
    counts: np.ndarray
    tokens: int                     # N
    words: int                      # V
    class_counts: np.ndarray
    shared_total: np.ndarray        # per shared class: sum of (count + 1) over its words, plus 1
    least: int                      # smallest count of a heavy word

    def classes(self) -> np.ndarray:
        """Class of each heavy word: the first ones have their own."""
        out = np.empty(len(self.heavy) + 1, np.int64)
        own = 0
        for w, i in self.heavy.items():
            if w == END:
                out[i] = END_CLASS
            elif own < OWN:
                out[i] = own
                own += 1
            else:
                out[i] = shared_class(w)
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over (text) rows, the end of each text included; counted in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                              names=["word", "c"])
        counts: Counter = Counter()
        for b in batches:
            counts[END] += b.num_rows
            for t in text_bytes(b.column(0)):
                counts.update(split(t))
                if len(counts) >= FLUSH_WORDS:
                    yield out(counts)
                    counts.clear()
        yield out(counts)

    return (docs.mapInArrow(run, "word binary, c bigint").where("c > 0")
            .groupBy("word").agg(F.sum("c").alias("c")))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, words = int(total[0]), int(total[1])
    least = -(-tokens // HEAVY)
    rows = counts.where(F.col("c") >= least).orderBy(F.desc("c"), "word").toArrow()
    names, c = [bytes(w) for w in rows.column("word").to_pylist()], rows.column("c").to_numpy()
    own = [w for w in names if w != END][:OWN]
    cls = F.when(F.col("word").isin(own) | (F.length("word") == 0), F.lit(-1)).otherwise(
        F.crc32(F.expr("substring(word, -2)")) % SHARED) if own else F.lit(-1)
    class_counts, shared = np.ones(CLASSES), np.ones(SHARED)
    place = {w: i for i, w in enumerate(names)}
    for i, w in enumerate(own):
        class_counts[i] += c[place[w]]
    if END in place:
        class_counts[END_CLASS] += c[place[END]]
    for r in counts.select(cls.alias("k"), "c").where("k >= 0").groupBy("k").agg(
            F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        class_counts[OWN + r["k"]] += r["c"]
        shared[r["k"]] += r["c"] + r["v"]
    return Vocabulary(place, c.astype(np.float64), tokens, words, class_counts, shared, least)


class Model:
    """score(class | two before) = (R[w1] * C[0] + R[w2] * C[1]) . Q[class] + b[class]."""

    def __init__(self, parts: list[np.ndarray]):
        self.R, self.Q, self.b, self.C = parts

    @classmethod
    def start(cls, class_counts: np.ndarray, seed: int = 11) -> Model:
        rng = np.random.default_rng(seed)
        r = rng.normal(0, 0.1, (2, CLASSES, DIMENSIONS)).astype(np.float32)
        share = np.log(class_counts / class_counts.sum()).astype(np.float32)
        return cls([r[0], r[1], share, np.full((2, DIMENSIONS), 0.5, np.float32)])

    def parts(self) -> list[np.ndarray]:
        return [self.R, self.Q, self.b, self.C]


def contexts(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token; before a text stands the end class."""
    one = np.concatenate(([END_CLASS], classes[:-1]))
    two = np.concatenate(([END_CLASS, END_CLASS], classes[:-2]))[:len(classes)]
    one[starts] = END_CLASS
    two[starts] = END_CLASS
    later = starts + 1
    two[later[later < len(classes)]] = END_CLASS
    return one, two


def _scatter(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``rows`` by index."""
    order = np.argsort(index, kind="stable")
    s = index[order]
    at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return s[at], np.add.reduceat(rows[order], at, axis=0)


class Trainer:
    """Noise-contrastive estimation by Adagrad on batches of tokens."""

    def __init__(self, model: Model, class_counts: np.ndarray, seed: int):
        self.m = Model([p.copy() for p in model.parts()])
        p = class_counts / class_counts.sum()
        self.cut = np.cumsum(p)
        self.log_noise = np.log(NOISE * p).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.seen = [np.full_like(p, 1e-2) for p in self.m.parts()]
        self.tokens = 0

    def _update(self, k: int, index: np.ndarray | slice, g: np.ndarray) -> None:
        seen, p = self.seen[k], self.m.parts()[k]
        seen[index] += g * g
        p[index] -= RATE * g / np.sqrt(seen[index])

    def learn(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        order = self.rng.permutation(len(target))
        for i in range(0, len(order), STEP_TOKENS):
            o = order[i:i + STEP_TOKENS]
            self._step(target[o], one[o], two[o])
        self.tokens += len(target)

    def _step(self, t: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        R, Q, bias, C = self.m.parts()
        noise = np.minimum(np.searchsorted(self.cut, self.rng.random(NOISE)), CLASSES - 1)
        ra, rb = R[a], R[b]
        q = ra * C[0] + rb * C[1]
        qt, qn = Q[t], Q[noise]
        s_true = (q * qt).sum(axis=1) + bias[t] - self.log_noise[t]
        s_noise = q @ qn.T + (bias[noise] - self.log_noise[noise])
        scale = np.float32(1 / len(t))
        g_true = -scale / (1 + np.exp(np.clip(s_true, -30, 30)))
        g_noise = scale / (1 + np.exp(np.clip(-s_noise, -30, 30)))
        dq = g_true[:, None] * qt + g_noise @ qn
        at, g = _scatter(np.concatenate((t, noise)),
                         np.concatenate((g_true[:, None] * q, g_noise.T @ q)))
        gb = np.bincount(t, g_true, CLASSES) + np.bincount(noise, g_noise.sum(axis=0), CLASSES)
        ar, gr = _scatter(np.concatenate((a, b)), np.concatenate((dq * C[0], dq * C[1])))
        self._update(1, at, g)
        self._update(2, slice(None), gb.astype(np.float32))
        self._update(0, ar, gr)
        self._update(3, slice(None), np.stack([(dq * ra).sum(axis=0), (dq * rb).sum(axis=0)]))


def _places(texts: list[bytes], heavy: dict[bytes, int]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words and end of each text, the place of every token (-1: not heavy), each text's first token."""
    words = [split(t) for t in texts]
    for w in words:
        w.append(END)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    places = np.empty(int(starts[-1]), np.int64)
    for w, i, j in zip(words, starts.tolist(), starts[1:].tolist()):
        places[i:j] = list(map(heavy.get, w, repeat(-1)))
    return words, places, starts


def _token_classes(words: list[list[bytes]], places: np.ndarray, of_heavy: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Class of every token, and the words that aren't heavy, in order."""
    classes = of_heavy[places]
    rare = np.flatnonzero(places < 0)
    flat = [w for ws in words for w in ws]
    names = [flat[i] for i in rare.tolist()]
    classes[rare] = [shared_class(w) for w in names]
    return classes, names


def train(docs: DataFrame, vocab: Vocabulary) -> Model:
    """The averaged model of (doc_id, text) rows."""
    spark = docs.sparkSession
    model = Model.start(vocab.class_counts)
    words = spark.sparkContext.broadcast(vocab)
    slices = F.pmod(F.xxhash64("doc_id"), F.lit(8)) if "doc_id" in docs.columns else F.lit(0)
    for rows in (docs.where(slices == 0), docs.where(slices != 0)):
        start = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v = words.value
            of_heavy = v.classes()
            trainer = Trainer(start.value, v.class_counts, TaskContext.get().partitionId())
            for b in batches:
                ws, places, starts = _places(text_bytes(b.column(0)), v.heavy)
                classes, _ = _token_classes(ws, places, of_heavy)
                trainer.learn(classes, *contexts(classes, starts[:-1]))
            flat = np.concatenate([p.ravel() for p in trainer.m.parts()]).astype("<f4")
            yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()]), pa.array([trainer.tokens])],
                                             names=["model", "n"])

        trained = rows.select("text").mapInArrow(run, "model binary, n bigint").where("n > 0")
        summed = (trained.rdd.map(lambda r: (np.frombuffer(r["model"], "<f4").astype(np.float64) * r["n"], r["n"]))
                  .treeAggregate((0.0, 0), lambda x, y: (x[0] + y[0], x[1] + y[1]),
                                 lambda x, y: (x[0] + y[0], x[1] + y[1]), depth=3))
        if summed[1]:
            flat, parts = (summed[0] / summed[1]).astype(np.float32), []
            for p in model.parts():
                parts.append(flat[:p.size].reshape(p.shape))
                flat = flat[p.size:]
            model = Model(parts)
    return model


class Scorer:
    """Normalised log10 class probabilities; normalisers are kept per context."""

    def __init__(self, model: Model):
        self.m = model
        self.log_z = np.full(CLASSES * CLASSES, np.nan, np.float32)

    def log10(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        R, Q, bias, C = self.m.parts()
        code = one * CLASSES + two
        new = np.unique(code[np.isnan(self.log_z[code])])
        for i in range(0, len(new), 4096):
            k = new[i:i + 4096]
            s = (R[k // CLASSES] * C[0] + R[k % CLASSES] * C[1]) @ Q.T + bias
            top = s.max(axis=1)
            self.log_z[k] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        out = np.empty(len(target))
        for i in range(0, len(target), 1 << 17):
            c = slice(i, i + (1 << 17))
            s = ((R[one[c]] * C[0] + R[two[c]] * C[1]) * Q[target[c]]).sum(axis=1) + bias[target[c]]
            out[c] = (s - self.log_z[code[c]]) / np.log(10)
        return out


_EMITTED = ("row bigint, doc_id bigint, held_out boolean, word binary, n bigint, n_tokens bigint, "
            "known bigint, base double, score double")


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``df``.

    The rows whose id's crc32 mod 7 is not 2 teach; a null id teaches and
    isn't held out.  A null text is empty and has the end token alone.
    Repeated rows count and are scored each.  Without training rows every
    word is unknown.  Other columns are not read.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(id_crc(id_col) % 7 == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    taught = docs.where("not held_out")
    counts = written(count_words(taught.select("text")), "counts")
    vocab = vocabulary(counts)
    model = train(taught.select("doc_id", "text"), vocab)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((vocab, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, m = shared.value
        scorer, of_heavy = Scorer(m), v.classes()
        log_count = np.log10(np.concatenate((v.counts + 1, [1.0])))     # the last: not heavy, joined later
        log_share = np.log10(v.shared_total)
        per_token = np.log10(v.tokens + v.words + 1)
        for b in batches:
            if not b.num_rows:
                continue
            words, places, starts = _places(text_bytes(b.column(3)), v.heavy)
            classes, rare = _token_classes(words, places, of_heavy)
            own = scorer.log10(classes, *contexts(classes, starts[:-1]))
            in_shared = (classes >= OWN) & (classes < END_CLASS)
            own[in_shared] += log_count[places[in_shared]] - log_share[classes[in_shared] - OWN]
            first = starts[:-1]
            sizes = np.diff(starts)
            base = np.add.reduceat(log_count[places], first) - sizes * per_token
            known = np.add.reduceat((places >= 0).astype(np.int64), first)
            row = b.column(0).to_numpy()
            # rare words, counted per document
            at = np.searchsorted(np.flatnonzero(places < 0), starts)
            r_row, r_word, r_n = [], [], []
            for r, i, j in zip(row.tolist(), at.tolist(), at[1:].tolist()):
                if i < j:
                    c = Counter(rare[i:j])
                    r_row += [r] * len(c)
                    r_word += c
                    r_n += c.values()
            # a document's own row goes by a key that is no word
            keys = [b" " + r.to_bytes(8, "little") for r in row.tolist()]
            k = len(r_row)
            none = np.zeros(k, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((row, np.array(r_row, np.int64)))),
                pa.concat_arrays([b.column(1).cast(pa.int64()), pa.nulls(k, pa.int64())]),
                pa.concat_arrays([b.column(2), pa.nulls(k, pa.bool_())]),
                pa.array(keys + r_word, pa.binary()),
                pa.array(np.concatenate((np.zeros(len(row), np.int64), np.array(r_n, np.int64)))),
                pa.array(np.concatenate((sizes, none))), pa.array(np.concatenate((known, none))),
                pa.array(np.concatenate((base, none))),
                pa.array(np.concatenate((np.add.reduceat(own, first), none)))],
                names=[c.split()[0] for c in _EMITTED.split(", ")])

    emitted = (docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
               .mapInArrow(run, _EMITTED))
    light = counts.where(F.col("c") < vocab.least).select("word", "c")
    log_c = F.coalesce(F.sum(F.col("n") * F.log10(F.col("c") + 1)), F.lit(0.0))
    return (emitted.join(light, "word", "left").groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
                 F.sum("n_tokens").alias("n_tokens"),
                 (F.sum("known") + F.coalesce(F.sum(F.when(F.col("c").isNotNull(), F.col("n"))), F.lit(0)))
                 .alias("n_known"),
                 F.lit(vocab.tokens).cast("bigint").alias("train_tokens"),
                 (F.sum("base") + log_c).alias("base_score"), (F.sum("score") + log_c).alias("score"))
            .drop("row"))
