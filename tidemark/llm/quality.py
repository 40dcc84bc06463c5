"""Compression classifier: good and bad labelled text each give a zstandard
dictionary; how much smaller a text gets with one than with the other,
against its compressed size, becomes a calibrated probability of the good
label.  The compressed size per byte enters the calibration too: text that
says one thing over and over is small under either dictionary.

Texts are compressed in blocks, each on its own, so that the dictionaries
and not a long text's own past decide; every byte of a text counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import hashed_sample, id_crc, text_bytes

# Documented bounds of the labelled sample that the dictionaries and the calibration come from.
SAMPLE_DOCS = 1500          # about so many documents of each label
SAMPLE_CHARS = 20_000       # a longer drawn document teaches by its first so many characters
DICT_BYTES = 300 << 10
DICT_PART = 300             # bytes that a dictionary takes from a document at a time
BLOCK = 512
LEVEL = 6
FRAME_BYTES = 9             # header bytes of a compressed block, the same for every block
RIDGE = 1e-2
SMOOTH_BYTES = 16           # added to sizes, so that a few bytes can't decide


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(features @ np.array(self.weights), -30, 30)))


class Sizer:
    """Compressed sizes of texts under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.with_good, self.with_bad = (self._compressor(d) for d in (good, bad))

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=held, write_checksum=False, write_content_size=False,
                                        write_dict_id=False)

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Per text: 1, the normalised size difference, the log size per byte and its
        square; an empty text has no difference and no compression."""
        good, bad = self.with_good.compress, self.with_bad.compress
        sizes = np.zeros((len(texts), 3))
        for row, text in zip(sizes, texts):
            g = b = FRAME_BYTES * (-len(text) // BLOCK)
            for i in range(0, len(text), BLOCK):
                block = text[i:i + BLOCK]
                g += len(good(block))
                b += len(bad(block))
            row[:] = g, b, len(text)
        both = sizes[:, 0] + sizes[:, 1] + SMOOTH_BYTES
        density = np.log(both / (2 * sizes[:, 2] + SMOOTH_BYTES))
        return np.stack([np.ones(len(texts)), 5 * (sizes[:, 1] - sizes[:, 0]) / both, density, density ** 2], axis=1)


def _content(texts: list[bytes]) -> bytes:
    """Dictionary content: blocks of the texts taken in turn up to the dictionary's
    size, so that many documents have a share; the last ones are reached soonest."""
    blocks, at, size = [], 0, 0
    while size < DICT_BYTES and any(len(t) > at for t in texts):
        for t in texts:
            part = t[at:at + DICT_PART]
            if part and size < DICT_BYTES:
                blocks.append(part)
                size += len(part)
        at += DICT_PART
    return b"\n".join(blocks)[:DICT_BYTES] or b" " * 16


def _calibrate(x: np.ndarray, y: np.ndarray, share_good: float) -> np.ndarray:
    """Logistic fit (Newton steps with a small ridge), classes weighted to ``share_good``.
    A step is halved until it lowers the loss, so the fit ends at the least loss from any sample."""
    w = np.where(y == 1, share_good / max(y.sum(), 1), (1 - share_good) / max((1 - y).sum(), 1)) * len(y)
    beta, ridge = np.zeros(x.shape[1]), RIDGE
    loss = _loss(beta, x, y, w)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (w * (y - p)) - ridge * beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while (new := _loss(beta + size * step, x, y, w)) > loss - 1e-4 * size * (gradient @ step) and size > 1e-9:
            size /= 2
        if new >= loss:
            break
        beta, loss = beta + size * step, new
    return beta


def _loss(beta: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    z = x @ beta
    return float((w * (np.logaddexp(0, z) - y * z)).sum() + RIDGE / 2 * (beta @ beta))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> CompressionModel:
    """Model of a bounded sample (``SAMPLE_DOCS`` a label) of the labelled rows whose
    id's crc32 mod 5 is not 0.  Null labels, ids and texts teach nothing; an id
    labelled both ways is left out, and of an id's several texts the smallest teaches.  One label alone gives a constant score, no
    label at all 0.5."""
    marked = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .where((id_crc(id_col) % 5 != 0) & F.col(label_col).isin(0, 1))
              .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_top")).where("_y = _top"))
    counts = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    drawn = hashed_sample(marked, ["_id"], "_y", SAMPLE_DOCS).select("_id", "_y")
    # one text an id, so that the bound on ids bounds what is collected
    rows = (docs.select(F.col(id_col).alias("_doc"), F.substring(text_col, 1, SAMPLE_CHARS).alias("_text"))
            .where(F.length("_text") > 0)
            .join(F.broadcast(drawn), F.col("_doc") == F.col("_id"))
            .groupBy("_id", "_y").agg(F.min("_text").alias("_text")).select("_id", "_text", "_y").collect())
    rows = sorted(map(tuple, rows), key=lambda r: hash_id(r[0]))
    by = {y: [t.encode() for _, t, label in rows if label == y] for y in (0, 1)}
    if not by[0] or not by[1]:
        bias = 0.0 if not counts else 4.0 if counts.get(1, 0) > counts.get(0, 0) else -4.0
        return CompressionModel(b" " * 16, b" " * 16, (bias, 0.0, 0.0, 0.0))
    # half of each label makes the dictionary, the other half the calibration
    content = {y: _content(t[::2]) for y, t in by.items()}
    sizer = Sizer(content[1], content[0])
    held = {y: t[1::2] or t for y, t in by.items()}
    x = np.concatenate([sizer.features(held[y]) for y in (0, 1)])
    y = np.repeat([0.0, 1.0], [len(held[0]), len(held[1])])
    weights = _calibrate(x, y, counts.get(1, 0) / sum(counts.values()))
    return CompressionModel(content[1], content[0], tuple(map(float, weights)))


def hash_id(value: int) -> int:
    """A fixed order that doesn't follow the ids."""
    return (value * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF


def score(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score) of every row, whole text; a map over the scan.

    An empty or null text has nothing to compress and gets the score of a
    zero difference.  A null id counts as trained on (its crc32 is null).
    Repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        sizer = Sizer(fitted.good, fitted.bad)
        for b in batches:
            x = sizer.features(text_bytes(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fitted.probability(x))],
                                             names=["doc_id", "held_out", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(id_crc(id_col) % 5 == 0, F.lit(False)).alias("held_out"),
                       F.col(text_col)).mapInArrow(run, "doc_id bigint, held_out boolean, score double")


def keep_good(docs: DataFrame, model: CompressionModel, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        sizer = Sizer(fitted.good, fitted.bad)
        for b in batches:
            x = sizer.features(text_bytes(b.column(at)))
            yield b.filter(pa.array(fitted.probability(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
