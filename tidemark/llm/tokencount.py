"""Token counts by batch encoding inside Arrow functions that return lengths only.

A task's texts are handed to the tokenizer in calls of about equal bytes,
whatever the lengths of the rows: short texts share a call, a long one is
split at safe boundaries into pieces that are encoded apart and counted
together.  A boundary is safe where the vocabulary's rules never join what
stands on both sides: before white space after a word or punctuation sign,
or between an ideographic stop and a letter of scripts without spaces.  The
ids themselves never leave the call.

Within a call all white space after a word is such a boundary, and so is a
closing sign after an ASCII letter, so a call's words are told apart and made
distinct in Arrow, and only those that no bounded cache of lengths holds are
encoded.  (The public vocabularies' rules part letters from signs; only an
apostrophe can join them, and only ``<``, ``|`` and ``>`` stand in special strings.)
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
PIECE_CHARS = 1 << 15        # texts beyond are split
CALL_BYTES = 1 << 20         # encoded in one call
ARROW_BYTES = 1 << 24        # handed to a task's Python at once
CACHE_WORDS = 400_000
CACHE_BYTES = 64             # longer words aren't kept
MARK = "▁"

# The sign before a cut is a word or ASCII punctuation sign, the one after it ASCII white space;
# or the cut is between an ideographic stop and a kana, Han or Hangul letter.
SAFE = re.compile(r"[\w!-~](?=[ \t\n\r])|[。、！？，；：](?=[ぁ-ゖァ-ヺ一-龥가-힣])")
# One space between word or ASCII punctuation signs, which the cut takes away: a piece's
# own leading mark stands for it.
SAFE_SPACE = re.compile(r"[\w!-~](?= [\w!-~])")


_CLOSING, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_CLOSING[list(b".,;:!?)]}\"")] = True
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def word_starts(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 are ASCII white space right after an ASCII sign or a letter of the
    Latin-1 block (lead byte 0xC3), or a closing sign right after an ASCII letter."""
    space = (data == 0x20) | (data == 0x09) | (data == 0x0A) | (data == 0x0D)
    after = np.zeros(len(data), bool)
    after[1:] = (data[:-1] > 0x20) & (data[:-1] < 0x7F)
    after[2:] |= data[:-2] == 0xC3
    out = space & after
    out[1:] |= _CLOSING[data[1:]] & _LETTER[data[:-1]]
    return out


class JsonCounter:
    """Lengths by the ``tokenizers`` library, special strings handled as its default."""

    skip = 0
    safe: re.Pattern | None = SAFE

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(re.search(r"\s", s) or SAFE.search(s) for s in special):
            self.safe = None                    # a cut could fall inside a special string
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_lengths(self, words: list[bytes]) -> list[int]:
        """Lengths of distinct words, each with the white space before it."""
        if len(self.known) + len(words) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        missing = [w for w in words if w not in known]
        known.update((w, older[w]) for w in missing if w in older)
        missing = [w for w in missing if w not in known]
        found = dict(zip(missing, self._encoded([w.decode() for w in missing])))
        out = [n if (n := known.get(w)) is not None else found[w] for w in words]
        known.update((w, n) for w, n in found.items() if len(w) <= CACHE_BYTES)
        return out

    def lengths(self, texts: list[str]) -> list[int]:
        if self.safe is None:
            return self._encoded(texts)
        raw = [t.encode() for t in texts]
        ends = np.cumsum([len(t) for t in raw])
        starts = np.concatenate(([0], ends[:-1]))
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return [0] * len(texts)
        cuts = word_starts(data)
        cuts[starts[starts < ends]] = True
        begin = np.flatnonzero(cuts)
        at = np.concatenate((begin, [len(data)])).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        length = np.array(self._word_lengths(words.dictionary.to_pylist()), np.int64)
        total = np.concatenate(([0], np.cumsum(length[words.indices.to_numpy()])))
        return (total[np.searchsorted(begin, ends)] - total[np.searchsorted(begin, starts)]).tolist()


class ModelCounter:
    """Lengths by the ``sentencepiece`` library, without begin and end ids."""

    skip = 1

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
        apart = (not any(MARK in p.lstrip(MARK) for p in pieces)
                 and sp.encode("a a", out_type=str) == 2 * sp.encode("a", out_type=str))
        self.safe = SAFE_SPACE if apart else None

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.sp.encode(texts, num_threads=1)]


_counters: dict[str, JsonCounter | ModelCounter] = {}


def counter(vocabulary: str = VOCABULARY) -> JsonCounter | ModelCounter:
    if vocabulary not in _counters:
        kind = ModelCounter if vocabulary.endswith(".model") else JsonCounter
        _counters[vocabulary] = kind(tokenizer_path(vocabulary))
    return _counters[vocabulary]


def pieces(text: str, safe: re.Pattern | None, skip: int, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` cut at the first safe boundary after every ``size`` characters;
    ``skip`` characters after a cut belong to no piece."""
    at = 0
    while safe is not None and len(text) - at > size:
        m = safe.search(text, at + size - 1)
        if m is None:
            break
        yield text[at:m.end()]
        at = m.end() + skip
    yield text[at:] if at else text


def token_counts(texts: list[str | None], vocabulary: str = VOCABULARY, piece_chars: int = PIECE_CHARS,
                 call_bytes: int = CALL_BYTES) -> list[int]:
    """Tokens of each text (null: of the empty text), encoded in calls of about ``call_bytes``."""
    count = counter(vocabulary)
    totals = [0] * len(texts)
    waiting: list[str] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        for i, n in zip(owners, count.lengths(waiting)):
            totals[i] += n
        waiting.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        if not text:
            continue
        for piece in pieces(text, count.safe, count.skip, piece_chars):
            size = len(piece) if piece.isascii() else len(piece.encode())
            if waiting and held + size > call_bytes:
                flush()
            waiting.append(piece)
            owners.append(i)
            held += size
    if waiting:
        flush()
    return totals


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``df``: UTF-8 bytes and tokens of its
    text, and whether there are more than ``limit`` tokens.

    ``vocabulary`` names a public tokenizer file, ``.json`` or ``.model``.  A null
    text counts as empty (0 bytes, 0 tokens); a repeated row or id and a null id
    give a row each; an empty table gives none.  A text of any length is counted
    whole; one without a safe boundary is encoded in one call.  Other columns,
    whatever their names, are not read.  A map over the scan, without a shuffle;
    Python receives at most about ``ARROW_BYTES`` (or one row) at once.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))

    @F.arrow_udf("bigint")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(token_counts(texts.to_pylist(), vocabulary), pa.int64())

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (df.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
            .select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), tokens("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
