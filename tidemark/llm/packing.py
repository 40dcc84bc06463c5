"""Vector bin packing of tokenised examples into fixed-size training sequences.

Each example is a vector of demands (tokens, one segment, loss-bearing
tokens); a sequence has a limit on each.  A sequence is filled by the
dot-product rule: among the waiting examples that fit, take the one whose
demands, as shares of the limits, have the largest dot product with what is
left of the sequence.  When none fits, an example is cut to fill the gap.

Every Spark partition packs its own examples from a bounded pool, so no
example is moved between machines.  A sequence that can't be filled (the
last of a partition, or one at its segment limit) is cut into sequences
whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import text_bytes, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
CACHE_WORDS = 400_000
POOL = 1024         # examples that wait in a task
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, loss_tokens bigint, "
          "doc_tokens bigint, sequence_id bigint, offset bigint")


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.float64)


@dataclass(slots=True)
class Piece:
    """A run of an example's ids (a view, so that cutting a long example copies nothing); ``prompt``
    ids of the example come before its loss-bearing ones."""
    doc_id: int | None
    ids: bytes | memoryview = field(repr=False)
    start: int
    length: int
    prompt: int
    total: int

    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.prompt))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids and the rest."""
        return (Piece(self.doc_id, self.ids[:4 * n], self.start, n, self.prompt, self.total),
                Piece(self.doc_id, self.ids[4 * n:], self.start + n, self.length - n, self.prompt, self.total))

    def most(self, tokens: int, loss: int) -> int:
        """Leading ids that hold no more than ``tokens`` ids and ``loss`` loss-bearing ones."""
        return min(self.length, tokens, max(0, self.prompt - self.start) + loss)


# Kinds of bytes.  Words of Latin letters, digits and ASCII punctuation (no apostrophe, which the
# vocabulary's rules treat apart) fall into parts that are merged on their own: a run of letters, a
# digit, a run of signs.  A word with any other byte is one part.
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
_KIND = np.full(256, OTHER, np.uint8)
for _kind, _pattern in ((SPACE, rb"[\x20\x09-\x0D]"), (LETTER, rb"[A-Za-z]"), (DIGIT, rb"[0-9]"),
                        (SIGN, rb"[!-&(-/:-@\[-`{-~]")):
    _KIND[[i for i in range(256) if re.fullmatch(_pattern, bytes([i]))]] = _kind
# Letters of the Latin-1 block: this lead byte and any second one, but for the signs of times and division.
_LEAD, _NO_LETTERS = 0xC3, (0x97, 0xB7)
PLAIN = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+|[0-9]|(?!.*<\|)[!-&(-/:-@\[-`{-~]+")
CALL_BYTES = 1 << 21        # of texts cut into parts at once


def part_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of all words in ``raw`` (UTF-8, a white space at its end) begin and end."""
    kind = _KIND[raw]
    lead = np.flatnonzero(raw[:-1] == _LEAD)
    lead = lead[~np.isin(raw[lead + 1], _NO_LETTERS)]
    kind[lead] = LETTER
    kind[lead + 1] = LETTER
    kind[np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))] = OTHER    # a special token may be spelled
    before = np.concatenate((np.full(1, SPACE, np.uint8), kind[:-1]))
    word = np.flatnonzero((kind != SPACE) & (before == SPACE))
    begins = (kind != SPACE) & ((kind != before) | (kind == DIGIT))
    odd = np.flatnonzero(kind == OTHER)
    if len(odd):
        stops = np.flatnonzero((kind == SPACE) & (before != SPACE))
        for i in np.unique(np.searchsorted(word, odd, "right") - 1).tolist():
            begins[word[i] + 1:stops[i]] = False
    following = np.concatenate((begins[1:] | (kind[1:] == SPACE), np.ones(1, bool)))
    # a part ends where the next begins or its word does
    begin = np.flatnonzero(begins)
    ends = np.flatnonzero((kind != SPACE) & following) + 1
    return begin, ends


class WordTokenizer:
    """Ids of a text from its words' parts: the vocabulary's rules drop white space and never
    look across it, nor across the parts of a plain word.  A batch's parts are told apart and made
    distinct in Arrow; ids of parts met before come from a bounded cache, and new
    plain parts are encoded in one call, the end marks in their pieces telling
    where each part ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.parts: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode_each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[bytes]) -> None:
        """Encode parts that no cache holds; an odd part is a whole word and encoded by itself."""
        plain = [p for p in parts if PLAIN.fullmatch(p)]
        if plain:
            joined = self.tokenizer.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)[0]
            ids = np.array(joined.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(plain):
                raw, at = ids.tobytes(), (ends * 4).tolist()
                self.parts.update(zip(plain, (raw[i:j] for i, j in zip([0, *at], at))))
        other = [p for p in parts if p not in self.parts]
        self.parts.update(zip(other, self._encode_each([p.decode() for p in other])))

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each of the distinct ``parts``."""
        if len(self.parts) + len(parts) > CACHE_WORDS:
            self.older, self.parts = self.parts, {}
        missing = [p for p in parts if p not in self.parts]
        known = [p for p in missing if p in self.older]
        self.parts.update((p, self.older[p]) for p in known)
        if len(known) < len(missing):
            self._learn([p for p in missing if p not in self.older])
        return list(map(self.parts.__getitem__, parts))

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        joined = b"\n".join([*texts, b""])
        raw = np.frombuffer(joined, np.uint8)
        begin, end = part_bounds(raw)
        if not len(begin):
            return [b""] * len(texts)
        # the parts' bytes without what lies between them, as one Arrow column
        size = end - begin
        at = np.concatenate(([0], np.cumsum(size)))
        data = raw[np.repeat(begin - at[:-1], size) + np.arange(at[-1])]
        column = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
        distinct = column.dictionary_encode()
        code = distinct.indices.to_numpy()
        found = self._ids(distinct.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(found), "<u4")
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(length) - length
        # ids of all parts in order, then cut by text
        n = length[code]
        stop = np.cumsum(n)
        flat = pool[np.repeat(first[code] - (stop - n), n) + np.arange(stop[-1])]
        borders = np.cumsum([len(t) + 1 for t in texts])
        ids = np.concatenate(([0], stop))[np.searchsorted(begin, borders)].tolist()
        return [flat[i:j].tobytes() for i, j in zip([0, *ids], ids)]

    def encode_batch(self, texts: list[bytes]) -> list[bytes]:
        # lower-casing A-Z early changes no id, unless a special token's own spelling would arise
        out, waiting, held = [], [], 0
        for t in texts:
            if waiting and held + len(t) > CALL_BYTES:
                out += self._encode(waiting)
                waiting, held = [], 0
            waiting.append(t if b"<|" in t else t.lower())
            held += len(t)
        return out + self._encode(waiting) if waiting else out


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(vocabulary: str = VOCABULARY) -> WordTokenizer:
    if vocabulary not in _tokenizers:
        _tokenizers[vocabulary] = WordTokenizer(tokenizer_path(vocabulary))
    return _tokenizers[vocabulary]


class Packer:
    """Packs pieces, given one by one, into sequences under ``limits``."""

    def __init__(self, limits: Limits, first_id: int = 0, pool: int = POOL):
        self.limits, self.next_id, self.pool_size = limits, first_id, pool
        self.pool: list[Piece] = []
        self.out: list[tuple[Piece, int, int]] = []

    def _emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            self.out.append((p, self.next_id, offset))
            offset += p.length
        self.next_id += 1

    def _close(self, pieces: list[Piece]) -> None:
        """Emit a sequence; one that isn't full is cut at powers of two."""
        total = sum(p.length for p in pieces)
        if total == self.limits.tokens:
            return self._emit(pieces)
        rest = pieces[::-1]
        while total:
            room, run = 1 << (total.bit_length() - 1), []
            total -= room
            while room:
                p = rest.pop()
                if p.length > room:
                    p, tail = p.cut(room)
                    rest.append(tail)
                room -= p.length
                run.append(p)
            self._emit(run)

    def add(self, piece: Piece) -> None:
        while (n := piece.most(self.limits.tokens, self.limits.loss)) < piece.length or n == self.limits.tokens:
            head, piece = piece.cut(n)
            if n == self.limits.tokens:
                self._emit([head])
            else:
                self.pool.append(head)
            if not piece.length:
                return
        self.pool.append(piece)
        if len(self.pool) >= self.pool_size:
            self._pack(self.pool_size // 2)

    def finish(self) -> None:
        self._pack(0)

    def _pack(self, leave: int) -> None:
        """Fill sequences until no more than ``leave`` pieces wait."""
        limit = self.limits.vector()
        pool = self.pool
        demand = np.array([[p.length, 1, p.loss()] for p in pool], dtype=np.float64).reshape(-1, 3)
        waiting = np.ones(len(pool), dtype=bool)
        left = len(pool)
        while left > leave:
            room, bin_ = limit.copy(), []
            while room[0] > 0 and room[1] > 0 and left:
                fits = waiting & (demand <= room).all(axis=1)
                if fits.any():
                    value = np.where(fits, demand @ (room / limit ** 2), -1.0)
                    i = int(value.argmax())
                    bin_.append(pool[i])
                    room -= demand[i]
                    waiting[i] = False
                    left -= 1
                    continue
                i = int(np.where(waiting, demand[:, 0], -1.0).argmax())     # the longest is cut
                n = pool[i].most(int(room[0]), int(room[2]))
                if not n:
                    break
                head, pool[i] = pool[i].cut(n)
                bin_.append(head)
                room -= [n, 1, head.loss()]
                demand[i] = [pool[i].length, 1, pool[i].loss()]
            self._close(bin_)
        self.pool = [p for p, w in zip(pool, waiting) if w]


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
         limits: Limits = Limits(), vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, loss_tokens, doc_tokens, sequence_id, offset.

    An example is the ids of its prompt (if ``prompt_col`` is given; they bear
    no loss), of its text, and ``end_id``.  Null text or prompt counts as
    empty, so every row gives one id at least.  A repeated row is an example
    of its own; ids may be null.  An empty table gives no sequences.  Other
    columns, whatever their names, are not read.
    """
    prompt = F.col(prompt_col) if prompt_col else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(vocabulary)
        end = int(end_id).to_bytes(4, "little")
        packer = Packer(limits, TaskContext.get().partitionId() << 33)

        def rows() -> pa.RecordBatch:
            out, packer.out = packer.out, []
            cols = [[p.doc_id for p, _, _ in out], [p.start for p, _, _ in out],
                    [p.length for p, _, _ in out], [bytes(p.ids) for p, _, _ in out],
                    [p.loss() for p, _, _ in out], [p.total for p, _, _ in out],
                    [s for _, s, _ in out], [o for _, _, o in out]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(cols)],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

        for b in batches:
            texts = tokenizer.encode_batch(text_bytes(b.column(1)))
            prompts = tokenizer.encode_batch(text_bytes(b.column(2))) if prompt_col else [b""] * len(texts)
            for doc_id, head, text in zip(b.column(0).to_pylist(), prompts, texts):
                ids = head + text + end
                packer.add(Piece(doc_id, memoryview(ids), 0, len(ids) // 4, len(head) // 4, len(ids) // 4))
            if packer.out:
                yield rows()
        packer.finish()
        if packer.out:
            yield rows()

    return df.select(F.col(id_col).cast("bigint"), F.col(text_col), prompt.alias("_prompt")).mapInArrow(run, SCHEMA)


def digests(packed: DataFrame) -> DataFrame:
    """The packed pieces with the CRC-32 of their ids in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "loss_tokens")
