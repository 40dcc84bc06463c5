"""SentencePiece encoding by a prefix table over merge pieces.

A merge (BPE) encoding has a useful property: every prefix of a text has one
encoding, and that encoding's last piece is unique.  So the encoding of a
text is a table: for each position, the last piece of the prefix that ends
there.  An Aho-Corasick automaton lists the pieces that end at a position;
a piece fits when the piece before it (the table entry at its start) and
the piece itself stay apart when merged together.  Reading the table
backwards from the end gives the pieces.

No piece of the vocabulary holds a space mark after an ordinary character,
so no merge crosses the start of a word: words are encoded apart and
repeated words come from a bounded cache.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CACHE_WORDS = 400_000


class PrefixEncoder:
    """Encoder over one merge vocabulary with byte fallback."""

    def __init__(self, model_file: str):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.words = self._splitter()
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(p) == 1 or self._merge(p) == [p]:
                self.automaton.add_word(p, i << 6 | len(p))   # id and length in one integer
        self.automaton.make_automaton()
        self.piece = {i: p for p, i in self.ids.items()}
        self.raw = [b""] * sp.get_piece_size()      # control ids have no text
        self.raw[sp.unk_id()] = sp.decode([sp.unk_id()]).encode()
        for p, i in self.ids.items():
            self.raw[i] = p.encode()
        for byte, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([byte])
        self.pairs: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _splitter(self) -> re.Pattern:
        """A pattern that cuts a marked text only where no piece can span the cut:
        before a character that follows no ordinary one in any piece (the space
        mark and most punctuation), and around characters found in no longer piece."""
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        openers = {c for c in joined if not c.isalnum()}
        follows = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        while late := {b for a, b in follows if b in openers and a not in openers}:
            openers -= late
        group = "".join(map(re.escape, sorted(openers)))
        alone = "".join(map(re.escape, sorted(c for c in map(chr, range(32)) if c not in joined)))
        return re.compile(f"[{alone}]|[{group}]+[^{group}{alone}]*|[^{group}{alone}]+")

    def _merge(self, text: str) -> list[str]:
        """Merge order by definition, for short strings: best score first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.score.get(parts[i] + parts[i + 1], float("-inf")), -i)
                        for i in range(len(parts) - 1)))
            if best[0] == float("-inf"):
                break
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _apart(self, left: int, right: int) -> bool:
        """Whether two pieces are still two when their text is merged as one."""
        pieces = [self.piece[left >> 6], self.piece[right >> 6]]
        known = self._merge("".join(pieces)) == pieces
        if len(self.pairs) >= CACHE_WORDS:
            self.pairs.clear()
        self.pairs[left << 24 | right] = known
        return known

    def _word_ids(self, word: str) -> bytes:
        n = len(word)
        last = [-1] * (n + 1)           # last piece of each prefix; -1: a character outside the vocabulary
        fits = self.pairs.get
        for end, piece in self.automaton.iter(word):   # by end; longest first
            end += 1
            if last[end] < 0:
                before = last[end - (piece & 63)]
                if before < 0 or (fits(before << 24 | piece) or
                                  fits(before << 24 | piece) is None and self._apart(before, piece)):
                    last[end] = piece
        out = []
        while n:
            piece = last[n]
            if piece >= 0:
                out.append(piece >> 6)
                n -= piece & 63
            else:
                n -= 1
                out.extend([self.byte_ids[b] for b in word[n].encode()][::-1])
        out.reverse()
        return array("I", out).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers, begin and end ids included."""
        out = [self.sp.bos_id().to_bytes(4, "little")]
        if text:
            cache, marked = self.cache, MARK + text.replace(" ", MARK)
            for word in self.words.findall(marked):
                ids = cache.get(word)
                if ids is None:
                    ids = self.older.get(word) or self._word_ids(word)
                    if len(cache) >= CACHE_WORDS:   # words not seen for two rounds go
                        self.older, self.cache = cache, {}
                        cache = self.cache
                    if len(word) <= 64:
                        cache[word] = ids
                out.append(ids)
        out.append(self.sp.eos_id().to_bytes(4, "little"))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of an id sequence: the bytes of its pieces, joined; the model's own
        first space goes.  Ids that don't make valid UTF-8 are left to the library."""
        numbers = array("I", ids).tolist()
        raw = b"".join(map(self.raw.__getitem__, numbers))
        try:
            text = raw.decode().replace(MARK, " ")
        except UnicodeDecodeError:
            return self.sp.decode(numbers)
        return text[1:] if raw.startswith(MARK.encode()) else text


_encoders: dict[str, PrefixEncoder] = {}


def encoder(model: str = MODEL) -> PrefixEncoder:
    """The worker's encoder of a vocabulary file, built once."""
    if model not in _encoders:
        _encoders[model] = PrefixEncoder(tokenizer_path(model))
        gc.freeze()     # the tables live as long as the worker
    return _encoders[model]


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     model: str = MODEL) -> DataFrame:
    """(doc_id, ids binary, decoded string) of every row of ``df``; a map over the scan.

    A null text counts as empty (begin and end ids alone).  Ids may be null
    or repeat: each row gives one row.  An empty table gives an empty one.
    Only the two named columns are read, so other columns may have any name.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for b in batches:
            ids = [enc.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([enc.decode(i) for i in ids], pa.string())],
                names=["doc_id", "ids", "decoded"])

    return df.select(id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 digests of encoded documents."""
    return encoded.selectExpr("doc_id", "cast(length(ids) / 4 as bigint) AS n_tokens",
                              "sha2(ids, 256) AS ids_sha256",
                              "sha2(cast(decoded as binary), 256) AS decoded_sha256")
