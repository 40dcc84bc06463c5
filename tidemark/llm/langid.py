"""Language identification by cross-parsing: a text is cut into phrases, each
the longest match in a language's sample text; the language that needs the
fewest phrases wins, counted times the logarithm of its sample's size, since
a smaller sample has shorter matches.

The longest matches come from a suffix automaton of each language's sample.
Many texts are parsed at once: blocks of letters step through an automaton
side by side, one numpy look-up per letter, a restart being counted where
no longer match exists.

Letters are coded as the bytes of their lower-case UTF-8 form, so all scripts
are told apart.  Automata are kept as lists of edges, in groups of languages;
their step tables are made where they are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import id_crc

# Documented bounds of the training sample.
SAMPLE_DOCS = 60            # about so many documents of each language, more if they are short
SAMPLE_SYMBOLS = 24_000     # symbols of each language's automaton; fewer only if all its texts hold fewer
SAMPLE_PART = 2 * SAMPLE_SYMBOLS // SAMPLE_DOCS     # characters read of a document where there are enough of them
ALPHABET = 254              # symbols of letters: bytes
GROUP = 64                  # languages whose automata are held at once
TABLE_BYTES = 64 << 20      # step tables kept from text to text; those of more languages are made anew
BLOCK = 256                 # letters parsed as one run; a longer text has several
LEAST_SIZE = 30             # smaller samples are weighted as this size
UNKNOWN = "und"
GAP = 0                     # symbol of what is no letter
#: Fewest letters a phrase must have on average for a text to count as a known language;
#: a letter of three bytes or more counts as half its bytes, since large alphabets have short phrases.
MIN_PHRASE = 1.6
MIN_LETTERS = 20            # texts of fewer letters aren't held to it: chance decides there


def _edges(symbols: np.ndarray) -> list[dict[int, int]]:
    """States of the suffix automaton of a symbol string: next state by symbol."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def _table(states: int, width: int, sources: np.ndarray, symbols: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Step table of an automaton given by its edges.

    Entry ``state * width + symbol`` holds the next state's row times two,
    plus one when the match had to end and a new phrase began.
    """
    # a symbol that the sample lacks is a phrase of its own: after it, in the last state, all is new
    start = np.full(width, states, dtype=np.int32)
    first = sources == 0
    start[symbols[first]] = targets[first]
    table = np.empty((states + 1, width), dtype=np.int32)
    table[:] = start * width * 2 + 1            # no longer match: a new phrase starts with this symbol
    table[0] -= 1                               # the first phrase is counted from the start
    table[sources, symbols] = targets * np.int32(width * 2)
    return table.ravel()


def _edge_arrays(nxt: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges of each state, their symbols, their targets)."""
    return (np.array([len(row) for row in nxt], dtype=np.uint8),
            np.array([c for row in nxt for c in row], dtype=np.uint8),
            np.array([t for row in nxt for t in row.values()], dtype=np.int32))


def _automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """Step table over ``width`` symbols of the suffix automaton of a symbol string."""
    degree, c, t = _edge_arrays(_edges(symbols))
    return _table(len(degree), width, np.repeat(np.arange(len(degree)), degree), c, t)


class Automaton:
    """Suffix automaton of a language's sample, as edges; its step table has a column
    for each symbol of the sample and one for all others, which no match goes over."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        self.degree, self.symbols, self.targets = _edge_arrays(_edges(symbols))
        own = np.unique(np.append(symbols, GAP))
        self.width = len(own) + 1
        self.column = np.full(ALPHABET + 2, len(own), dtype=np.int32)
        self.column[own] = np.arange(len(own))

    def table_bytes(self) -> int:
        return (len(self.degree) + 1) * self.width * 4

    def table(self) -> np.ndarray:
        return _table(len(self.degree), self.width, np.repeat(np.arange(len(self.degree)), self.degree),
                      self.column[self.symbols], self.targets)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    symbol_of: np.ndarray       # code point -> symbols, one in each byte from the lowest on
    tables: tuple[Automaton | np.ndarray, ...]      # automata, or step tables over all symbols

    def weights(self) -> np.ndarray:
        """What a phrase counts for in each language: 1 if its sample is whole."""
        sizes = np.array([a.size if isinstance(a, Automaton) else SAMPLE_SYMBOLS for a in self.tables], dtype=np.float64)
        return np.log(np.maximum(sizes, LEAST_SIZE)) / np.log(float(SAMPLE_SYMBOLS))


@cache
def _letters() -> np.ndarray:
    """Symbols of each code point: the UTF-8 bytes of the lower-case letter, GAP for what is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = int.from_bytes(chr(c).lower()[0].encode(), "little")
    return out


def _symbols(text: str, symbol_of: np.ndarray) -> np.ndarray:
    """Symbols of a text, runs of gaps as one."""
    if text.isascii():
        s = symbol_of[:128].astype(np.uint8)[np.frombuffer(text.encode(), dtype=np.uint8)]
        return s[(s != GAP) | (np.concatenate(([GAP], s[:-1])) != GAP)]
    code = symbol_of[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)].astype("<u4")
    code = code[(code != GAP) | (np.concatenate(([GAP], code[:-1])) != GAP)]
    s = code.view(np.uint8).reshape(-1, 4)
    used = s != 0
    used[:, 0] = True           # a gap is one symbol too
    return s[used]


def _even(runs: list[np.ndarray], size: int) -> np.ndarray:
    """The first symbols of every run, as many of each as make ``size`` together;
    a run that has fewer gives all, and the others more."""
    lengths = np.array([len(r) for r in runs], dtype=np.int64)
    low, high = 0, size             # the most of each that stays within size
    while low < high:
        middle = (low + high + 1) // 2
        if np.minimum(lengths, middle).sum() <= size:
            low = middle
        else:
            high = middle - 1
    take = np.minimum(lengths, low)
    take[np.flatnonzero(lengths > low)[:size - take.sum()]] += 1
    return np.concatenate([r[:n] for r, n in zip(runs, take.tolist())])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Automata of a bounded sample of every language, from rows with text, language and id
    whose id's crc32 mod 4 is not 2.

    Documents of any length are drawn by a hash of their id, so many that
    ``SAMPLE_PART`` characters of each make twice ``SAMPLE_SYMBOLS``, and all have
    the same share in the sample as far as they reach.  A language with less
    text than that gives all its documents, up to ``SAMPLE_SYMBOLS`` of each.
    """
    known = (docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"),
                         F.trim(F.regexp_replace(text_col, r"[^\p{L}]+", " ")).alias("_text"))
             .where((id_crc("_id") % 4 != 2) & F.col("_lang").isNotNull() & (F.col("_text") != "")))
    sizes = (known.groupBy("_lang").agg(F.sum(F.least(F.length("_text") + 1, F.lit(SAMPLE_PART))).alias("_size"))
             .select(F.col("_lang").alias("_g"), "_size"))
    want = 2 * SAMPLE_SYMBOLS
    h = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = (known.join(F.broadcast(sizes), F.col("_lang") == F.col("_g")).where(h * F.col("_size") < want)
            .select("_lang", "_id", F.substring("_text", F.lit(1), F.when(F.col("_size") > want, SAMPLE_PART)
                                                .otherwise(SAMPLE_SYMBOLS)).alias("_text"))
            .collect())
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["_lang"], r["_id"], r["_text"])):
        texts.setdefault(r["_lang"], []).append(r["_text"])
    symbol_of = _letters()
    languages, tables = [], []
    for name, ts in sorted(texts.items()):
        sample = _even([_symbols(t + " ", symbol_of) for t in ts], SAMPLE_SYMBOLS)
        if (sample != GAP).any():
            languages.append(name)
            tables.append(Automaton(sample))
    return LanguageModel(tuple(languages), symbol_of, tuple(tables))


class Blocks:
    """Texts cut into blocks of symbols that are parsed side by side."""

    def __init__(self, texts: list[str], symbol_of: np.ndarray):
        runs = [_symbols(t, symbol_of) for t in texts]
        sizes = np.array([len(r) for r in runs], dtype=np.int64)
        n = np.array([int((r != GAP).sum()) for r in runs], dtype=np.int64)
        self.letters = np.maximum(n - np.array([int((r & 0xC0 == 0x80).sum()) for r in runs], dtype=np.int64), n / 2)
        self.texts = len(texts)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        # every block is a row; the unused end of a text's last block is not counted
        grid = np.zeros((len(owner), BLOCK), dtype=np.uint8)
        first = np.concatenate(([0], np.cumsum(blocks)[:-1])) if len(texts) else blocks
        flat = grid.reshape(-1)
        for i, r in enumerate(runs):
            flat[first[i] * BLOCK:first[i] * BLOCK + len(r)] = r
        used = np.full(len(owner), BLOCK, dtype=np.int64)
        ends = (first + blocks - 1)[blocks > 0]
        used[ends] = (sizes - (blocks - 1) * BLOCK)[blocks > 0]
        order = np.argsort(-used, kind="stable")        # so that the blocks still running are a prefix
        self.owner = owner[order]
        self.columns = np.ascontiguousarray(grid[order].T)
        self.running = np.searchsorted(-used[order], -np.arange(1, BLOCK + 1), side="right")

    def phrases(self, table: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Phrases of each text by a step table with the symbols' columns."""
        state = np.zeros(len(self.owner), dtype=np.int32)
        seen = np.ones(len(self.owner), dtype=np.int32)      # the first phrase
        for c in range(BLOCK):
            n = self.running[c]
            if not n:
                break
            step = table.take(state[:n] + column.take(self.columns[c, :n]))
            seen[:n] += step & 1
            state[:n] = step >> 1
        return np.bincount(self.owner, seen, self.texts).astype(np.int64)


_ALL = np.arange(ALPHABET + 2, dtype=np.int32)


class Parser:
    """Phrase counts by groups of languages, each group fetched when it is needed."""

    def __init__(self, symbol_of: np.ndarray, groups: list):
        self.symbol_of, self.groups = symbol_of, groups
        self.kept: dict[tuple[int, int], np.ndarray] = {}
        self.room = TABLE_BYTES

    def _table(self, key: tuple[int, int], automaton: Automaton) -> np.ndarray:
        table = self.kept.get(key)
        if table is None:
            table = automaton.table()
            if automaton.table_bytes() <= self.room:
                self.room -= automaton.table_bytes()
                self.kept[key] = table
        return table

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        blocks, counts = Blocks(texts, self.symbol_of), []
        for g, group in enumerate(self.groups):
            for j, a in enumerate(group()):
                counts.append(blocks.phrases(a, _ALL) if isinstance(a, np.ndarray) else
                              blocks.phrases(self._table((g, j), a), a.column))
        return np.array(counts, dtype=np.int64).reshape(-1, len(texts)).T, blocks.letters


def phrase_counts(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages) phrase counts, and the letters of each text."""
    return Parser(model.symbol_of, [lambda: model.tables]).counts(texts)


class SharedModel:
    """A model as broadcasts: a worker holds the automata of one group of languages at a time."""

    def __init__(self, spark: SparkSession, model: LanguageModel):
        put = spark.sparkContext.broadcast
        self.languages, self.weights, self.symbol_of = model.languages, model.weights(), put(model.symbol_of)
        self.groups = [put(model.tables[i:i + GROUP]) for i in range(0, len(model.tables), GROUP)]

    def parser(self) -> Parser:
        def fetch(b: Broadcast):
            if len(self.groups) == 1 or not getattr(b, "_path", None):
                return lambda: b.value
            return lambda: b.load_from_path(b._path)        # b.value would stay in memory
        return Parser(self.symbol_of.value, [fetch(b) for b in self.groups])


def _predict(texts: list[str | None], shared: SharedModel, parser: Parser
             ) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, mean letters of a phrase, letters) per text.

    The score is the winner's share when each phrase more, weighted by its
    language, counts as one natural unit of evidence less; equal counts go to
    the first name.  Letters of a phrase are those of the longest parse.
    """
    counts, letters = parser.counts([t or "" for t in texts])
    if not shared.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), letters
    weighted = counts * shared.weights
    best = weighted.argmin(axis=1)
    fewest = weighted[np.arange(len(texts)), best]
    share = 1.0 / np.exp(np.clip(fewest[:, None] - weighted, -50, 0)).sum(axis=1)
    some = letters > 0
    names = [shared.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
    return names, np.where(some, share, 0.0), np.where(some, letters / np.maximum(counts.min(axis=1), 1), 0.0), letters


_SLICE = 8 << 20    # characters parsed at once


def _slices(texts: list[str | None]) -> Iterator[list[str | None]]:
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size >= _SLICE:
            yield run
            run, size = [], 0
    if run:
        yield run


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its text alone; a map over the scan.

    A null text or one without letters is ``und`` with score 0.  A null id
    counts as trained on.  Repeated rows give repeated rows.
    """
    shared = SharedModel(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.parser()
        for b in batches:
            names, scores = [], []
            for part in _slices(b.column(2).to_pylist()):
                n, s, _, _ = _predict(part, shared, parser)
                names += n
                scores.append(s)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()),
                 pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(id_crc(id_col) % 4 == 2, F.lit(False)).alias("held_out"),
                       F.col(text_col)).mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: LanguageModel, text_col: str = "text",
               min_phrase: float = MIN_PHRASE) -> DataFrame:
    """The rows of ``docs``, all columns, in one of the learned languages: with letters,
    and with phrases of ``min_phrase`` letters or more on average in one of them.

    A text of fewer than ``MIN_LETTERS`` letters, which tells too little, stays if
    it has any; where no language was learned, so does every text with letters.
    """
    shared = SharedModel(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.parser()
        for b in batches:
            keep = []
            for part in _slices(b.column(at).to_pylist()):
                _, _, phrase, letters = _predict(part, shared, parser)
                short = letters < (MIN_LETTERS if shared.languages else np.inf)
                keep += ((letters > 0) & (short | (phrase >= min_phrase))).tolist()
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
