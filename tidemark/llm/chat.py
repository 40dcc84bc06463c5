"""Chat formatting at the level of tokens.

Roles and texts are encoded apart and reserved ids, beyond the vocabulary,
are spliced in between, so no text can spell a marker.  Control strings
inside texts are also escaped, reversibly, for readers that look at the
formatted string.  The loss mask comes from prefix sums over the segment
lengths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
# Reserved ids (the vocabulary ends at 50256) and their spelling.
TURN, BODY, END = 50257, 50258, 50259
SPELLING = {TURN: "<|turn|>", BODY: "<|body|>", END: "<|end|>"}
LOSS_ROLES = ("assistant",)
# A control string is an opening sign, then (escaped ones: backslashes, then) a fixed rest.
_OPEN = re.compile(r"<(\\*)(\|\w+\|>|/?s>)|\[(\\*)(/?INST\])")


def escape(text: str) -> str:
    """``text`` with one backslash more after the first sign of each control string."""
    return _OPEN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of :func:`escape`."""
    return _OPEN.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


_tokenizers: dict = {}


def _tokenizer(vocabulary: str = VOCABULARY):
    if vocabulary not in _tokenizers:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(tokenizer_path(vocabulary))
        t.encode_special_tokens = True      # their strings in a text are ordinary text
        _tokenizers[vocabulary] = t
    return _tokenizers[vocabulary]


def assemble(roles: list[str], texts: list[str], vocabulary: str = VOCABULARY) -> tuple[list[bytes], list[bytes]]:
    """Ids (little-endian unsigned 32-bit) and loss mask (a byte an id) of each turn:
    TURN role BODY text END, the text of a loss-bearing role under the mask."""
    t = _tokenizer(vocabulary)
    n = len(roles)
    names = list(dict.fromkeys(roles))      # few in a batch: each is encoded once
    parts = t.encode_batch_fast([escape(x) for x in [*names, *texts]], add_special_tokens=False)
    of_role = {r: e.ids for r, e in zip(names, parts)}
    role_ids, text_ids = [of_role[r] for r in roles], [e.ids for e in parts[len(names):]]
    sizes = np.ones((n, 5), np.int64)
    sizes[:, 1] = [len(x) for x in role_ids]
    sizes[:, 3] = [len(x) for x in text_ids]
    at = np.concatenate(([0], np.cumsum(sizes.ravel())))       # where each segment begins
    begins, total = at[:-1].reshape(n, 5), int(at[-1])
    flat = np.empty(total, "<u4")
    for k, marker in ((0, TURN), (2, BODY), (4, END)):
        flat[begins[:, k]] = marker
    step = np.zeros(total + 1, np.int8)
    bears = np.array([r in LOSS_ROLES for r in roles], bool)
    np.add.at(step, begins[bears, 3], 1)
    np.add.at(step, begins[bears, 4], -1)
    mask = np.cumsum(step[:-1], dtype=np.int8)
    for i in range(n):
        flat[begins[i, 1]:begins[i, 2]] = role_ids[i]
        flat[begins[i, 3]:begins[i, 4]] = text_ids[i]
    ids, out, flags = flat.tobytes(), [], mask.tobytes()
    bounds = [*begins[:, 0].tolist(), total]
    for i, j in zip(bounds, bounds[1:]):
        out.append((ids[4 * i:4 * j], flags[i:j]))
    return [x for x, _ in out], [m for _, m in out]


def format_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(conv_id, turn, ids, loss_mask) per row of ``df``: its formatted ids and their
    mask; a conversation is its turns' ids one after the other.  A map over the scan.

    Null texts and roles count as empty; a repeated row is a turn of its own;
    rows without a conversation id are one conversation.  Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, masks = assemble([r or "" for r in b.column(2).to_pylist()],
                                  [t or "" for t in b.column(3).to_pylist()], vocabulary)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ids, pa.binary()), pa.array(masks, pa.binary())],
                names=["conv_id", "turn", "ids", "loss_mask"])

    return df.select(F.col(conv_col).cast("bigint"), F.col(turn_col).cast("bigint"), role_col, text_col).mapInArrow(
        run, "conv_id bigint, turn bigint, ids binary, loss_mask binary")


def parse(ids: list[bytes], masks: list[bytes], vocabulary: str = VOCABULARY) -> list[tuple[str, str, str, str]]:
    """(role, text, text under the mask, formatted string) of formatted turns."""
    t = _tokenizer(vocabulary)
    names, spans, whole = {}, [], []
    for raw, mask in zip(ids, masks):
        a, m = np.frombuffer(raw, "<u4"), np.frombuffer(mask, np.int8) == 1
        body = int(np.flatnonzero(a == BODY)[0])
        role, under = raw[4:4 * body], a[m]
        names.setdefault(role, len(names))
        # the whole body under the mask, and nothing else, isn't decoded again
        all_of_it = len(under) == len(a) - body - 2 and bool(m[body + 1:-1].all())
        whole.append((role, all_of_it))
        spans += [a[body + 1:-1].tolist(), [] if all_of_it else under.tolist()]
    said = t.decode_batch([np.frombuffer(r, "<u4").tolist() for r in names] + spans, skip_special_tokens=False)
    roles, out = said[:len(names)], []
    for (name, all_of_it), text, loss in zip(whole, said[len(names)::2], said[len(names) + 1::2]):
        role, plain = roles[names[name]], unescape(text)
        out.append((unescape(role), plain, plain if all_of_it else unescape(loss),
                    SPELLING[TURN] + role + SPELLING[BODY] + text + SPELLING[END]))
    return out


def read_turns(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(conv_id, turn, role, text, loss, formatted_chars) decoded from formatted turns, a row
    each: a map, so the turns of one conversation are decoded wherever they lie.  ``loss`` is the
    text under the mask, null where that is the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = parse(b.column(2).to_pylist(), b.column(3).to_pylist(), vocabulary)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([s[0] for s in said], pa.string()),
                 pa.array([s[1] for s in said], pa.string()),
                 pa.array([None if s[2] == s[1] else s[2] for s in said], pa.string()),
                 pa.array([len(s[3]) for s in said], pa.int64())],
                names=["conv_id", "turn", "role", "text", "loss", "formatted_chars"])

    return turns.select("conv_id", "turn", "ids", "loss_mask").mapInArrow(
        run, "conv_id bigint, turn bigint, role string, text string, loss string, formatted_chars bigint")


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.n, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, loss: str | None, formatted_chars: int) -> None:
        loss = text if loss is None else loss
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.loss_chars += len(loss)
        self.chars += formatted_chars

    def row(self) -> tuple:
        return (self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")


def read_back(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Digests of each conversation, decoded from the formatted ids, in the order of
    turns (ties: of role, then text).  Turns are decoded before the shuffle; a task then streams
    over its sorted rows, only hashing, and holds one turn batch, however long a conversation is."""
    names = [c.split()[0] for c in _DIGEST.split(", ")]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for b in batches:
            done = []
            convs, *turn_columns = (b.column(i).to_pylist() for i in (0, 2, 3, 4, 5))
            for conv, *turn in zip(convs, *turn_columns):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(*turn)
            yield rows(done)
        if now is not None:
            yield rows([now.row()])

    return (read_turns(turns, vocabulary).repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _DIGEST))
