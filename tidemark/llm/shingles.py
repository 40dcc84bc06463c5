"""Word shingle sets of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
SLICE = 4 << 20     # bytes of text hashed at once

_P = np.uint64(0x9E3779B97F4A7C15)
_C = [np.uint64(c) for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                             0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_powers["up"]) < n:
        inverse = pow(int(_P), -1, 1 << 64)
        for name, base in (("up", int(_P)), ("down", inverse)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased, cut at ASCII white space) of all texts in
    order, and the index of each word's text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    lower = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=total[1:])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _C[0])
    return h, np.searchsorted(np.cumsum(sizes), start, side="right")


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    h, owner = word_hashes(texts)
    sets = [np.zeros(0, np.uint64)] * len(texts)
    if not len(h):
        return sets
    if len(h) >= WIDTH:
        n = len(h) - WIDTH + 1
        rolled = mix(sum(h[k:k + n] * _C[k] for k in range(WIDTH)))
        whole = owner[:n] == owner[WIDTH - 1:]
        rolled, of = rolled[whole], owner[:n][whole]
    else:
        rolled, of = h[:0], owner[:0]
    at = np.searchsorted(of, np.arange(len(texts) + 1))
    words = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        if at[i] < at[i + 1]:
            sets[i] = np.unique(rolled[at[i]:at[i + 1]])
        elif words[i] < words[i + 1]:       # fewer words than a shingle: the whole sequence is one
            few = h[words[i]:words[i + 1]]
            s = sum(f * c for f, c in zip(few[:, None], _C)) + np.full(1, len(few), np.uint64) * _P
            sets[i] = mix(s)
    return sets


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted; empty without words."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= SLICE:
            yield from _sets(run)
            run, size = [], 0
    if run:
        yield from _sets(run)
