"""Words of many texts at once, as numpy arrays over one byte buffer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes that separate words (fixed by the contracts): space, \t, \n, \v, \f, \r.
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SEED = np.random.PCG64(20240229).random_raw(258)
_BYTE = np.where(BLANK, 0, _SEED[:256] | 1).astype(np.uint64)
_BASE, _MIX = (int(x) | 1 for x in _SEED[256:])
LIMIT = 2 << 20


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
    return out[:n]


@dataclass
class Words:
    """``row``: index of each word's text; ``start``/``end``: its bytes in ``raw``;
    ``hash``: 64 bits of its (lower-cased) bytes; ``first``: each text's first byte."""

    raw: np.ndarray
    first: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


class Hasher:
    """Polynomial hash modulo 2^64 over random byte values, mixed at the end."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def words(self, texts: list[bytes], lower: bool = True) -> Words:
        sizes = np.array([len(t) for t in texts], dtype=np.int64) + 1
        first = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        low = LOWER[raw] if lower else raw
        edge = np.diff(np.concatenate(([True], BLANK[raw])).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(raw) > len(self.up):
            n = 1 << int(len(raw) - 1).bit_length()
            self.up, self.down = powers(_BASE, n), powers(pow(_BASE, -1, 1 << 64), n)
        if len(start):
            h = np.add.reduceat(_BYTE[low] * self.up[: len(raw)], start) * self.down[start]
            h ^= h >> np.uint64(32)
            h *= np.uint64(_MIX)
            h ^= h >> np.uint64(29)
        else:
            h = np.empty(0, dtype=np.uint64)
        row = np.searchsorted(first, start, side="right") - 1
        return Words(raw, first, row, start, end, h)


@dataclass
class Part:
    """Some texts, or parts of one text in order: ``rows`` are their indices, ``head`` and
    ``tail`` tell whether a part begins and ends its text."""

    rows: np.ndarray
    texts: list[bytes]
    head: np.ndarray
    tail: np.ndarray


def pieces(texts: list[bytes], limit: int = LIMIT) -> Iterator[Part]:
    """The texts in groups of about ``limit`` bytes; a longer text is cut at white space
    and its parts come in order, so work space stays bounded.  (A single word beyond
    ``limit`` stays whole.)"""
    held: list[tuple[int, bytes, bool, bool]] = []
    size = 0

    def out() -> Part:
        rows, parts, head, tail = zip(*held)
        return Part(np.array(rows), list(parts), np.array(head), np.array(tail))

    for r, t in enumerate(texts):
        at = 0
        while True:
            stop = len(t)
            if stop - at > limit:
                stop = at + limit
                while stop < len(t) and not BLANK[t[stop]]:
                    stop += 1
            part = t[at:stop]
            if held and size + len(part) > limit:
                yield out()
                held, size = [], 0
            held.append((r, part, at == 0, stop >= len(t)))
            size += len(part) + 1
            at = stop
            if at >= len(t):
                break
    if held:
        yield out()
