"""Hashes of the words of texts, without an object for each word.

A word is a run of ASCII letters, digits and underscores and of characters beyond ASCII, except
the signs of Latin-1 and general punctuation; case is lowered. A word's hash is a polynomial of
its bytes modulo 2**64, read off running sums of the whole block, and then mixed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

SEGMENT = 1 << 17
ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D
INVERSE = pow(BASE, -1, 1 << 64)
WORD_BYTE = np.array([b >= 128 or bool(re.match(r"\w", chr(b))) for b in range(256)])
LATIN_LETTERS = np.isin(np.arange(256), [0xAA, 0xB5, 0xBA])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to words."""
    inside = WORD_BYTE[data]
    signs = np.flatnonzero(data[:-1] == 0xC2)
    signs = signs[~LATIN_LETTERS[data[signs + 1]]]
    inside[signs] = inside[signs + 1] = False
    marks = np.flatnonzero(data[:-2] == 0xE2)
    marks = marks[(data[marks + 1] == 0x80) | (data[marks + 1] == 0x81)]
    inside[marks] = inside[marks + 1] = inside[marks + 2] = False
    return inside


class WordHasher:
    def __init__(self):
        self._grow(SEGMENT + 1)

    def _grow(self, size: int) -> None:
        self.up, self.down = _powers(BASE, size), _powers(INVERSE, size)

    def words(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, text by text, and the number of words of each text."""
        parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        inside = _word_bytes(data)
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        starts, ends = edges[::2], edges[1::2]
        hashes = np.empty(len(starts), dtype=np.uint64)
        word = 0
        while word < len(starts):
            begin = starts[word]
            last = max(word + 1, int(np.searchsorted(ends, begin + SEGMENT, "right")))
            size = int(ends[last - 1] - begin)
            if size >= len(self.up):
                self._grow(size + 1)
            sums = np.zeros(size + 1, dtype=np.uint64)
            digits = data[begin : begin + size].astype(np.uint64) + np.uint64(1)
            np.cumsum(digits * self.up[:size], out=sums[1:])
            a, b = starts[word:last] - begin, ends[word:last] - begin
            hashes[word:last] = (sums[b] - sums[a]) * self.down[a]
            word = last
        lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        bounds = np.searchsorted(starts, np.cumsum(lengths + 1))
        counts = np.diff(np.concatenate([[0], bounds]))
        return mixed(hashes + (ends - starts).astype(np.uint64) * ODD), counts
