"""Flat NumPy tables of the words and lines of an Arrow column of texts.

A word is a maximal run of bytes other than space and 0x09-0x0D; a text that is
null has no words. Hashes are 64 bits: polynomials over words or bytes, finished
by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_STEP = U(0x9E3779B97F4A7C15)
_RADIX = U(0xD1342543DE82EF95)
_GRAM = U(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * _STEP)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix, and of its inverse, modulo 2**64."""
    inverse = U(pow(int(_RADIX), -1, 1 << 64))
    out = []
    for base in (_RADIX, inverse):
        x = np.full(size, base, U)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(18, int(n).bit_length()))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for each span, the same wherever the span lies."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U) * _STEP)


class Block:
    """Consecutive texts of one Arrow column, cut into words."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = raw[at[0] : at[-1]]
        self.at = at - at[0]
        n = len(self.bytes)
        inside = ~SPACES[self.bytes]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[self.at[:-1][self.at[:-1] < n]] = False
        after[self.at[1:][self.at[1:] > 0] - 1] = False
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: Word range of each text, and the text of each word.
        self.first = np.searchsorted(self.starts, self.at)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def words(self) -> np.ndarray:
        return span_hashes(BYTE_VALUE[self.bytes], self.starts, self.ends)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value of each byte over each text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]

    def grams(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the n-word windows that lie in one text, and their hashes."""
        size = len(words) - n + 1
        if size <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        got = words[:size].copy()
        for j in range(1, n):
            got *= _GRAM
            got += words[j : j + size]
        starts = np.flatnonzero(self.text_of[:size] == self.text_of[n - 1 :])
        return starts, mix(got[starts])


def blocks(texts: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, Block]]:
    """(from, to, block) over the column, each of about ``limit`` bytes or one longer text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            yield lo, i, Block(texts.slice(lo, i - lo))
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes), Block(texts.slice(lo))


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    by = keys[order]
    same = np.zeros(len(keys), bool)
    same[1:] = by[1:] == by[:-1]
    any_, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order] = same
    twice = same.copy()
    twice[:-1] |= same[1:]
    any_[order] = twice
    return any_, earlier
