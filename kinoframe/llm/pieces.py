"""Pieces of Latin-1 texts in flat NumPy arrays, and ids remembered by a piece's hash.

A tokenizer first cuts text into runs of letters, digits, white space and other signs,
and treats equal pieces alike; so here all pieces of many texts are cut at once and
each distinct one is looked up or encoded once. Other texts go another way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .textblocks import BYTE_VALUE, U, span_hashes

#: Classes of the Latin-1 characters by Unicode's general category and white space.
LETTER, DIGIT, SPACE, OTHER = range(4)
CLASS = np.full(256, OTHER, np.int8)
CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]] = LETTER
CLASS[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = DIGIT
CLASS[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE
#: What may follow an apostrophe as a contraction.
ONE_LETTER, TWO_LETTERS = np.frombuffer(b"stmd", np.uint8), (b"re", b"ve", b"ll")


def text_groups(texts: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[slice, list[str | None]]]:
    """(slice, its texts) over the column, each of about ``limit`` bytes or one longer text."""
    lo = 0
    sizes = list(accumulate(n or 0 for n in pc.binary_length(texts).to_pylist()))
    for i in range(len(texts)):
        if i + 1 == len(texts) or sizes[i + 1] - (sizes[lo - 1] if lo else 0) > limit:
            yield slice(lo, i + 1), texts.slice(lo, i + 1 - lo).to_pylist()
            lo = i + 1


def latin(text: str | None) -> bytes | None:
    """The text in Latin-1, None if it has other characters."""
    try:
        return (text or "").encode("latin-1")
    except UnicodeEncodeError:
        return None


def cut(texts: list[bytes], joined_space: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first piece of each text) of the pieces.

    With ``joined_space`` a space stands with the run after it, white space is kept, and
    a run of digits is one piece; otherwise white space is dropped and each digit is one.
    A lone apostrophe and the contraction's letters after it are a piece.
    """
    raw = np.frombuffer(b"".join(texts), np.uint8)
    at = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
    n = len(raw)
    if not n:
        return raw, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    kind = CLASS[raw]
    opens = np.ones(n, bool)
    opens[1:] = kind[1:] != kind[:-1]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    opens |= edge[:n]
    if not joined_space:
        opens |= kind == DIGIT
    run = np.flatnonzero(opens)

    mark = np.flatnonzero((raw == 0x27) & opens)
    mark = mark[mark + 1 < n]
    mark = mark[(kind[mark + 1] == LETTER) & ~edge[mark + 1]]
    if joined_space:
        mark = mark[edge[mark] | (raw[mark - 1] != 0x20)]
    one = np.isin(raw[mark + 1], ONE_LETTER)
    length = one.astype(np.int64)
    rest = np.flatnonzero(~one & (mark + 2 < n))
    rest = rest[~edge[mark[rest] + 2]]
    pair = raw[mark[rest] + 1].astype(np.int64) << 8 | raw[mark[rest] + 2]
    length[rest[np.isin(pair, [p[0] << 8 | p[1] for p in TWO_LETTERS])]] = 2
    mark, length = mark[length > 0], length[length > 0]

    if joined_space:
        space = run[kind[run] == SPACE]
        ends = np.r_[run[1:], n][np.searchsorted(run, space)]
        inner = ~edge[ends]
        last = ends[inner] - 1
        opens[last] = True
        opens[ends[inner][raw[last] == 0x20]] = False
    opens[mark + 1] = False
    after = mark + 1 + length
    after = after[after < n]
    opens[after] = True
    starts = np.flatnonzero(opens)
    ends = np.r_[starts[1:], n]
    if not joined_space:
        keep = kind[starts] != SPACE
        starts, ends = starts[keep], ends[keep]
    return raw, starts, ends, np.searchsorted(starts, at)


class IdMemory:
    """Ids of pieces by hash; forgets all of them beyond ``most`` pieces."""

    def __init__(self, most: int = 1_000_000):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.entry = np.zeros(0, U), np.zeros(0, np.int64)
        self.offset, self.length, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def entries(self, keys: np.ndarray, encode: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        """Entry of each distinct key; ``encode`` gives the ids of those at the given places, which are new."""
        if len(self.keys) > self.most:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        out = np.empty(len(keys), np.int64)
        out[known] = self.entry[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            ids = encode(new)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            numbers = np.arange(len(self.offset), len(self.offset) + len(new))
            out[new] = numbers
            self.offset = np.r_[self.offset, len(self.pool) + np.cumsum(sizes) - sizes]
            self.length = np.r_[self.length, sizes]
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), "<u4")])
            self.keys, self.entry = np.insert(self.keys, at[new], keys[new]), np.insert(self.entry, at[new], numbers)
        return out


def gather(pool: np.ndarray, offset: np.ndarray, length: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends): the pool's stretch of each entry, one after the other."""
    sizes = length[entry]
    ends = np.cumsum(sizes)
    shift = np.repeat(offset[entry] - (ends - sizes), sizes)
    shift += np.arange(len(shift))
    return pool[shift], ends


def encode_latin(texts: list[bytes], joined_space: bool, memory: IdMemory, encode: Callable[[list[str]], list[bytes]]) -> list[np.ndarray]:
    """Ids of each text, by way of its distinct pieces; ``encode`` gives those of new pieces."""
    raw, starts, ends, first = cut(texts, joined_space)
    if not len(starts):
        return [np.zeros(0, np.uint32)] * len(texts)
    keys, at, back = np.unique(span_hashes(BYTE_VALUE[raw], starts, ends), return_index=True, return_inverse=True)
    flat = raw.tobytes()
    lo, hi = starts[at], ends[at]
    entry = memory.entries(keys, lambda new: encode([flat[a:b].decode("latin-1") for a, b in zip(lo[new].tolist(), hi[new].tolist(), strict=True)]))
    values, upto = gather(memory.pool, memory.offset, memory.length, entry[back])
    return np.split(values, np.r_[0, upto][first[1:-1]])
