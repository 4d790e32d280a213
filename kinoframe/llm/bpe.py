"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each pretoken has a tree whose leaf i holds the rank of the pair that starts at symbol
i, or nothing. The root is the smallest (rank, place): the leftmost pair of the lowest
rank. A merge changes three leaves, each put right in as many steps as the tree has
levels, and merging ends when the root is empty. Short pretokens go through the same
steps many at a time, as rows of NumPy arrays; longer ones one by one.

Defined results: a null text encodes as the empty one, to no ids; equal texts give
equal ids; the special token's own string in a text is that token, as the vocabulary's
library has it; a pretoken of any length is merged whole. Columns beside the text pass
through, and the operator's own columns replace any of the same name.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .pieces import IdMemory, encode_latin, gather, latin, text_groups

#: Fixed value: the pattern that cuts text before the merges. White space is Unicode's property.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
NONE = np.iinfo(np.int64).max
#: Bytes of the longest pretoken that is merged beside others.
SHORT = 64


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class ByteBpe:
    """Vocabulary and merges of a tokenizers file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.piece = [b""] * size
        for t, i in vocab.items():
            self.piece[i] = t.encode() if t in self.special else bytes(byte_of[c] for c in t)
        for t, i in self.special.items():
            self.piece[i] = t.encode()
        self.cut = regex.compile(PATTERN)
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.byte_id = np.array([vocab[c] for c in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.size = size
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._fill(np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64))
        self.memory = IdMemory()
        sizes = np.fromiter(map(len, self.piece), np.int64, size)
        self._bytes, self._length, self._offset = np.frombuffer(b"".join(self.piece), np.uint8), sizes, np.cumsum(sizes) - sizes

    def _fill(self, keys: np.ndarray) -> None:
        """An open-addressing table from pair to rank; an earlier rank of a pair stays."""
        bits = max(4, int(len(keys) * 6).bit_length())
        self._shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self._key, self._rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int64)
        self._probes = 1
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), strict=True)):
            probe = 1
            while self._key[slot] not in (-1, key):
                slot, probe = (slot + 1) & mask, probe + 1
            if self._key[slot] == -1:
                self._key[slot], self._rank[slot] = key, rank
                self._probes = max(self._probes, probe)
        self._by_key = {int(k): int(r) for k, r in zip(self._key, self._rank, strict=True) if k >= 0}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it doesn't merge."""
        keys = left * self.size + right
        slot = self._slot(keys)
        out = np.where(self._key[slot] == keys, self._rank[slot], NONE)
        open_ = np.flatnonzero((out == NONE) & (self._key[slot] != -1))
        for _ in range(self._probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self._key) - 1)
            found = self._key[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self._rank[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def _merge_rows(self, rows: list[bytes], width: int) -> list[bytes]:
        """Pretokens of up to ``width`` bytes, a power of two, one tree in each row."""
        n, lens = len(rows), np.fromiter(map(len, rows), np.int64, len(rows))
        ids = np.full((n, width), -1, np.int64)
        here = np.arange(width) < lens[:, None]
        ids[here] = self.byte_id[np.frombuffer(b"".join(rows), np.uint8)]
        after = np.where(here, np.arange(1, width + 1), width)
        after[np.arange(n), lens - 1] = width
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int64)
        pair = here[:, 1:]
        got = self.ranks(ids[:, :-1][pair], ids[:, 1:][pair])
        place = np.nonzero(pair)[1]
        leaf = tree[:, width : 2 * width - 1]
        leaf[pair] = np.where(got == NONE, NONE, got * width + place)
        level = width // 2
        while level:
            np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2], out=tree[:, level : 2 * level])
            level //= 2
        flat, symbol, nxt, prv = tree.ravel(), ids.ravel(), after.ravel(), before.ravel()
        active = np.flatnonzero(tree[:, 1] != NONE)
        while len(active):
            root, base, seat = flat[active * (2 * width) + 1], active * width, active * (2 * width) + width
            rank, i = root // width, root % width
            j = nxt[base + i]
            symbol[base + i], symbol[base + j] = self.merged[rank], -1
            k, h = nxt[base + j], prv[base + i]
            nxt[base + i] = k
            has_k, has_h = k < width, h >= 0
            prv[(base + k)[has_k]] = i[has_k]
            flat[seat + j] = NONE
            flat[seat + i] = NONE
            right = base[has_k]
            got = self.ranks(symbol[right + i[has_k]], symbol[right + k[has_k]])
            flat[(seat + i)[has_k]] = np.where(got == NONE, NONE, got * width + i[has_k])
            left = base[has_h]
            got = self.ranks(symbol[left + h[has_h]], symbol[left + i[has_h]])
            flat[(seat + h)[has_h]] = np.where(got == NONE, NONE, got * width + h[has_h])
            top = active * (2 * width)
            for leaf_ in (j, i, np.where(has_h, h, i)):
                node = (leaf_ + width) >> 1
                while node[0]:
                    flat[top + node] = np.minimum(flat[top + 2 * node], flat[top + 2 * node + 1])
                    node = node >> 1
            active = active[flat[top + 1] != NONE]
        left = ids >= 0
        out = ids[left].astype("<u4").tobytes()
        ends = np.cumsum(left.sum(1) * 4).tolist()
        return [out[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _merge_one(self, word: bytes) -> bytes:
        """The same for one pretoken of any length, in packed arrays: 40 to 56 bytes for each of its bytes."""
        width = 1 << max(1, (len(word) - 1).bit_length())
        ids = array("q", self.byte_id[np.frombuffer(word, np.uint8)].astype(np.int64).tobytes())
        n, size, rank_of, merged = len(ids), self.size, self._by_key, self.merged
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        after[-1] = -1
        none = 1 << 62
        tree = array("q", [none]) * (2 * width)

        def put(i: int, j: int) -> None:
            rank = NONE if j < 0 else rank_of.get(ids[i] * size + ids[j], NONE)
            tree[width + i] = none if rank == NONE else rank * width + i

        def climb(i: int) -> None:
            node = (width + i) >> 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a <= b else b
                node >>= 1

        for i in range(n):
            put(i, after[i])
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != none:
            rank, i = divmod(tree[1], width)
            j = after[i]
            ids[i], ids[j], after[i] = int(merged[rank]), -1, after[j]
            tree[width + j] = none
            climb(j)
            if after[i] >= 0:
                before[after[i]] = i
            put(i, after[i])
            climb(i)
            if before[i] >= 0:
                put(before[i], i)
                climb(before[i])
        out = np.frombuffer(ids, np.int64)
        return out[out >= 0].astype("<u4").tobytes()

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each pretoken, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        raw = [w.encode() for w in words]
        for i, w in enumerate(raw):
            if len(w) > SHORT:
                out[i] = self._merge_one(w)
            elif w:
                by_width.setdefault(1 << max(1, (len(w) - 1).bit_length()), []).append(i)
        for width, at in by_width.items():
            for lo in range(0, len(at), 1 << 14):
                part = at[lo : lo + (1 << 14)]
                for i, ids in zip(part, self._merge_rows([raw[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _encode_any(self, text: str) -> np.ndarray:
        """Ids of a text of any characters, special tokens included."""
        parts, at = [], 0
        for m in self.at_special.finditer(text) if self.at_special else ():
            parts += [*self.merge(self.cut.findall(text[at : m.start()])), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return np.frombuffer(b"".join([*parts, *self.merge(self.cut.findall(text[at:]))]), "<u4")

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        plain = [None if t and any(x in t for x in self.special) else latin(t) for t in texts]
        quick = iter(encode_latin([p for p in plain if p is not None], True, self.memory, self.merge))
        return [self._encode_any(t) if p is None else next(quick) for t, p in zip(texts, plain, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        return gather(self._bytes, self._offset, self._length, ids)[0].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def bpe(path: str) -> ByteBpe:
    """The vocabulary, read once in each Python worker."""
    return ByteBpe(path)


def _over_texts(df: DataFrame, text: str, own: dict[str, T.DataType], drop: set[str], work) -> DataFrame:
    """``df`` with the columns that ``work(texts) -> list of lists`` makes of ``text``."""
    kept = [f for f in df.schema.fields if f.name not in own and f.name not in drop]
    schema = T.StructType([*kept, *(T.StructField(k, v) for k, v in own.items())])
    names = [f.name for f in kept]
    types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    out_types = [types[v.simpleString().replace("bigint", "long")] for v in own.values()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            groups = text_groups(column) if pa.types.is_string(column.type) else ((slice(k, k + 256), column.slice(k, 256).to_pylist()) for k in range(0, len(column), 256))
            for at, values in groups:
                made = work(values)
                arrays = [batch.column(batch.schema.get_field_index(n)).slice(at.start, len(values)) for n in names]
                arrays += [pa.array(x, t) for x, t in zip(made, out_types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, *own])

    return df.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)


def encode_bpe(docs: DataFrame, vocabulary: str, *, text: str = "text") -> DataFrame:
    """``docs`` with ids (array<int>) and n_tokens in place of the text; ``vocabulary``: the file's path on every machine."""

    def work(texts):
        ids = [x.astype(np.int32) for x in bpe(vocabulary).encode(texts)]
        return ids, [len(x) for x in ids]

    return _over_texts(docs, text, {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType()}, {text}, work)


def decode_bpe(encoded: DataFrame, vocabulary: str, *, ids: str = "ids") -> DataFrame:
    """``encoded`` with the text that the ids stand for, added as ``text``."""

    def work(rows):
        return ([bpe(vocabulary).decode(np.array(x or [], np.int64)) for x in rows],)

    return _over_texts(encoded, ids, {"text": T.StringType()}, set(), work)


def bpe_round_trip(docs: DataFrame, vocabulary: str, *, text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_tokens and the digests of the ids and of the text decoded from them."""

    def work(texts):
        ids = bpe(vocabulary).encode(texts)
        back = [hashlib.sha256(bpe(vocabulary).decode(x).encode()).hexdigest() for x in ids]
        return [len(x) for x in ids], [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], back

    own = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return _over_texts(docs, text, own, {text}, work)
