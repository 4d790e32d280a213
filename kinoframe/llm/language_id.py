"""Language identification by unigrams of pieces, all segmentations summed.

Pieces are those of a fixed public byte-pair vocabulary that consist of lower-case letters,
with or without the space before a word, and every single byte, so that each word has a
segmentation. A language gives each piece a probability; a word's probability is the sum
over all its segmentations of their products, which a forward pass computes; a text's score
is the sum of its words' logarithms. Probabilities are learned from labelled rows: first from
all occurrences of a piece, then from its expected number under the segmentations so weighted.

A word is a whole run of letters, however long: sums are rescaled along the way, and the forward
pass keeps no more positions than the longest piece has bytes.

Training takes a bounded sample of labelled rows, ``sample_rows`` in each language, chosen by a
hash of their id; whole texts of them. What the driver gets is a row for each language and piece,
and what it sends a number for each; there are ``MOST_LANGUAGES`` at most.

Defined results: a null text and one without a letter are ``und`` with score 0; so are all if
nothing could be learned; equal scores go to the language first in order of code points; rows
that share an id are predicted each by its text. Columns beside id, text and language are not kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import CLASS, LETTER, latin, text_groups
from .storage import written
from .textblocks import BYTE_VALUE, U, span_hashes

#: Bytes after which sums are rescaled; words remembered with their scores, of so many bytes at most.
RESCALE, REMEMBERED, SHORT = 16, 500_000, 64
#: Languages that can be learned: the probabilities of all pieces are sent to every task.
MOST_LANGUAGES = 256
UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")
_LOWER = bytes(range(256)).decode("latin-1").lower().encode("latin-1")


class Pieces:
    """The vocabulary as a trie: a step is an array lookup for many words at once."""

    def __init__(self, path: str):
        allowed = {*range(0x61, 0x7B), *range(0x80, 0x100)}
        tokens = {bytes([b]) for b in allowed | {0x20}}
        with open(path, "rb") as f:
            for line in f:
                token = base64.b64decode(line.split()[0])
                if token.removeprefix(b" ") and set(token.removeprefix(b" ")) <= allowed:
                    tokens.add(token)
        self.tokens = sorted(tokens)
        self.longest = max(map(len, self.tokens))
        #: Column of a byte, and one of no byte.
        self.none = len(allowed) + 1
        self.column = np.full(256, self.none, np.int64)
        self.column[sorted(allowed | {0x20})] = np.arange(len(allowed) + 1)
        steps: list[dict[int, int]] = [{}, {}]
        self.piece = [-1, -1]
        for i, t in enumerate(self.tokens):
            node = 1
            for b in t:
                at = steps[node].get(b)
                if at is None:
                    at = steps[node][b] = len(steps)
                    steps.append({})
                    self.piece.append(-1)
                node = at
            self.piece[node] = i
        self.next = np.zeros((len(steps), len(allowed) + 2), np.int32)
        for node, by in enumerate(steps):
            for b, at in by.items():
                self.next[node, self.column[b]] = at
        self.piece = np.array(self.piece, np.int32)

    def by_length(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places, lengths, columns of the bytes) of words of like lengths, a space before each word.

        Longer words share a matrix, filled up with a column that no piece has.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        room = np.where(sizes <= RESCALE, sizes, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        for n in np.unique(room).tolist():
            every = np.flatnonzero(room == n)
            for lo in range(0, len(every), max(1, (1 << 20) // n)):
                at = every[lo : lo + max(1, (1 << 20) // n)]
                raw = np.frombuffer(b"".join([words[i].ljust(n, b"\0") for i in at.tolist()]), np.uint8).reshape(len(at), n)
                columns = self.column[raw]
                columns[np.arange(n) >= sizes[at][:, None]] = self.none
                yield at, sizes[at], columns

    def edges(self, columns: np.ndarray, s: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(end, rows, pieces) of every piece that starts at place ``s`` of a word, by its end."""
        rows, node = np.arange(len(columns)), np.ones(len(columns), np.int32)
        for e in range(s, columns.shape[1]):
            node = self.next[node, columns[rows, e]]
            alive = np.flatnonzero(node)
            if not len(alive):
                return
            rows, node = rows[alive], node[alive]
            piece = self.piece[node]
            hit = np.flatnonzero(piece >= 0)
            if len(hit):
                yield e + 1, rows[hit], piece[hit]

    def log_probability(self, words: list[bytes], p: np.ndarray) -> np.ndarray:
        """Log of the sum over segmentations, for each word and language."""
        out = np.empty((len(words), p.shape[1]))
        for at, sizes, columns in self.by_length(words):
            ring = np.zeros((self.longest + 1, len(at), p.shape[1]))
            scale = np.zeros((len(at), p.shape[1]))
            ring[0] = 1
            for s in range(int(sizes.max()) + 1):
                now = ring[s % len(ring)]
                done = np.flatnonzero(sizes == s)
                out[at[done]] = np.log(now[done]) + scale[done]
                if s % RESCALE == RESCALE - 1:
                    most = ring.max(0)
                    most[most == 0] = 1
                    ring /= most
                    scale += np.log(most)
                if s < columns.shape[1]:
                    for e, rows, piece in self.edges(columns, s):
                        ring[e % len(ring), rows] += now[rows] * p[piece]
                now[:] = 0
        return out

    def occurrences(self, words: list[bytes], n: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.tokens))
        for at, _, columns in self.by_length(words):
            for s in range(columns.shape[1]):
                for _, rows, piece in self.edges(columns, s):
                    out += np.bincount(piece, n[at[rows]], len(out))
        return out

    def expected(self, words: list[bytes], n: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected number of each piece under one language, over words that come ``n`` times."""
        out = np.zeros(len(self.tokens))
        for at, sizes, columns in self.by_length(words):
            size, each = columns.shape[1], np.arange(len(at))
            ahead, scale = np.zeros((size + 1, len(at))), np.zeros((size + 1, len(at)))
            ahead[0] = 1
            for s in range(size):
                if s % RESCALE == RESCALE - 1:  # all places from here on count from another unit
                    stop = min(size, s + self.longest) + 1
                    most = ahead[s:stop].max(0)
                    most[most == 0] = 1
                    ahead[s:stop] /= most
                    scale[s:] += np.log(most)
                for e, rows, piece in self.edges(columns, s):
                    ahead[e, rows] += ahead[s, rows] * p[piece]
            total = np.log(ahead[sizes, each]) + scale[sizes, each]
            back, unit = np.zeros((size + 1, len(at))), np.zeros((size + 1, len(at)))
            back[sizes, each] = 1
            for s in range(size - 1, -1, -1):
                if s % RESCALE == 0:
                    stop = min(size, s + self.longest) + 1
                    most = back[s:stop].max(0)
                    most[most == 0] = 1
                    back[s:stop] /= most
                    unit[: s + 1] += np.log(most)
                    unit[s + 1 : stop] += np.log(most)
                for e, rows, piece in self.edges(columns, s):
                    back[s, rows] += back[e, rows] * p[piece]
                    share = np.exp(np.minimum(scale[s, rows] + unit[e, rows] - total[rows], 600.0))
                    out += np.bincount(piece, ahead[s, rows] * p[piece] * back[e, rows] * share * n[at[rows]], len(out))
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, text of each) of the runs of letters in Latin-1 texts."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    at = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
    letter = CLASS[raw] == LETTER
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    before = np.r_[False, letter[:-1]] if len(raw) else letter
    after = np.r_[letter[1:], False] if len(raw) else letter
    starts = np.flatnonzero(letter & (~before | edge[:-1]))
    ends = np.flatnonzero(letter & (~after | edge[1:])) + 1
    return raw, starts, ends, np.searchsorted(at, starts, "right") - 1


def _words(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(words, hash of each, text of each occurrence, word of each occurrence): lower-case runs of
    letters, with the space that stands before a word.
    """
    plain = [latin(t) for t in texts]
    raw, starts, ends, text_of = _runs([p.translate(_LOWER) for p in plain if p is not None])
    text_of = np.flatnonzero([p is not None for p in plain])[text_of]
    keys, at, back = np.unique(span_hashes(BYTE_VALUE[raw], starts, ends), return_index=True, return_inverse=True)
    flat = raw.tobytes()
    words = [b" " + flat[a:b].decode("latin-1").encode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
    other: dict[str, int] = {}
    t2, w2 = [], []
    for i, p in enumerate(plain):
        for w in _LETTERS.findall(texts[i].lower()) if p is None else ():
            t2.append(i)
            w2.append(len(words) + other.setdefault(w, len(other)))
    words += [b" " + w.encode() for w in other]
    mine = np.array([np.uint64(hash(w) & (2**64 - 1)) for w in words[len(keys) :]], U)
    return words, np.r_[keys, mine], np.r_[text_of, np.array(t2, np.int64)], np.r_[back, np.array(w2, np.int64)]


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of a task's texts, a group of texts at a time."""
    for batch in batches:
        for lang in batch.column(0).unique().to_pylist():
            for _, mine in text_groups(batch.filter(pc.equal(batch.column(0), lang)).column(1)):
                words, _, _, of = _words(mine)
                n = np.bincount(of, minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])


def _counts(path: str, model: dict[str, np.ndarray] | None):
    """(lang, piece, n) of a task's different words and their numbers: occurrences, or expected numbers under a model."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = pieces(path), {}
        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                mine = batch.filter(pc.equal(batch.column(0), lang))
                words, n = mine.column(1).to_pylist(), mine.column(2).to_numpy().astype(float)
                got = vocabulary.occurrences(words, n) if model is None else vocabulary.expected(words, n, model[lang])
                total[lang] = total.get(lang, 0) + got
        for lang, n in total.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen)), pa.array(seen.astype(np.int32)), pa.array(n[seen])], names=["lang", "piece", "n"])

    return run


def learn_languages(labelled: DataFrame, vocabulary: str, *, sample_rows: int = 4000, smoothing: float = 0.1, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, probabilities of the pieces by language) from rows with a language and a text."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(id_col)).alias("_h")).filter("lang IS NOT NULL AND text IS NOT NULL")
    # One row for each language.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return [], np.zeros((0, 0))
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{len(sizes)} languages, more than {MOST_LANGUAGES}")
    share = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample_rows / n)))))
    place = F.shiftrightunsigned("_h", 1).cast("double") / float(1 << 63)
    sample = rows.filter(place < share[F.col("lang")]).select("lang", "text").mapInArrow(_word_counts, "lang string, word binary, n long")
    sample = written(sample.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    size, model = len(pieces(vocabulary).tokens), None
    for _ in range(2):
        # One row for each language and piece of the vocabulary at most.
        counted = sample.mapInArrow(_counts(vocabulary, model), "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        model = {}
        for k in sizes:
            mine = counted[counted["lang"] == k]
            n = np.full(size, smoothing)
            n[mine["piece"].to_numpy(int)] += mine["n"].to_numpy()
            model[k] = n / n.sum()
    names = sorted(sizes, key=lambda k: k.encode())
    return names, np.stack([model[k] for k in names], 1)


def predict_languages(docs: DataFrame, vocabulary: str, names: list[str], p: np.ndarray, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language of each text and its share of the likelihood."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, scores = np.zeros(0, U), np.zeros((0, len(names)))
        for batch in batches:
            for group, mine in text_groups(batch.column(1)):
                words, hashes, text_of, of = _words(mine)
                if names and len(words):
                    at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
                    known = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
                    word = np.empty((len(words), len(names)))
                    word[known] = scores[at[known]]
                    new = np.flatnonzero(~known)
                    word[new] = pieces(vocabulary).log_probability([words[i] for i in new.tolist()], p)
                    new = new[[len(words[i]) <= SHORT for i in new.tolist()]]
                    if len(keys) + len(new) > REMEMBERED:
                        keys, scores = keys[:0], scores[:0]
                    else:
                        order = np.argsort(hashes[new], kind="stable")
                        put = np.searchsorted(keys, hashes[new][order])
                        keys, scores = np.insert(keys, put, hashes[new][order]), np.insert(scores, put, word[new][order], 0)
                    total = np.stack([np.bincount(text_of, word[of, k], len(mine)) for k in range(len(names))], 1)
                    best = total.argmax(1)
                    share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                else:
                    best, share = np.zeros(len(mine), int), np.zeros(len(mine))
                some = np.bincount(text_of, minlength=len(mine)) > 0 if names else np.zeros(len(mine), bool)
                lang = [names[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(group.start, len(mine)), pa.array(lang, pa.string()), pa.array(np.where(some, share, 0.0))], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Rows that no model here learns from: a fixed quarter by checksum of the id; a null id is none of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
