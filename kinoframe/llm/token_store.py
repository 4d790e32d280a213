"""Token ids in a binary store coded by a static range asymmetric numeral system.

One frequency table, counted over all documents, serves every block. A block holds
whole documents in ascending order of id and stands alone: its ids go in turn to
interleaved lanes, each a range coder state, whose 32-bit words share one stream.
Checkpoints hold all states and the place in the stream at every so many steps, so
parts of a block can be decoded side by side, and a checksum tells damaged blocks.

A store is a folder of Parquet files that Spark writes and reads: ``table`` (symbol,
frequency) and ``blocks`` (segment, block, n_ids, lanes, words, checkpoints, crc32, and
the ids and sizes of its documents). A segment is a range of document ids.

Defined results: a null text is encoded as the empty one and so holds only the end id;
rows with a null id come last; rows that share an id are all kept, ordered by their
token ids' hash, equal rows side by side; an empty table gives an empty store. Columns beside
the id and the text are not stored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import IdMemory, encode_latin, latin, text_groups
from .storage import written

#: log2 of the sum of frequencies; lower bound of a state; bits of a stream word.
BITS, LOW, WORD = 18, np.uint64(1 << 31), np.uint64(32)
#: Ids after which a block ends with its document; most lanes; steps between checkpoints.
BLOCK, LANES, STEPS = 1 << 19, 2048, 64
#: Pieces in a line for the library.
LINE = 64
#: Lower case of each Latin-1 character.
LOWER = bytes(range(256)).decode("latin-1").lower().encode("latin-1")


# --- ids -------------------------------------------------------------------------


class WordEncoder:
    """The tokenizers library, asked once for each piece that comes again.

    A Latin-1 text without the special tokens' strings is cut as the vocabulary's own
    rules cut it (its normal form is itself); any other text goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.memory = IdMemory()

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, which the library gets by the line: a piece ends with the token that ends a word."""
        lines = [pieces[i : i + LINE] for i in range(0, len(pieces), LINE)]
        out: list[bytes] = []
        for line, got in zip(lines, self.library.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(got.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(line) and (not len(ids) or ends[-1] == len(ids)):
                flat, ends = ids.tobytes(), (4 * ends).tolist()
                out += [flat[i:j] for i, j in zip([0, *ends], ends, strict=False)]
            else:  # a piece of several words: one by one
                out += [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(line, add_special_tokens=False)]
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        plain = [None if t and any(x in t for x in self.special) else latin(t) for t in texts]
        quick = iter(encode_latin([p.translate(LOWER) for p in plain if p is not None], False, self.memory, self._new))
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32) if p is None else next(quick) for t, p in zip(texts, plain, strict=True)]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids in the narrowest of two widths, compressed: how they travel between the parts of the job."""
    narrow = not len(ids) or int(ids.max()) < 1 << 16
    return bytes([narrow]) + zstandard.compress(ids.astype("<u2" if narrow else "<u4").tobytes(), 3)


def unpack_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed[1:]), "<u2" if packed[0] else "<u4").astype(np.uint32)


def token_ids(docs: DataFrame, vocabulary: str, end_id: int, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): each text's ids and the end id, as ``pack_ids`` packs them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for at, texts in text_groups(batch.column(1)):
                ids = [pack_ids(np.r_[x, end]) for x in word_encoder(vocabulary).encode(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at.start, len(ids)), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, "doc_id long, ids binary")


# --- the coder ---------------------------------------------------------------------


def frequency_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**BITS, at least 1 for every symbol counted."""
    total = int(counts.sum())
    out = np.where(counts > 0, np.maximum(1, counts.astype(object) * (1 << BITS) // max(total, 1)), 0).astype(np.int64)
    if not total:
        return out
    if (counts > 0).sum() > 1 << BITS:
        raise ValueError(f"more than 2**{BITS} different symbols")
    order = np.argsort(-counts, kind="stable")
    rest = (1 << BITS) - int(out.sum())
    if rest > 0:
        out[order[0]] += rest
    for s in order:
        if rest >= 0:
            break
        less = min(-rest, int(out[s]) - 1)
        out[s] -= less
        rest += less
    return out


class Coder:
    """Encodes and decodes blocks under one frequency table."""

    def __init__(self, frequencies: np.ndarray):
        self.freq = frequencies.astype(np.uint64)
        self.cum = np.r_[np.uint64(0), np.cumsum(self.freq)[:-1]] if len(self.freq) else self.freq
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)

    def encode(self, ids: np.ndarray, lanes: int, steps: int) -> tuple[bytes, bytes]:
        """(stream, checkpoints): a checkpoint is a place in the stream and all states, in order of decoding."""
        n = len(ids)
        state = np.full(lanes, LOW, np.uint64)
        out, marks, done = [], [], 0
        bits, shift = np.uint64(BITS), np.uint64(63 - BITS)
        for step in range(-(-n // lanes) - 1, -1, -1):
            part = ids[step * lanes : (step + 1) * lanes]
            x, f = state[: len(part)], self.freq[part]
            over = x >= (f << shift)
            if over.any():
                words = (x[over] & np.uint64(0xFFFFFFFF)).astype("<u4")
                out.append(words)
                done += len(words)
                x[over] >>= WORD
            q = x // f
            x[:] = (q << bits) + (x - q * f) + self.cum[part]
            if step % steps == 0:
                marks.append((done, state.astype("<u8").tobytes()))
        marks = [(done - at).to_bytes(8, "little") + s for at, s in reversed(marks)]
        return b"".join(w.tobytes() for w in reversed(out)), b"".join(marks)

    def decode(self, stream: bytes, marks: bytes, n: int, lanes: int, steps: int, part: int | None = None) -> np.ndarray:
        """All ids of a block, or those of the steps from checkpoint ``part`` to the next."""
        words, mask, bits = np.frombuffer(stream, "<u4"), np.uint64((1 << BITS) - 1), np.uint64(BITS)
        size = 8 + 8 * lanes
        first, last = (0, -(-n // lanes)) if part is None else (part * steps, min((part + 1) * steps, -(-n // lanes)))
        mark = marks[(part or 0) * size : ((part or 0) + 1) * size]
        at, state = int.from_bytes(mark[:8], "little"), np.frombuffer(mark[8:], "<u8").astype(np.uint64)
        lo, hi = first * lanes, min(n, last * lanes)
        out = np.empty(max(0, hi - lo), np.uint32)
        for step in range(first, last):
            k = min(lanes, n - step * lanes)
            x = state[:k]
            slot = x & mask
            s = self.symbol[slot]
            out[step * lanes - lo : step * lanes - lo + k] = s
            x[:] = self.freq[s] * (x >> bits) + slot - self.cum[s]
            under = np.flatnonzero(x < LOW)
            if len(under):
                x[under] = (x[under] << WORD) | words[at : at + len(under)].astype(np.uint64)
                at += len(under)
        return out


# --- the store -----------------------------------------------------------------------


def _lanes(n: int) -> int:
    return max(1, min(LANES, 1 << max(0, (n // 64).bit_length() - 1)))


_BLOCKS = "segment int, block int, n_ids long, lanes int, words binary, checkpoints binary, crc32 long, doc_ids array<long>, doc_sizes array<long>"


def write_store(ids: DataFrame, path: str) -> None:
    """Writes (doc_id, packed ids) as a store, which must not be there yet. ``ids`` is read twice."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0):
                got = np.bincount(unpack_ids(x.as_py()))
                if len(got) > len(total):
                    total = np.r_[total, np.zeros(len(got) - len(total), np.int64)]
                total[: len(got)] += got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["symbol", "n"])

    spark = ids.sparkSession
    # One row for each symbol of the vocabulary at most.
    counted = ids.select("ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["symbol"] + 1 for r in counted], default=0), np.int64)
    for r in counted:
        counts[r["symbol"]] = r["n"]
    frequencies = frequency_table(counts)
    table = [(int(s), int(frequencies[s])) for s in np.flatnonzero(frequencies)]
    spark.createDataFrame(table, "symbol long, frequency long").coalesce(1).write.parquet(f"{path}/table")

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, segment, number = Coder(frequencies), TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        size = 0

        def block() -> pa.RecordBatch:
            values = np.concatenate(held)
            flat = values.astype("<u4").tobytes()
            lanes = _lanes(len(values))
            words, marks = coder.encode(values, lanes, STEPS)
            row = [segment, number, len(values), lanes, words, marks, zlib.crc32(flat), list(docs), list(map(len, held))]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=[c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append(unpack_ids(x.as_py()))
                docs.append(doc)
                size += len(held[-1])
                if size >= BLOCK:
                    yield block()
                    held, docs, size, number = [], [], 0, number + 1
        if held:
            yield block()

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("ids").asc()]
    ids.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, _BLOCKS).write.parquet(f"{path}/blocks")


def _decoded(blocks: DataFrame, frequencies: np.ndarray, schema: str, make) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequencies)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                values = coder.decode(row["words"], row["checkpoints"], row["n_ids"], row["lanes"], STEPS)
                flat = values.astype("<u4").tobytes()
                if zlib.crc32(flat) != row["crc32"]:
                    raise ValueError(f"block {row['block']} of segment {row['segment']} is damaged")
                yield make(row, flat)

    return blocks.mapInArrow(run, schema)


def _opened(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(blocks, (segment, block, ids of the segment before it b0, ids of segments before s0), frequencies)."""
    # One row for each symbol of the vocabulary at most.
    table = spark.read.schema("symbol long, frequency long").parquet(f"{path}/table").collect()
    frequencies = np.zeros(max([r["symbol"] + 1 for r in table], default=0), np.int64)
    for r in table:
        frequencies[r["symbol"]] = r["frequency"]
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    # One row for each block, without its ids; then one for each segment.
    inside = Window.partitionBy("segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    segments = blocks.groupBy("segment").agg(F.sum("n_ids").alias("n")).select("segment", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("s0"))
    starts = blocks.select("segment", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("b0")).join(segments, "segment")
    return blocks, starts, frequencies


def read_store(spark: SparkSession, path: str, *, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, ids as array<int>; with ``digest`` their ids_crc32 instead."""
    blocks, starts, frequencies = _opened(spark, path)
    last = "ids_crc32 long" if digest else "ids array<int>"
    if not digest:  # a block learns its start before it is decoded, so that no ids are shuffled
        blocks = blocks.join(starts.select("segment", "block", (F.col("s0") + F.col("b0")).alias("first")), ["segment", "block"])

    def make(row: dict, flat: bytes) -> pa.RecordBatch:
        sizes = np.array(row["doc_sizes"], np.int64)
        ends = np.cumsum(sizes)
        if digest:
            out = pa.array([zlib.crc32(flat[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)], pa.int64())
        else:
            out = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(np.frombuffer(flat, "<i4")))
        n = len(sizes)
        arrays = [pa.array(np.full(n, row[k], np.int32)) for k in ("segment", "block")]
        arrays += [pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes + row.get("first", 0)), pa.array(sizes), out]
        return pa.RecordBatch.from_arrays(arrays, names=["segment", "block", "doc_id", "inner", "n_tokens", last.split()[0]])

    docs = _decoded(blocks, frequencies, f"segment int, block int, doc_id long, inner long, n_tokens long, {last}", make)
    if not digest:
        return docs.select("doc_id", F.col("inner").alias("start"), "n_tokens", "ids")
    start = (F.col("s0") + F.col("b0") + F.col("inner")).alias("start")
    return docs.join(starts, ["segment", "block"]).select("doc_id", start, "n_tokens", last.split()[0])


def read_span(spark: SparkSession, path: str, start: int, n: int) -> DataFrame:
    """(at, ids) of ids ``start`` to ``start + n`` of the store, in pieces from one checkpoint to the
    next: each is decoded by itself, and only those that the span touches. ``at`` is a piece's place.
    """
    blocks, starts, frequencies = _opened(spark, path)
    touched = starts.select("segment", "block", (F.col("s0") + F.col("b0")).alias("b0")).join(blocks, ["segment", "block"])
    touched = touched.filter((F.col("b0") < start + n) & (F.col("b0") + F.col("n_ids") > start))
    piece = F.col("lanes") * STEPS
    first, last = F.greatest(F.lit(0), F.lit(start) - F.col("b0")), F.least(F.col("n_ids"), F.lit(start + n) - F.col("b0")) - 1
    parts = touched.withColumn("part", F.explode(F.sequence(F.floor(first / piece), F.floor(last / piece))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequencies)
        for batch in batches:
            for row in batch.to_pylist():
                values = coder.decode(row["words"], row["checkpoints"], row["n_ids"], row["lanes"], STEPS, part=row["part"])
                at = row["b0"] + row["part"] * row["lanes"] * STEPS
                lo, hi = max(0, start - at), min(len(values), start + n - at)
                yield pa.RecordBatch.from_arrays([pa.array([at + lo], pa.int64()), pa.array([values[lo:hi].tolist()], pa.list_(pa.int32()))], names=["at", "ids"])

    return parts.mapInArrow(run, "at long, ids array<int>")


def store_documents(docs: DataFrame, vocabulary: str, path: str, end_id: int, *, id_col: str = "doc_id", text: str = "text") -> None:
    """Encodes all texts and writes them as a store; the ids are held in the shared folder meanwhile."""
    write_store(written(token_ids(docs, vocabulary, end_id, id_col=id_col, text=text), "token-ids"), path)
