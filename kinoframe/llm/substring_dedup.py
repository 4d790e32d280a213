"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the corpus itself. Its blocks are the phrases around content-chosen
anchors: every window of ``window`` words has as its anchor the four-word gram with the
smallest hash in the window (the leftmost of equals), and a block is all windows that
choose one anchor. Every block of every document is indexed twice: by its anchor, with the
first document that holds it, and where blocks of one anchor differ by a hash of its words,
with the first document that holds the same block; both with the place there. Equal passages
choose equal anchors, so a document parses into factors: a factor starts at a block that an
indexed one in a document with a smaller id equals, and goes on, greedily, as long as the next
block equals the next one of the same reference. Factors are ``window`` words or longer. What
is left are blocks that no earlier document holds whole, at the boundaries of factors: their
windows are checked one by one against those of all other such blocks, and as every different
block is there once, against those of all documents. Factors and windows found are the
duplicate spans, which may overlap.

Anchors and windows that a large part of all blocks share are split among tasks.

Defined results: a null text has no words; rows with a null id are left whole and
serve no other as reference; rows that share an id are no reference for each other
and are cut each by its own text (told apart by 30 bits of its hash); repeated rows are
cut alike; a text shorter than the window is left whole. Further columns of ``docs`` are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import salted
from .storage import written
from .textblocks import Block, U, blocks, mix, span_hashes

WINDOW, ANCHOR = 13, 4
#: A block's place packed in 64 bits: its first window, its number of windows less one, its text's tag.
_TAG_BITS, _SIZE_BITS = 30, 4
_TAG = (1 << _TAG_BITS) - 1
_OTHER = U(0x2545F4914F6CDD1D)


def _tag(text: str):
    """Tells texts apart that share an id."""
    return F.xxhash64(text).bitwiseAND(_TAG)


def _anchored(block: Block, words: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Each run of windows with one anchor: first window, last window, anchor's place, anchor's hash."""
    reach = window - ANCHOR
    starts, grams = block.grams(words, ANCHOR)
    dense = np.zeros(len(words), U)
    dense[starts] = grams
    size = len(words) - window + 1
    if size <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),)
    best, at = dense[:size].copy(), np.zeros(size, np.int16)
    for j in range(1, reach + 1):
        less = dense[j : j + size] < best
        np.copyto(best, dense[j : j + size], where=less)
        at[less] = j
    whole = block.text_of[:size] == block.text_of[window - 1 :]
    first = np.flatnonzero(whole)
    place, best = first + at[first], best[first]
    new = np.ones(len(first), bool)
    new[1:] = (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)
    k = np.flatnonzero(new)
    last = np.r_[first[k[1:] - 1], first[-1:]] if len(k) else first
    return first[k], last, place[k], best[k]


def _block_rows(window: int):
    """Every block of every text: anchor, hash of its words and shape, document, packed place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, tags = batch.columns
            ids, tags = ids.to_numpy(zero_copy_only=False), tags.to_numpy(zero_copy_only=False)
            for lo, hi, block in blocks(texts):
                words = block.words()
                s1, s2, place, anchor = _anchored(block, words, window)
                if not len(anchor):
                    continue
                text = block.text_of[s1]
                shape = ((place - s1) * 64 + (s2 - s1)).astype(U)
                content = mix(span_hashes(words, s1, s2 + window) + mix(shape + U(1)))
                packed = ((s1 - block.first[text]) << (_TAG_BITS + _SIZE_BITS)) | ((s2 - s1) << _TAG_BITS) | tags[lo:hi][text]
                out = [anchor.view(np.int64), content.view(np.int64), ids[lo:hi][text], packed]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["anchor", "content", "doc_id", "packed"])

    return run


def _windows_of(window: int):
    """Windows of the stretches to check: two hashes, document, and packed place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            stretches = batch.column(3)
            for lo, hi, block in blocks(batch.column(2)):
                words = block.words()
                part = stretches.slice(lo, hi - lo)
                ends = part.flatten().to_numpy(zero_copy_only=False)
                text = np.repeat(np.arange(hi - lo), part.value_lengths().to_numpy(zero_copy_only=False) // 2)
                begin, n = ends[::2], ends[1::2] - ends[::2] - window + 1
                at = np.repeat(begin + block.first[text], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                text = np.repeat(text, n)
                keys = (span_hashes(w, at, at + window).view(np.int64) for w in (words, mix(words ^ _OTHER)))
                out = [*keys, ids[lo:hi][text], (at - block.first[text]) << _TAG_BITS | tags[lo:hi][text]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["w1", "w2", "doc_id", "packed"])

    return run


def parse_factors(rows: DataFrame, window: int = WINDOW, by_content: bool = True) -> DataFrame:
    """Factors of (doc_id, text, tag): one row for each stretch of words, its begin and end, with
    its reference's id and begin; a stretch whose blocks differ from their references, which is
    still to be checked, has none. Without ``by_content`` a block's only reference is the first
    document that holds its anchor: more windows are left to check, with fewer tables in between.
    """
    found = rows.mapInArrow(_block_rows(window), "anchor long, content long, doc_id long, packed long")
    index = (
        found.groupBy("anchor")
        # Of rows with one id all of these take the same row.
        .agg(F.min("doc_id").alias("ref_id"), F.min_by("content", "doc_id").alias("ref_content"), F.min_by(F.shiftrightunsigned("packed", _TAG_BITS + _SIZE_BITS), "doc_id").alias("ref_at"),
             F.max("doc_id").alias("most"), (F.min("content") != F.max("content")).alias("mixed"), F.count("*").alias("n"))
        .filter("ref_id < most").drop("most")
    )
    dealt, index = salted(found, written(index, "anchors"), ["anchor"], "doc_id")
    at = F.shiftrightunsigned("packed", _TAG_BITS + _SIZE_BITS)
    windows = F.shiftrightunsigned("packed", _TAG_BITS).bitwiseAND((1 << _SIZE_BITS) - 1) + 1
    factor = (F.col("content") == F.col("ref_content")) & (F.col("ref_id") < F.col("doc_id"))
    matched = (
        dealt.join(index, ["anchor", "_salt"])
        .select("doc_id", F.col("packed").bitwiseAND(_TAG).alias("tag"), at.alias("at"), windows.alias("n"), *(F.when(factor, F.col(c)).alias(c) for c in ("ref_id", "ref_at")), "mixed", "content")
        .filter("mixed OR ref_id IS NOT NULL")
    )
    if by_content:
        matched = written(matched, "shared-blocks")
        # A block unlike its anchor's first one has the first document that holds the same block as its reference.
        unlike = matched.filter("ref_id IS NULL").drop("ref_id", "ref_at")
        others = unlike.groupBy("content").agg(F.min("doc_id").alias("ref_id"), F.min_by("at", "doc_id").alias("ref_at"), F.max("doc_id").alias("most"), F.count("*").alias("copies")).filter("ref_id < most").drop("most")
        dealt, others = salted(unlike, written(others, "other-blocks"), ["content"], "doc_id", count="copies")
        later = F.col("ref_id") < F.col("doc_id")
        unlike = dealt.join(others, ["content", "_salt"], "left").select("doc_id", "tag", "at", "n", *(F.when(later, F.col(c)).alias(c) for c in ("ref_id", "ref_at")))
        matched = matched.filter("ref_id IS NOT NULL").select("doc_id", "tag", "at", "n", "ref_id", "ref_at").unionByName(unlike)
    along = Window.partitionBy("doc_id", "tag").orderBy("at")
    goes_on = (
        (F.lag(F.col("at") + F.col("n")).over(along) == F.col("at"))
        & F.lag("ref_id").over(along).eqNullSafe(F.col("ref_id"))
        & F.lag(F.col("ref_at") - F.col("at")).over(along).eqNullSafe(F.col("ref_at") - F.col("at"))
    )
    numbered = matched.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("factor", F.sum("new").over(along))
    return numbered.groupBy("doc_id", "tag", "factor").agg(
        F.min("at").alias("begin"), (F.max(F.col("at") + F.col("n")) + (window - 1)).alias("end"), F.first("ref_id").alias("ref_id"), F.min("ref_at").alias("ref_begin")
    ).drop("factor")


def _flat(spans: str):
    return F.flatten(F.transform(spans, lambda s: F.array(s["begin"], s["end"])))


def duplicate_spans(docs: DataFrame, window: int = WINDOW, *, id_col: str = "doc_id", text: str = "text", rest: Sequence[str] = (), by_content: bool = True) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): rows (doc_id, text, rest, tag) of ``docs``, and duplicate spans
    (doc_id, tag, begin, end) in words, which may overlap.
    """
    if window - ANCHOR >= 1 << _SIZE_BITS:
        raise ValueError(f"a window has at most {ANCHOR + (1 << _SIZE_BITS) - 1} words")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), *rest).withColumn("tag", _tag("text"))
    rows = texts.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "tag")
    factors = written(parse_factors(rows, window, by_content), "factors")
    differing = factors.filter("ref_id IS NULL").groupBy("doc_id", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    windows = written(
        rows.join(differing, ["doc_id", "tag"]).select("doc_id", "tag", "text", _flat("spans").alias("spans"))
        .mapInArrow(_windows_of(window), "w1 long, w2 long, doc_id long, packed long"),
        "windows",
    )
    firsts = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")).filter("least < most").drop("most")
    dealt, firsts = salted(windows, written(firsts, "first-windows"), ["w1", "w2"], "doc_id")
    begin = F.shiftrightunsigned("packed", _TAG_BITS)
    checked = dealt.join(firsts, ["w1", "w2", "_salt"]).filter("doc_id > least").select("doc_id", F.col("packed").bitwiseAND(_TAG).alias("tag"), begin.alias("begin"), (begin + window).alias("end"))
    return texts, factors.filter("ref_id IS NOT NULL").select("doc_id", "tag", "begin", "end").unionByName(checked)


def _cut(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of n words the spans cover; spans are begin and end in turn."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, spans[::2], 1)
    np.add.at(edge, spans[1::2], -1)
    return np.cumsum(edge[:n]) > 0


def remove_duplicate_spans(docs: DataFrame, window: int = WINDOW, *, id_col: str = "doc_id", text: str = "text", digest: bool = False, by_content: bool = True) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text, the words left joined by one space
    (the text itself if nothing is removed); with ``digest`` only the id, the counts and
    kept_sha256, of the words joined by one space in any case.
    """
    rest = [] if digest else [c for c in docs.columns if c not in (id_col, text, "doc_id", "text", "n_words", "n_removed", "kept_text", "tag", "spans")]
    texts, spans = duplicate_spans(docs, window, id_col=id_col, text=text, rest=rest, by_content=by_content)
    grouped = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("spans")).withColumn("spans", _flat("spans"))
    joined = texts.join(grouped, ["doc_id", "tag"], "left").select("doc_id", "text", "spans", *rest)
    fields = ["doc_id", *rest]
    types = dict(joined.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in fields), "n_words long", "n_removed long", "kept_sha256 string" if digest else "text string, kept_text string"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_, spans_ = batch.column(1), batch.column(2)
            for lo, hi, block in blocks(texts_):
                n, removed, kept = block.n_words, np.zeros(hi - lo, np.int64), []
                raw = block.bytes.tobytes()
                for i, cut in enumerate(spans_.slice(lo, hi - lo)):
                    a, b = int(block.at[i]), int(block.at[i + 1])
                    words = None
                    if cut.is_valid:
                        gone = _cut(cut.values.to_numpy(zero_copy_only=False), int(n[i]))
                        removed[i] = int(gone.sum())
                        if removed[i]:
                            words = raw[a:b].split()
                            words = [words[k] for k in np.flatnonzero(~gone).tolist()]
                    if digest:
                        kept.append(hashlib.sha256(b" ".join(raw[a:b].split() if words is None else words)).hexdigest())
                    else:
                        kept.append(texts_[lo + i].as_py() if words is None else b" ".join(words).decode())
                arrays = [batch.column(0).slice(lo, hi - lo), *(batch.column(3 + k).slice(lo, hi - lo) for k in range(len(rest)))]
                names = [*fields, "n_words", "n_removed"]
                arrays += [pa.array(n.astype(np.int64)), pa.array(removed)]
                if not digest:
                    arrays, names = [*arrays, texts_.slice(lo, hi - lo)], [*names, "text"]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(kept, pa.string())], names=[*names, "kept_sha256" if digest else "kept_text"])

    return joined.mapInArrow(run, schema)
