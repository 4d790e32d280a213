"""Tags and ranked search over captions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import STOP_WORDS, terms
from ..sources.folders import kept

#: BM25's saturation and length weights.
K1, B = 1.2, 0.75
#: Words counted at a time, and characters of a text by which captions of one time are parted.
WORDS, PREFIX = 1 << 20, 32


def keyword_tags(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, rank, tag, n): the most frequent words of more than two letters, stop words aside; of equals the one seen first.

    A text's words are counted in its own row: nothing is shuffled. Batches of texts are counted together.
    """
    words = F.filter(terms(F.col(text)), lambda w: (F.length(w) > 2) & ~w.isin(list(STOP_WORDS)))
    tag = pa.list_(pa.struct([("tag", pa.string()), ("n", pa.int64())]))

    @F.arrow_udf("array<struct<tag: string, n: long>>")
    def most_common(texts: pa.Array) -> pa.Array:
        out = [_most_common(texts.slice(lo, 512), n) for lo in range(0, len(texts), 512)]
        return pa.concat_arrays([a.cast(tag) for a in out]) if out else pa.array([], tag)

    ranked = docs.select(key, F.posexplode(most_common(F.coalesce(words, F.array().cast("array<string>")))).alias("rank", "t"))
    return ranked.select(key, (F.col("rank") + 1).alias("rank"), "t.tag", "t.n")


def _most_common(texts: pa.Array, n: int) -> pa.Array:
    """The ``n`` most frequent words of each list, as lists of (tag, n)."""
    flat = texts.flatten().dictionary_encode()
    names = flat.dictionary
    code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(texts).to_numpy(zero_copy_only=False))
    both, first, count = np.unique(row * max(1, len(names)) + code, return_index=True, return_counts=True)
    row, code = both // max(1, len(names)), both % max(1, len(names))
    order = np.lexsort((first, -count, row))
    row, code, count = row[order], code[order], count[order]
    edge = np.searchsorted(row, np.arange(len(texts) + 1))
    kept_ = np.flatnonzero(np.arange(len(row)) - edge[row] < n)
    ends = np.concatenate([[0], np.cumsum(np.minimum(np.diff(edge), n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([names.take(pa.array(code[kept_])), pa.array(count[kept_], pa.int64())], names=["tag", "n"]))


def _counted(words: Column, first: int = 0) -> Column:
    """A text's different words, each with its number and its places from ``first`` on: array of (term, n, places). Nothing is shuffled."""
    kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64()), ("places", pa.list_(pa.int64()))]))

    @F.arrow_udf("array<struct<term: string, n: long, places: array<long>>>")
    def grouped(texts: pa.Array) -> pa.Array:
        out = [_places(texts.slice(lo, 512), first) for lo in range(0, len(texts), 512)]
        return pa.concat_arrays([a.cast(kind) for a in out]) if out else pa.array([], kind)

    return grouped(F.coalesce(words, F.array().cast("array<string>")))


def _places(texts: pa.Array, first: int) -> pa.Array:
    """Each list's different words, as lists of (term, n, places)."""
    flat = texts.flatten().dictionary_encode()
    names = flat.dictionary
    code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), size)
    both = row * max(1, len(names)) + code
    order = np.argsort(both, kind="stable")
    starts = np.flatnonzero(np.diff(both[order], prepend=-1))
    ends = np.append(starts[1:], len(order))
    at = (np.arange(len(both)) - np.repeat(np.cumsum(size) - size, size))[order]
    of = order[starts]
    places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)).astype(np.int32)), pa.array(at + first))
    words = pa.StructArray.from_arrays([names.take(pa.array(code[of])), pa.array(ends - starts), places], names=["term", "n", "places"])
    edge = np.searchsorted(row[of], np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), words)


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, n, places, length): the inverted index, a document a row; write it bucketed or partitioned by term.

    A document's words are brought together in its own row: nothing is shuffled.
    """
    all_ = docs.select(key, terms(F.col(text)).alias("_t")).withColumn("length", F.size("_t"))
    each = all_.select(key, "length", F.explode(_counted(F.col("_t"))).alias("w"))
    return each.select("w.term", key, "length", "w.n", F.transform("w.places", lambda p: p.cast("int")).alias("places"))


def _scored(counted: DataFrame, stats: DataFrame, key: str, n_terms: int, k: int) -> DataFrame:
    """The ``k`` best of (key, _len, _n0, ...) by BM25, all terms present; ``stats`` is one row of the corpus."""
    score, hits = F.lit(0.0), counted
    for i in range(n_terms):
        n, d = F.col(f"_n{i}"), F.col(f"_d{i}")
        idf = F.log(F.lit(1.0) + (F.col("_docs") - d + 0.5) / (d + 0.5))
        score = score + idf * n * (K1 + 1) / (n + K1 * (1 - B + B * F.col("_len") / F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(1.0)))
        hits = hits.filter(n > 0)
    return hits.join(F.broadcast(stats)).select(key, score.alias("score")).orderBy(F.desc("score"), key).limit(k)


def _matches(query: str) -> list[str]:
    return list(dict.fromkeys(query.lower().split()))


def bm25(docs: DataFrame, key: str, text: str, query: str, k: int = 20) -> DataFrame:
    """(key, score): the ``k`` best documents that hold all terms of the query; a last ``*`` makes a term a prefix.

    One scan counts the query's terms in each text; for many queries write ``postings`` once and ask ``bm25_of_index``.
    """
    wanted = _matches(query)
    count = lambda q: F.size(F.filter("_t", (lambda x: x.startswith(q[:-1])) if q.endswith("*") else (lambda x: x == q)))
    all_ = docs.select(key, terms(F.col(text)).alias("_t"))
    counted = kept(all_.select(key, F.size("_t").alias("_len"), *(count(q).alias(f"_n{i}") for i, q in enumerate(wanted))), "counted")
    stats = counted.agg(F.count("*").alias("_docs"), F.avg("_len").alias("_mean"), *(F.count_if(F.col(f"_n{i}") > 0).alias(f"_d{i}") for i in range(len(wanted))))
    return _scored(counted, stats, key, len(wanted), k)


def bm25_of_index(index: DataFrame, lengths: DataFrame, key: str, query: str, k: int = 20) -> DataFrame:
    """The same from written postings and (key, length) of all documents: only the query's terms are read."""
    wanted = _matches(query)
    hit = lambda q: F.col("term").startswith(q[:-1]) if q.endswith("*") else F.col("term") == q
    some = hit(wanted[0])
    for q in wanted[1:]:
        some = some | hit(q)
    counted = index.filter(some).groupBy(key).agg(F.max("length").alias("_len"), *(F.coalesce(F.sum(F.when(hit(q), F.col("n"))), F.lit(0)).alias(f"_n{i}") for i, q in enumerate(wanted)))
    found = counted.agg(*(F.count_if(F.col(f"_n{i}") > 0).alias(f"_d{i}") for i in range(len(wanted))))
    stats = lengths.agg(F.count("*").alias("_docs"), F.avg("length").alias("_mean")).join(found)  # one row each
    return _scored(counted, stats, key, len(wanted), k)


def _less(n: int):
    return lambda place: place - n


def phrase_search(index: DataFrame, key: str, phrase: str) -> DataFrame:
    """(key, n): places where the phrase's terms stand one after the other, from the postings."""
    words = phrase.lower().split()
    hits = None
    for i, w in enumerate(words):
        first = F.transform("places", _less(i))
        at = index.filter(F.col("term") == w).select(key, first.alias(f"_p{i}"))
        hits = at if hits is None else hits.join(at, key)
    starts = F.col("_p0")
    for i in range(1, len(words)):
        starts = F.array_intersect(starts, f"_p{i}")
    return hits.select(key, F.size(starts).alias("n")).filter("n > 0")


def segment_label(captions: DataFrame, key: list[str], time: str, text: str, tags: int = 0) -> DataFrame:
    """(key, n, first_text): a segment's number of captions and its first one; with ``tags`` also that many of all captions' most frequent words."""
    label = captions.groupBy(*key).agg(F.count("*").alias("n"), F.min_by(text, F.struct(time, text)).alias("first_text"))
    if not tags:
        return label
    # Captions lie by ranges of (segment, time, text): a segment of any size is in as many tasks as it takes, and of two words the first is the one in the earlier row.
    words = F.filter(terms(F.col(text)), lambda w: (F.length(w) > 2) & ~w.isin(list(STOP_WORDS)))
    ranged = captions.select(*key, time, text).repartitionByRange(*key, time, F.substring(text, 1, PREFIX)).sortWithinPartitions(*key, time, text)
    rows = ranged.select(*key, F.coalesce(words, F.array().cast("array<string>")).alias("_words"), F.monotonically_increasing_id().alias("_row"))
    kinds = T.StructType([*(rows.schema[k] for k in key), *T._parse_datatype_string("tag string, _n long, _row long, _place long").fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.list_value_length(batch.column("_words")).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero(np.diff((np.cumsum(size) - size) // WORDS, prepend=-1, append=-1)) if len(size) else []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield _run_tags(batch.slice(lo, hi - lo), len(key), tags)

    counts = rows.mapInArrow(run, kinds).groupBy(*key, "tag").agg(F.sum("_n").alias("_n"), F.min(F.struct("_row", "_place")).alias("_first"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("_n"), "_first"))
    best = counts.withColumn("_r", place).filter(F.col("_r") <= tags).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_r", "tag"))).alias("_b"))
    return label.join(best, key, "left").withColumn("tags", F.coalesce(F.transform("_b", lambda b: b["tag"]), F.array().cast("array<string>"))).drop("_b")


def _run_tags(batch: pa.RecordBatch, n_keys: int, n: int) -> pa.RecordBatch:
    """(key, tag, n, row, place) of ordered captions' words: a segment that begins and ends inside the batch has its ``n`` most frequent words, the first and the last segment have all, as they may go on elsewhere."""
    texts, at = batch.column("_words"), batch.column("_row").to_numpy()
    begins = np.zeros(len(texts), bool)
    for c in batch.columns[:n_keys]:
        c = pa.array([repr(v) for v in c.to_pylist()]) if pa.types.is_nested(c.type) else pc.add(c, pa.scalar(0, c.type)) if pa.types.is_floating(c.type) else c  # -0.0 is 0.0
        code = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        begins[1:] |= code[1:] != code[:-1]
    segment = np.cumsum(begins)
    flat = texts.flatten().dictionary_encode()
    names = flat.dictionary
    size = pc.list_value_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), size)
    both, first, count = np.unique(segment[row] * max(1, len(names)) + flat.indices.to_numpy(zero_copy_only=False), return_index=True, return_counts=True)
    of, code = both // max(1, len(names)), both % max(1, len(names))
    order = np.lexsort((first, -count, of))
    of, code, first, count = of[order], code[order], first[order], count[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    some = np.flatnonzero((rank < n) | (of == 0) | (of == segment[-1]))
    first, caption = first[some], row[first[some]]
    keys = [c.take(pa.array(caption)) for c in batch.columns[:n_keys]]
    columns = [*keys, names.take(pa.array(code[some])), pa.array(count[some], pa.int64()), pa.array(at[caption]), pa.array(first - (np.cumsum(size) - size)[caption])]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:n_keys], "tag", "_n", "_row", "_place"])


def caption_prompt(captions: DataFrame, key: list[str], time: str, text: str) -> DataFrame:
    """(key, prompt): the captions in order of time, a line each."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(time, text))), lambda s: F.format_string("- t=%.1fs: %s", s[time], s[text]))
    return captions.groupBy(*key).agg(F.array_join(lines, "\n").alias("prompt"))
