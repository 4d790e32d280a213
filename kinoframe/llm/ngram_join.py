"""N-gram Jaccard join by MinHash banding.

Documents with equal sets of word n-grams form a class, and one of each class goes on.
Its MinHash signature is cut into bands; band and row counts come from the target recall
at the threshold. Classes that share a band's hash are candidates: in a small bucket as
pairs, in a large one as tiles of its members, each tile pair one task's matrix product.
Every candidate is verified on the full n-gram sets, once: at the first large bucket that
holds both, else as a pair. Links are counted for every document, copies included; the
components of the links are the groups of near-duplicates.

Large buckets never list their pairs: a tile returns each member's number of links, and a
forest of links that spans the same components.

Defined results: a text of fewer words than n has one gram, all its words; a null text or
one without words has none and links with nothing; words are runs of other than space and
0x09-0x0D, unchanged; rows that share an id are one document, of the text with the
smallest set hash; a null id has no links and a null group. Further columns are not kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .skew import salted, tiles_of
from .storage import written
from .textblocks import Block, U, blocks, mix, span_hashes

#: Members of a bucket that are listed as pairs; most members of a tile, about.
SMALL, TILE = 12, 1024
#: Grams of a tile, about: some 32 MB.
MOST_GRAMS = 1 << 22


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes that find a pair at the threshold with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _sets(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram) of the distinct grams of each text, in order."""
    words = block.words()
    at, grams = block.grams(words, n)
    text = block.text_of[at]
    short = np.flatnonzero((block.n_words > 0) & (block.n_words < n))
    whole = span_hashes(words, block.first[short], block.first[short + 1])
    text, grams = np.r_[text, short], np.r_[grams, whole]
    order = np.lexsort((grams, text))
    text, grams = text[order], grams[order]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | (grams[1:] != grams[:-1])
    return text[keep], grams[keep]


def _keys(text: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text with grams: where its grams begin, how many they are, and two hashes of the set."""
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(text)])
    out = []
    for seed in (U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)):
        total = np.r_[U(0), np.cumsum(mix(grams ^ seed), dtype=U)]
        out.append(mix(total[first + size] - total[first] + size.astype(U)).view(np.int64))
    return first, size, *out


def _signatures(n: int, bands: int, rows: int):
    seeds = mix(np.arange(1, bands * rows + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                text, grams = _sets(block, n)
                first, size, key1, key2 = _keys(text, grams)
                out = np.empty((len(first), bands), np.int64)
                for b in range(bands):
                    h = np.full(len(first), b, U)
                    for r in range(rows if len(first) else 0):
                        h = mix(h * U(0xA0761D6478BD642F) + np.minimum.reduceat(grams * seeds[b * rows + r], first))
                    out[:, b] = h.view(np.int64)
                arrays = [batch.column(0).slice(lo, hi - lo).take(pa.array(text[first])), pa.array(key1), pa.array(key2), pa.array(size.astype(np.int64))]
                arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, bands, dtype=np.int32)), pa.array(out.ravel())))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key1", "key2", "size", "bands"])

    return run


def _gram_sets(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks(batch.column(1)):
                text, grams = _sets(block, n)
                first, _, key1, key2 = _keys(text, grams)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(text)].astype(np.int32)), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(text[first])), pa.array(key1), pa.array(key2), lists], names=["doc_id", "key1", "key2", "grams"])

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)


def _common(grams: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common grams of each member of ``left`` with each of ``right``: product of their incidence matrices."""
    mine = np.concatenate([grams[at[i] : at[i + 1]] for i in left])
    other = np.concatenate([grams[at[i] : at[i + 1]] for i in right])
    shared = np.intersect1d(mine, other)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(shared):
        return out

    def matrix(values: np.ndarray, members: np.ndarray, lo: int, hi: int) -> np.ndarray:
        member = np.repeat(np.arange(len(members)), at[members + 1] - at[members])
        column = np.searchsorted(shared, values)
        ok = (column >= lo) & (column < hi)
        ok[ok] = shared[column[ok]] == values[ok]
        m = np.zeros((len(members), hi - lo), np.float32)
        m[member[ok], column[ok] - lo] = 1
        return m

    for lo in range(0, len(shared), 4096):
        hi = min(len(shared), lo + 4096)
        out += matrix(mine, left, lo, hi) @ matrix(other, right, lo, hi).T
    return out


def _tiles(threshold: float):
    """Counts of links of each member of a tile pair, and a forest of the links."""

    def run(table: pa.Table) -> pa.Table:
        band = table.column("band")[0].as_py()
        side = table.column("side").to_numpy()
        doc, size, copies, hot = (table.column(c).to_numpy() for c in ("doc_id", "size", "copies", "hot"))
        grams, at = _flat(table.column("grams"))
        bands = _flat(table.column("bands"))[0].reshape(len(doc), -1)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        common = _common(grams, at, left, right)
        links = common >= threshold * (size[left][:, None] + size[right][None, :] - common) - 1e-6
        links &= doc[left][:, None] != doc[right][None, :]
        for b in range(band):  # verified at an earlier large bucket already
            both = ((hot[left] >> b) & 1)[:, None] & ((hot[right] >> b) & 1)[None, :]
            links &= ~((bands[left, b][:, None] == bands[right, b][None, :]) & (both == 1))
        a = [doc[left], links @ copies[right]]
        if (side == 2).all():  # a tile with itself
            ids, n = a
        else:
            ids, n = np.r_[a[0], doc[right]], np.r_[a[1], links.T @ copies[left]]
        tree: list[tuple[int, int]] = []
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i in range(len(left)):
            x = int(doc[left[i]])
            for y in doc[right[np.flatnonzero(links[i])]].tolist():
                p, q = find(x), find(y)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    tree.append((x, y))
        keep = n > 0
        out_a = np.r_[ids[keep], np.array([t[0] for t in tree], np.int64)]
        out_b = np.r_[np.full(int(keep.sum()), -1), np.array([t[1] for t in tree], np.int64)]
        out_n = np.r_[n[keep], np.zeros(len(tree), np.int64)]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64()), "n": pa.array(out_n, pa.int64()), "tree": pa.array(np.r_[np.zeros(int(keep.sum()), bool), np.ones(len(tree), bool)])})

    return run


def near_duplicate_links(docs: DataFrame, *, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, rows: int = 5, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, classes, counts, links): (doc_id, key1, key2) of every document with grams; the classes
    of equal keys (key1, key2, rep, copies); (rep, n) in
    parts of the links of a class to other classes, copies of those counted; (a, b) of links
    between classes that span their components, those of small buckets complete.
    """
    bands = bands_for(threshold, recall, rows)
    if bands > 62:
        raise ValueError("more than 62 bands: lower the rows or the recall")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    signed = source.mapInArrow(_signatures(n, bands, rows), "doc_id long, key1 long, key2 long, size long, bands array<long>")
    signed = signed.groupBy("doc_id").agg(F.min(F.struct("key1", "key2", "size", "bands")).alias("s")).select("doc_id", "s.*")
    signed = written(signed, "signatures")
    classes = written(signed.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "set-classes")
    members = signed.select("doc_id", "key1", "key2")
    reps = signed.join(classes.select(F.col("rep").alias("doc_id"), "copies"), "doc_id")

    dealt = reps.select("doc_id", "size", F.posexplode("bands").alias("band", "bucket"))
    counted = dealt.groupBy("band", "bucket").agg(F.count("*").alias("m"), F.sum("size").alias("weight")).filter("m > 1")
    candidates = written(dealt.drop("size").join(counted, ["band", "bucket"]), "candidates")
    large = F.when(F.col("m") > SMALL, F.expr("shiftleft(1L, band)")).otherwise(F.lit(0).cast("long"))
    wanted = reps.join(candidates.groupBy("doc_id").agg(F.sum(large).alias("hot")), "doc_id")
    texts = source.join(wanted.select("doc_id"), "doc_id", "left_semi")
    sets = texts.mapInArrow(_gram_sets(n), "doc_id long, key1 long, key2 long, grams array<long>").dropDuplicates(["doc_id", "key1", "key2"])
    sets = written(wanted.join(sets, ["doc_id", "key1", "key2"]).drop("key1", "key2"), "gram-sets")

    small = candidates.filter(F.col("m") <= SMALL).groupBy("band", "bucket").agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
    pairs = (
        small.select("ids", F.posexplode("ids").alias("i", "a"))
        .select("a", F.explode(F.slice("ids", F.col("i") + 2, F.size("ids"))).alias("b"))
        .distinct()
    )
    one, two = (sets.select(F.col("doc_id").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in ("size", "copies", "bands", "hot", "grams"))) for k in "ab")
    shared_hot = F.exists(F.arrays_zip("bands_a", "bands_b", F.sequence(F.lit(0), F.lit(bands - 1)).alias("k")), lambda z: (z["bands_a"] == z["bands_b"]) & (F.getbit(F.col("hot_a").bitwiseAND(F.col("hot_b")), z["k"]) == 1))
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    links = (
        pairs.join(one, "a").join(two, "b")
        .filter((F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * F.lit(threshold)) & ~shared_hot)
        .withColumn("common", common)
        .filter(F.col("common") >= F.lit(threshold) * (F.col("size_a") + F.col("size_b") - F.col("common")) - 1e-9)
        .select("a", "b", "copies_a", "copies_b")
    )
    links = written(links, "pair-links")

    # Tiles are bounded by members and by what their sets weigh.
    by_weight = F.least(F.col("m"), F.ceil(F.col("weight") / F.lit(MOST_GRAMS))).cast("int")
    large = candidates.filter(F.col("m") > SMALL).withColumn("tiles", F.greatest(tiles_of(F.col("m"), TILE), by_weight))
    large = large.withColumn("tile", F.pmod(F.xxhash64("doc_id", "band"), F.col("tiles")).cast("int"))
    met = large.select("doc_id", "band", "bucket", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    met = met.select("doc_id", "band", "bucket", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1).alias("side"))
    tiled = (
        met.join(sets, "doc_id")
        .groupBy("band", "bucket", "t1", "t2")
        .applyInArrow(_tiles(threshold), "a long, b long, n long, tree boolean")
    )
    tiled = written(tiled, "tile-links")
    counts = links.select(F.col("a").alias("rep"), F.col("copies_b").alias("n")).unionByName(links.select(F.col("b").alias("rep"), F.col("copies_a").alias("n")))
    counts = counts.unionByName(tiled.filter("NOT tree").select(F.col("a").alias("rep"), "n"))
    return members, classes, counts, links.select("a", "b").unionByName(tiled.filter("tree").select("a", "b"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each document: doc_id, group_id (the smallest id linked with it, directly or
    not), n_links (other documents at the threshold or over it) and kept, one in each group.
    """
    members, classes, counts, links = near_duplicate_links(docs, id_col=id_col, text=text, **options)
    grouped = components(links).withColumnRenamed("node", "rep")
    total = counts.groupBy("rep").agg(F.sum("n").alias("n"))
    # What holds for a class is joined once, and only then dealt to its members.
    found = classes.join(total, "rep", "left").join(grouped, "rep", "left")
    found = found.select("key1", "key2", "copies", F.coalesce("component", "rep").alias("group_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    dealt, found = salted(members, written(found, "class-links"), ["key1", "key2"], "doc_id", count="copies")
    found = dealt.join(found, ["key1", "key2", "_salt"]).select("doc_id", "group_id", "n_links")
    every = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    out = every.join(found, "doc_id", "left")
    group = F.coalesce("group_id", "doc_id")
    return out.select("doc_id", group.alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(group == F.col("doc_id"), F.lit(True)).alias("kept"))
