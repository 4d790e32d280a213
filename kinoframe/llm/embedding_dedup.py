"""Embedding near-dedup by sorted projection passes.

Equal vectors form a class and one of each goes on. In each pass a vector's code is the
signs of its products with random directions, taken from its label's mean, so that a
direction the label shares does not decide them, written one after the other; vectors are
sorted by label and code, and each is compared with the next ``window`` vectors. Pairs
at the threshold are links, of which a pass keeps a forest that spans the same components;
components over all passes are the groups. Inside a group all pairs are then verified,
tile by tile, so the number of links has no cap: the window bounds how groups are found.

The number of passes is measured. The first round has as many as evenly spread vectors
would need for the target recall. Then a query set, ``queries`` vectors chosen by a hash,
is held against all vectors of its labels: labels of which more links than the recall
allows join two groups get twice the passes, and so on, ``ROUNDS`` times. Labels of any size
go through the passes alike. Sorting deals vectors out by range, and neighbours on two sides
of a border don't meet in that pass.

A label of which that recall does not hold after the last round is finished exactly: its
vectors, in the order of the first pass's codes, make tiles, each with its mean direction and
largest angle from it, and two tiles meet unless these and the threshold's angle say by the
triangle inequality that no pair of theirs can be a link.

Defined results: a vector that is null, empty, zero or holds null or non-finite parts, or
has no label, links with nothing; vectors of different length never link; rows that share
an id are one vector, the smallest in order; a null id has no links and a null component.
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

#: Signs in a code; most members of a tile, about; rounds of passes before a label is finished exactly.
SIGNS, TILE, ROUNDS = 48, 1024, 4


def passes_for(threshold: float, recall: float, rows: int, window: int) -> int:
    """Passes that find a pair at the threshold with probability ``recall`` among ``rows`` evenly spread vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    meet = agree ** max(1.0, math.log2(max(2, rows) / window))
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def _rows(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _groups(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of each label and length, the first two columns, ``size`` at a time."""
    keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)], 1)
    for key in np.unique(keys, axis=0):
        part = batch.filter(pa.array((keys == key).all(1)))
        for lo in range(0, len(part), size):
            yield part.slice(lo, size)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sum of the unit vectors of each label and length in a task."""
    sums: dict[tuple, list] = {}
    for batch in batches:
        for rows in _groups(batch, 4096):
            x = _unit(_rows(rows.column(2)))
            one = sums.setdefault((rows.column(0)[0].as_py(), rows.column(1)[0].as_py()), [0, 0])
            one[0] += len(x)
            one[1] = one[1] + x.sum(0)
    for (label, dims), (n, total) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([label], pa.int64()), pa.array([dims], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["label", "dims", "n", "total"])


def _mean(table: pa.Table) -> pa.Table:
    """The rows of ``_sums`` of one label and length, one from each task, as its number and mean."""
    n = sum(table.column("n").to_pylist())
    mean = _rows(table.column("total")).sum(0) / n
    return pa.table({"label": table.column("label").slice(0, 1), "dims": table.column("dims").slice(0, 1), "n": pa.array([n], pa.int64()), "centre": pa.array([mean.tolist()], pa.list_(pa.float64()))})


def _codes(first: int, last: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _groups(batch, 2048):
                d = rows.column(1)[0].as_py()
                x = _unit(_rows(rows.column(3))) - _rows(rows.column(4).slice(0, 1))
                for p in range(first, last):
                    directions = np.random.default_rng([seed, p, d]).standard_normal((d, SIGNS))
                    code = (x @ directions > 0) @ (1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p, np.int32)), *rows.columns[:2], pa.array(code), *rows.columns[2:4]], names=["pass", "label", "dims", "code", "vec_id", "vector"])

    return run


def _neighbours(threshold: float, window: int):
    """A forest of the links within the window in sorted rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}
        held: tuple | None = None

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                rows = batch.slice(lo, 4096)
                group = np.stack([rows.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1, 2)], 1)
                ids, dims = rows.column(4).to_numpy(zero_copy_only=False), group[:, 2]
                x = np.zeros((len(ids), int(dims.max())))
                for d in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == d)
                    x[at, :d] = _unit(_rows(rows.column(5).take(pa.array(at))))
                if held is None or held[2].shape[1] != x.shape[1]:
                    held = (group[:0], ids[:0], x[:0])
                first = len(held[1])
                group, ids, x = np.r_[held[0], group], np.r_[held[1], ids], np.r_[held[2], x]
                a, b = [], []
                for w in range(1, min(window, len(ids) - 1) + 1):
                    lo_ = max(0, first - w)
                    cos = np.einsum("ij,ij->i", x[lo_:-w], x[lo_ + w :])
                    hit = np.flatnonzero((cos >= threshold) & (group[lo_:-w] == group[lo_ + w :]).all(1)) + lo_
                    a += ids[hit].tolist()
                    b += ids[hit + w].tolist()
                tree = []
                for i, j in zip(a, b, strict=True):
                    p, q = find(i), find(j)
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        tree.append((i, j))
                if tree:
                    yield pa.RecordBatch.from_arrays([pa.array([t[k] for t in tree], pa.int64()) for k in (0, 1)], names=["a", "b"])
                held = (group[-window:], ids[-window:], x[-window:])
                if len(root) > 1_000_000:  # a larger forest, the same components
                    root = {}

    return run


def _tile(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        side, ids, copies = (table.column(c).to_numpy() for c in ("side", "vec_id", "copies"))
        x = _unit(_rows(table.column("vector")))
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        links = (x[left] @ x[right].T >= threshold) & (ids[left][:, None] != ids[right][None, :])
        out_ids, n = ids[left], links @ copies[right]
        if not (side == 2).all():
            out_ids, n = np.r_[out_ids, ids[right]], np.r_[n, links.T @ copies[left]]
        return pa.table({"vec_id": pa.array(out_ids, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def _tile_forest(threshold: float):
    """For each vector with links in the tile, the smallest one they reach."""

    def run(table: pa.Table) -> pa.Table:
        ids, x = table.column("vec_id").to_numpy(), _unit(_rows(table.column("vector")))
        order = np.argsort(ids)
        ids, x = ids[order], x[order]
        links, low, before = x @ x.T >= threshold, np.arange(len(ids)), None
        np.fill_diagonal(links, True)
        while before is None or (low != before).any():
            before = low
            low = np.where(links, low[None, :], len(ids)).min(1)
        at = np.flatnonzero(low != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[at], pa.int64()), "b": pa.array(ids[low[at]], pa.int64())})

    return run


def _lost(threshold: float, queries: list):
    """Links of the query set, and those among them that join two groups."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[tuple, list] = {}
        for label, dims, *one in queries:
            asked.setdefault((label, dims), []).append(one)
        held = {k: (np.array([o[0] for o in v]), np.array([o[1] for o in v]), _unit(np.array([o[2] for o in v], np.float64))) for k, v in asked.items()}
        for batch in batches:
            for rows in _groups(batch, 2048):
                key = (rows.column(0)[0].as_py(), rows.column(1)[0].as_py())
                if key not in held:
                    continue
                ids, groups, q = held[key]
                links = _unit(_rows(rows.column(4))) @ q.T >= threshold
                links &= rows.column(2).to_numpy()[:, None] != ids[None, :]
                apart = links & (rows.column(3).to_numpy()[:, None] != groups[None, :])
                yield pa.RecordBatch.from_arrays([*(c.slice(0, 1) for c in rows.columns[:2]), pa.array([int(links.sum())], pa.int64()), pa.array([int(apart.sum())], pa.int64())], names=["label", "dims", "links", "lost"])

    return run


def _met(rows: DataFrame, by: list[str], tiles: DataFrame) -> DataFrame:
    """``rows`` dealt into ``tiles`` of each group ``by``, every two of which meet once: side 0, 1, or 2 for a tile with itself."""
    dealt = rows.join(tiles, by).withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.col("tiles")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    side = F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1)
    return dealt.select(*by, F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), side.alias("side"), "vec_id", "copies", "vector")


def _balls(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in tiles of ``TILE`` at most, numbered in the task, with each tile's mean direction and largest angle from it."""
    tile = -1
    for batch in batches:
        for rows in _groups(batch, TILE):
            tile += 1
            x = _unit(_rows(rows.column(5)))
            mean = x.sum(0)
            length = np.sqrt(mean @ mean)
            mean = mean / length if length > 0 else np.eye(1, x.shape[1])[0]
            radius = float(np.arccos(np.clip((x @ mean).min(), -1, 1)))
            n = len(rows)
            extra = [pa.array(np.full(n, tile, np.int64)), pa.array([mean.tolist()] + [None] * (n - 1), pa.list_(pa.float64())), pa.array(np.full(n, radius))]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(4), rows.column(5), *extra], names=["label", "dims", "vec_id", "vector", "tile", "mean", "radius"])


def _exact_links(coded: DataFrame, threshold: float) -> DataFrame:
    """(a, b) that span the same components as all links of the rows of one pass, by tiles that may hold links with each other."""
    key, kind = ["label", "dims"], dict(coded.dtypes)["vector"]
    order = [*key, "code", "vec_id"]
    rows = coded.select(*key, F.lit(0).alias("_"), "code", "vec_id", "vector")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_balls, f"label long, dims int, vec_id long, vector {kind}, tile long, mean array<double>, radius double")
    rows = written(rows.withColumn("tile", F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("tile")), "tiles")
    balls = rows.filter("mean IS NOT NULL").select(*key, "tile", "mean", "radius")
    other = balls.select(*key, F.col("tile").alias("t2"), F.col("mean").alias("m2"), F.col("radius").alias("r2"))
    cosine = F.aggregate(F.zip_with("mean", "m2", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    # A row for each tile on both sides: the square of the label's size over TILE.
    pairs = balls.join(other, key).filter(F.col("tile") <= F.col("t2")).filter(apart <= F.col("radius") + F.col("r2") + math.acos(threshold) + 1e-6)
    pairs = pairs.select(*key, F.col("tile").alias("t1"), "t2")
    sides = pairs.select(*key, F.col("t1").alias("tile"), "t1", "t2").unionByName(pairs.filter("t1 < t2").select(*key, F.col("t2").alias("tile"), "t1", "t2"))
    met = rows.select(*key, "tile", "vec_id", "vector").join(sides, [*key, "tile"])
    return met.groupBy(*key, "t1", "t2").applyInArrow(_tile_forest(threshold), "a long, b long")


def _found_groups(reps: DataFrame, threshold: float, window: int, recall: float, queries: int, seed: int) -> DataFrame:
    """(node, component) of vectors with links, by rounds of passes until the query set's recall holds."""
    key = ["label", "dims"]
    sums = reps.select(*key, "vector").mapInArrow(_sums, "label long, dims int, n long, total array<double>")
    labels = written(sums.groupBy(*key).applyInArrow(_mean, "label long, dims int, n long, centre array<double>"), "centres")
    asked = reps.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(queries).select(*key, "vec_id", "vector")
    asked = written(asked, "queries")
    order = ["pass", *key, "code", "vec_id"]
    first, grouped = 0, None
    # The largest label's size; one number.
    passes = passes_for(threshold, recall, labels.agg(F.max("n")).first()[0] or 1, window)
    coded_as = f"pass int, label long, dims int, code long, vec_id long, vector {dict(reps.dtypes)['vector']}"

    def coded(low: int, high: int) -> DataFrame:
        return reps.join(labels, key).select(*key, "vec_id", "vector", "centre").mapInArrow(_codes(low, high, seed), coded_as)

    for number in range(ROUNDS + 1):
        if number < ROUNDS:
            near = coded(first, passes).repartitionByRange(*order).sortWithinPartitions(*order)
            links = near.mapInArrow(_neighbours(threshold, window), "a long, b long")
        else:
            links = _exact_links(coded(0, 1), threshold)
        if grouped is not None:
            links = links.unionByName(grouped.select(F.col("node").alias("a"), F.col("component").alias("b")))
        grouped = written(components(written(links, "vector-links")), "vector-groups")
        if number == ROUNDS:
            break
        group = F.coalesce("component", "vec_id").alias("group")
        known = lambda rows: rows.join(grouped, F.col("vec_id") == F.col("node"), "left").select(*key, "vec_id", group, "vector")
        held = [tuple(r) for r in known(asked.join(labels.select(*key), key)).collect()]  # the query set
        counted = known(reps.join(labels.select(*key), key)).mapInArrow(_lost(threshold, held), "label long, dims int, links long, lost long")
        counted = counted.groupBy(*key).agg(F.sum("links").alias("links"), F.sum("lost").alias("lost"))
        labels = written(labels.join(counted.filter(F.col("lost") > (1 - recall) * F.col("links")).select(*key), key), "centres")
        if not labels.limit(1).count():
            break
        first, passes = passes, 2 * passes
    return grouped


def near_duplicate_vectors(vectors: DataFrame, *, threshold: float = 0.93, window: int = 32, recall: float = 0.999, queries: int = 8192, seed: int = 7, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row for each vector: vec_id, n_links (others linked directly), component_id (the
    smallest id reachable by links) and kept, the one of each component with that id.
    """
    # Single precision stays as it is until products are taken, in double precision.
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("vector"), F.col(label).cast("long").alias("label"))
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fit = every.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(~bad & F.exists("vector", lambda v: v != 0))
    fit = fit.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("s")).select("vec_id", "s.*")
    fit = written(fit.withColumn("dims", F.size("vector")), "vectors")
    key = [F.col("label"), F.xxhash64("vector").alias("h1"), F.xxhash64(F.reverse("vector")).alias("h2"), F.col("dims")]
    classes = written(fit.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    reps = written(fit.join(classes.select(F.col("rep").alias("vec_id"), "copies"), "vec_id"), "classes")

    grouped = _found_groups(reps, threshold, window, recall, queries, seed)

    inside = reps.join(grouped, F.col("vec_id") == F.col("node")).drop("node")
    tiles = grouped.groupBy("component").agg(tiles_of(F.count("*"), TILE, 20).alias("tiles"))
    met = _met(inside, ["component"], tiles)
    counts = met.groupBy("component", "t1", "t2").applyInArrow(_tile(threshold), "vec_id long, n long").groupBy(F.col("vec_id").alias("rep")).agg(F.sum("n").alias("n"))
    # What holds for a class is joined once, and only then dealt to its members.
    names = ["label", "h1", "h2", "dims"]
    found = classes.join(counts, "rep", "left").join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select(*names, "copies", F.coalesce("component", "rep").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    dealt, found = salted(fit.select("vec_id", *key), written(found, "class-links"), names, "vec_id", count="copies")
    found = dealt.join(found, [*names, "_salt"]).select("vec_id", "component_id", "n_links")
    out = every.select("vec_id").join(found, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
