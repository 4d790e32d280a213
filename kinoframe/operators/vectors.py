"""Feature vectors: distances, nearest centres and neighbours, clusterings.

A vector fits if it is not null and all its parts are finite. Others, and those of another length
than the centres, have no centre (null) and no share in one; vectors of different length are no neighbours.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import dropped, kept
from .captions import evenly_spaced
from .ranges import numbered, previous

#: Rows for exact k-means; beyond, small batches are taken.
EXACT_KMEANS = 2000
#: Rows of a group from which pivots are chosen, about; most pivots, and rows for each at least.
SAMPLE, PIVOTS, PER_PIVOT = 1024, 64, 64
#: Shares of points for a spanning tree, whose pairs are tasks, if they come to a tile each.
FEWEST_SHARES = 16


def zscore(df: DataFrame, columns: list[str], group: list[str] | None = None) -> DataFrame:
    """Columns less their mean over their population deviation, 1 where that is under 1e-8; named ``<column>_z``."""
    stats = [x for c in columns for x in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))]
    if group:
        joined = df.join(df.groupBy(*group).agg(*stats), group)
    else:
        joined = df.join(F.broadcast(df.agg(*stats)))  # one row
    z = {f"{c}_z": (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") < 1e-8, 1.0).otherwise(F.col(f"_s_{c}")) for c in columns}
    return joined.withColumns(z).drop(*(f"_{k}_{c}" for c in columns for k in "ms"))


def fitting(df: DataFrame, vector: str, dims: int | None = None) -> DataFrame:
    """The rows whose vector fits, of ``dims`` parts if given."""
    v = F.col(vector)
    fit = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return df.filter(fit if dims is None else fit & (F.size(v) == dims))


def of_usual_length(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector fits and has the most frequent length, of equals the smallest."""
    fit = fitting(df, vector)
    lengths = fit.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return fit.filter(F.size(vector) == (lengths["d"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long vectors that fit as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _fits(column: pa.Array, dims: int) -> np.ndarray:
    """Which vectors of an Arrow column fit and have ``dims`` parts."""
    ok = pc.equal(pc.fill_null(pc.list_value_length(column), -1), dims).to_numpy(zero_copy_only=False).copy()
    at = np.flatnonzero(ok)
    if len(at):
        parts = column.take(pa.array(at)).flatten()
        x = parts.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dims)
        ok[at[~np.isfinite(x).all(1)]] = False
    return ok


def nearest_center(df: DataFrame, key: str, vector: str, centers: list[list[float]]) -> DataFrame:
    """(key, center, distance): the nearest centre by squared distance, of equals the first; nulls for a vector that doesn't fit."""
    c = np.array(centers, np.float64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                ok = _fits(part.column(1), c.shape[1]) if len(c) else np.zeros(part.num_rows, bool)
                at, least = np.zeros(part.num_rows, np.int32), np.zeros(part.num_rows)
                if ok.any():
                    x = _matrix(part.column(1).filter(pa.array(ok)))
                    d = np.stack([((x - row) ** 2).sum(1) for row in c], 1)
                    at[ok] = d.argmin(1)
                    least[ok] = d.min(1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(at, mask=~ok), pa.array(least, mask=~ok)], names=[key, "center", "distance"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(vector).cast("array<double>")).mapInArrow(run, f"`{key}` {kind}, center int, distance double")


def _far_apart(most: int):
    """Pivots of a group's sampled vectors: the first one, then again and again the one farthest from those chosen."""

    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        x = _matrix(table.column("_x"))
        n = table.column("_n")[0].as_py()
        at, near = [0], ((x - x[0]) ** 2).sum(1)
        for _ in range(min(most, max(1, n // PER_PIVOT), len(x)) - 1):
            at.append(int(near.argmax()))
            near = np.minimum(near, ((x - x[at[-1]]) ** 2).sum(1))
        return pa.table({"_g": table.column("_g").slice(0, 1), "_d": table.column("_d").slice(0, 1), "_pivots": pa.array([x[at].tolist()], pa.list_(pa.list_(pa.float64())))})

    return choose


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of two sets of vectors, a few rows at a time so that differences stay small in memory."""
    out = np.empty((len(x), len(y)))
    step = max(1, (1 << 22) // max(1, y.size))
    for lo in range(0, len(x), step):
        out[lo : lo + step] = np.sqrt(((x[lo : lo + step, None, :] - y[None, :, :]) ** 2).sum(2))
    return out


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (_g, _d, _id, _x, _pivots) with the nearest pivot and the distance to it; the pivots go."""
    for batch in batches:
        keys = [batch.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for k in (0, 1)]
        for group in np.unique(np.stack(keys, 1), axis=0):
            rows = batch.filter(pa.array((np.stack(keys, 1) == group).all(1)))
            pivots = np.array(rows.column(4)[0].as_py())
            d = _distances(_matrix(rows.column(3)), pivots)
            at = d.argmin(1)
            yield pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(at)), at])], names=["_g", "_d", "_id", "_x", "_cell", "_r"])


def _best(ids: np.ndarray, x: np.ndarray, others: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest of the others (sorted by id) that isn't itself, of equals the smallest id, and the distance; inf without any."""
    if not len(others):
        return np.zeros(len(ids), np.int64), np.full(len(ids), np.inf)
    d = _distances(x, y)
    d[ids[:, None] == others[None, :]] = np.inf
    at = d.argmin(1)
    return others[at], d[np.arange(len(at)), at]


def nearest_neighbors(df: DataFrame, key: str, vector: str, group: str, tile: int = 1024) -> DataFrame:
    """(key, neighbor, distance): each vector's nearest other of its group, of equals the smallest key.

    A metric index: of each group a sample gives pivots that lie far apart, each vector belongs to its
    nearest pivot's cell, and a cell knows how far its vectors are from the pivot. Cells are dealt into
    tiles. A vector first looks in its own tile; with the distance found there it then asks only the cells
    where the triangle inequality leaves room for a nearer one. So every pair that could be the answer is
    compared, in tasks of bounded size, and how many others are depends on how the vectors cluster.
    """
    rows = fitting(df.select(F.col(group).alias("_g"), F.size(vector).alias("_d"), F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_x")), "_x").filter("_id IS NOT NULL AND _g IS NOT NULL")
    names = ["_g", "_d"]
    head = ", ".join(f"{c} {k}" for c, k in rows.dtypes if c in names)
    sizes = rows.groupBy(*names).agg(F.count("*").alias("_n"))
    sampled = rows.join(sizes, names).filter(F.pmod(F.xxhash64("_id"), F.col("_n")) < SAMPLE)
    # A group of few rows may have none in the sample: its first row is always there.
    first = rows.groupBy(*names).agg(F.min_by(F.struct("_id", "_x"), "_id").alias("s"), F.count("*").alias("_n")).select(*names, "s._id", "s._x", "_n")
    sampled = sampled.unionByName(first).dropDuplicates([*names, "_id"])
    pivots = kept(sampled.groupBy(*names).applyInArrow(_far_apart(PIVOTS), f"{head}, _pivots array<array<double>>"), "pivots")
    placed = kept(rows.join(pivots, names).select(*names, "_id", "_x", "_pivots").mapInArrow(_placed, f"{head}, _id long, _x array<double>, _cell int, _r double"), "cells")
    cells = kept(placed.groupBy(*names, "_cell").agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"), F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("_parts")), "cell-bounds")
    tiled = placed.join(cells.select(*names, "_cell", "_parts"), [*names, "_cell"]).withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_parts")).cast("int")).drop("_parts", "_r")
    # One row for each tile tells its task the group's pivots and the cells' rings, PIVOTS at most.
    rings = cells.groupBy(*names).agg(F.collect_list(F.struct("_cell", "_lo", "_hi")).alias("_rings")).join(pivots, names)
    heads = cells.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(*names, "_cell", "_part").join(rings, names)

    def look(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        told = table.filter(pc.is_valid(table.column("_pivots")))
        table = table.filter(pc.is_valid(table.column("_id")))
        ids, x = table.column("_id").to_numpy(), _matrix(table.column("_x")) if len(table) else np.zeros((0, 1))
        near, d = _best(ids, x, ids, x)
        rings = told.column("_rings")[0].as_py()
        apart = _distances(x, np.array(told.column("_pivots")[0].as_py())) if len(ids) else np.zeros((0, 1))
        ask = []
        for k in range(len(ids)):
            # A hair more than the distance, for rounding.
            reach = d[k] * (1 + 1e-9)
            ask.append([r["_cell"] for r in rings if max(apart[k, r["_cell"]] - r["_hi"], r["_lo"] - apart[k, r["_cell"]]) <= reach])
        found = np.isfinite(d)
        return pa.table({**{c: table.column(c) for c in (*names, "_cell", "_part", "_id", "_x")}, "_near": pa.array(near, mask=~found), "_dist": pa.array(d, mask=~found), "_ask": pa.array(ask, pa.list_(pa.int32()))})

    looked = tiled.unionByName(heads, allowMissingColumns=True).groupBy(*names, "_cell", "_part").applyInArrow(look, f"{head}, _cell int, _part int, _id long, _x array<double>, _near long, _dist double, _ask array<int>")
    looked = kept(looked, "looked")
    asks = looked.select(*names, "_id", F.col("_cell").alias("_c"), F.col("_part").alias("_p"), "_x", F.explode("_ask").alias("_cell")).join(cells.select(*names, "_cell", "_parts"), [*names, "_cell"])
    asks = asks.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).filter(~((F.col("_cell") == F.col("_c")) & (F.col("_part") == F.col("_p"))))
    # A tile that many ask is there for each few thousand of them.
    asked = asks.groupBy(*names, "_cell", "_part").agg(F.ceil(F.count("*") / F.lit(4 * tile)).cast("int").alias("_copies"))
    there = tiled.join(asked, [*names, "_cell", "_part"]).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    come = asks.join(asked, [*names, "_cell", "_part"]).withColumn("_copy", F.pmod(F.xxhash64("_id", "_cell"), F.col("_copies")).cast("int"))
    columns = [*names, "_cell", "_part", "_copy", "_id", "_x"]
    met = there.select(*columns, F.lit(False).alias("_asks")).unionByName(come.select(*columns, F.lit(True).alias("_asks")))

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id")
        asks = table.column("_asks").to_numpy()
        ids, x = table.column("_id").to_numpy(), _matrix(table.column("_x"))
        near, d = _best(ids[asks], x[asks], ids[~asks], x[~asks])
        found = np.isfinite(d)
        return pa.table({"_id": ids[asks][found], "_near": near[found].astype(np.int64), "_dist": d[found]})

    answers = met.groupBy(*names, "_cell", "_part", "_copy").applyInArrow(answer, "_id long, _near long, _dist double")
    every = answers.unionByName(looked.filter("_near IS NOT NULL").select("_id", "_near", "_dist"))
    best = every.groupBy("_id").agg(F.min(F.struct("_dist", "_near")).alias("b"))
    return best.select(F.col("_id").alias(key), F.col("b._near").alias("neighbor"), F.col("b._dist").alias("distance"))


def first_centers(df: DataFrame, key: str, vector: str, k: int, seed: int = 0) -> list[list[float]]:
    """``k`` vectors picked by a hash of their keys: the same ones in every run."""
    rows = fitting(df, vector).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(k).select(F.col(vector).cast("array<double>")).collect()
    return [list(r[0]) for r in rows]


def _sums(df: DataFrame, key: str, vector: str, centers: list[list[float]]) -> dict[int, tuple[np.ndarray, int]]:
    """Sum and count of the vectors of each centre: ``k`` rows from each task."""
    c = np.array(centers, np.float64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros_like(c), np.zeros(len(c), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            at = np.stack([((x - row) ** 2).sum(1) for row in c], 1).argmin(1)
            np.add.at(total, at, x)
            n += np.bincount(at, minlength=len(c))
        for k in np.flatnonzero(n).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([n[k]], pa.int64()), pa.array([total[k].tolist()], pa.list_(pa.float64()))], names=["k", "n", "s"])

    rows = fitting(df, vector, c.shape[1]).select(F.col(vector).cast("array<double>")).mapInArrow(run, "k int, n long, s array<double>")
    dims = len(centers[0])
    added = rows.groupBy("k").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("s", F.lit(i))) for i in range(dims))).alias("s"))
    return {r["k"]: (np.array(r["s"]), r["n"]) for r in added.collect()}  # k rows


def kmeans(df: DataFrame, key: str, vector: str, k: int, iterations: int = 50, seed: int = 0) -> list[list[float]]:
    """Lloyd's centres; a centre without vectors stays where it is. The vectors are written once and read in each round."""
    df = kept(of_usual_length(df.select(key, vector), vector), "vectors")
    centers = first_centers(df, key, vector, k, seed)
    for _ in range(iterations if centers else 0):
        got = _sums(df, key, vector, centers)
        new = [(got[i][0] / got[i][1]).tolist() if i in got else c for i, c in enumerate(centers)]
        if np.allclose(new, centers):
            break
        centers = new
    return centers


def minibatch_kmeans(df: DataFrame, key: str, vector: str, k: int, batch: int = 256, iterations: int = 200, seed: int = 0) -> list[list[float]]:
    """Centres that move towards samples at a rate of one over the vectors each has met.

    All batches come from one pass: rows in the order of a hash of their keys, ``batch`` at a
    time, from the start again when they run out. The driver holds ``batch * iterations`` rows at most.
    """
    drawn = df.orderBy(F.xxhash64(F.lit(seed + 1), F.col(key)), key).limit(batch * iterations).select(F.col(vector).cast("array<double>")).collect()
    rows, centers = np.array([r[0] for r in drawn], np.float64), np.array(first_centers(df, key, vector, k, seed), np.float64)
    if not len(rows):
        return []
    met = np.zeros(len(centers))
    for i in range(iterations):
        x = rows[np.arange(i * batch, i * batch + min(batch, len(rows))) % len(rows)]
        at = np.stack([((x - c) ** 2).sum(1) for c in centers], 1).argmin(1)
        for c in np.unique(at).tolist():
            mine = x[at == c]
            met[c] += len(mine)
            centers[c] += (mine.sum(0) - len(mine) * centers[c]) / met[c]
    return centers.tolist()


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, by a matrix product; those small beside the vectors' lengths are worked out from differences."""
    sizes = (x * x).sum(1)[:, None] + (y * y).sum(1)
    out = x @ y.T
    out *= -2
    out += sizes
    i, k = np.nonzero(out <= 1e-3 * sizes)
    for lo in range(0, len(i), 1 << 16):
        at = i[lo : lo + (1 << 16)], k[lo : lo + (1 << 16)]
        out[at] = ((x[at[0]] - y[at[1]]) ** 2).sum(1)
    return out


def _prim(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of the edges of a least spanning tree, out of all pairs' squared distances."""
    n = len(squares)
    near, link = squares[0].copy(), np.zeros(n, int)
    near[0], waits = np.inf, np.ones(n, bool)
    waits[0], ends = False, np.empty((2, max(0, n - 1)), int)
    for step in range(n - 1):
        at = int(near.argmin())
        if not waits[at]:  # all that wait are infinitely far away
            at = int(waits.argmax())
        ends[:, step] = link[at], at
        waits[at], near[at] = False, np.inf
        closer = squares[at] < near
        closer &= waits
        near[closer], link[closer] = squares[at][closer], at
    return ends[0], ends[1]


def _least(a: np.ndarray, b: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Which edges are in a least spanning forest of ``n`` nodes, by Boruvka's rounds; of equals the first in order."""
    order = np.argsort(d, kind="stable")
    root, kept_, open_ = np.arange(n), np.zeros(len(d), bool), order
    while len(open_):
        p, q = root[a[open_]], root[b[open_]]
        open_, p, q = open_[p != q], p[p != q], q[p != q]
        if not len(open_):
            break
        low, up = np.full(n, len(open_)), np.arange(n)
        # Each component's first edge in order.
        np.minimum.at(low, p, np.arange(len(open_)))
        np.minimum.at(low, q, np.arange(len(open_)))
        mine = np.flatnonzero(low < len(open_))
        kept_[open_[np.unique(low[mine])]] = True
        up[mine] = np.where(p[low[mine]] == mine, q[low[mine]], p[low[mine]])
        back = (up[up] == np.arange(n)) & (np.arange(n) < up)
        up[back] = np.flatnonzero(back)
        while (up[up] != up).any():
            up = up[up]
        root = up[root]
    return kept_


def _least_edges(tile: int):
    """A task's function: the edges of a least spanning tree of its points, made of the trees of every two tiles of them."""

    def made(table: pa.Table) -> pa.Table:
        ids, x = table.column("_id").to_numpy(), _matrix(table.column("_x"))
        order = np.argsort(ids)
        ids, x = ids[order], x[order]
        # Of a size and about a centre that a product is exact in; distances themselves are worked out from the vectors.
        most = float(np.abs(x).max(initial=0.0)) or 1.0
        y = x / most
        y = y - y.mean(0)
        parts, a, b = np.array_split(np.arange(len(x)), max(1, -(-len(x) // tile))), [], []
        own = [_squares(y[p], y[p]) for p in parts] if len(parts) > 1 else []
        for i, k in itertools.combinations(range(len(parts)), 2):
            cross_ = _squares(y[parts[i]], y[parts[k]])
            both = np.concatenate([parts[i], parts[k]])
            one, other = _prim(np.block([[own[i], cross_], [cross_.T, own[k]]]))
            a.append(both[one])
            b.append(both[other])
        if len(parts) == 1:
            one, other = _prim(_squares(y, y))
            a, b = [one], [other]
        one, other = np.unique(np.sort(np.stack([np.concatenate(a), np.concatenate(b)]), axis=0), axis=1)
        d = np.sqrt(((x[one] - x[other]) ** 2).sum(1))
        if len(parts) > 2:
            chosen = _least(one, other, d, len(x))
            one, other, d = one[chosen], other[chosen], d[chosen]
        return pa.table({"a": pa.array(ids[one], pa.int64()), "b": pa.array(ids[other], pa.int64()), "d": pa.array(d, pa.float64())})

    return made


def _joined_up(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels of the nodes (id, root), the edges (a, b, d) of a least spanning forest), by Boruvka's rounds.

    In each round every component takes its least edge to another one, and the components that hang
    together by these become one, their pointers jumping on until all point at roots. Each round
    halves the components at least, and edges inside one go.
    """
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    labels, forest = kept(nodes.select("id", F.col("id").alias("root")), "labels"), None
    open_ = kept(edges.select("a", "b", "d", F.col("a").alias("p"), F.col("b").alias("q")), "edges")
    while open_.limit(1).count():
        both = open_.unionByName(open_.select("a", "b", "d", F.col("q").alias("p"), F.col("p").alias("q")))
        least = kept(both.groupBy("p").agg(F.min(F.struct("d", "a", "b", "q")).alias("e")).select("p", "e.*"), "least")
        taken = least.select("a", "b", "d").distinct()
        forest = taken if forest is None else forest.unionByName(taken)
        # Two that chose each other: the smaller one is the root.
        back = least.select(F.col("p").alias("p2"), F.col("q").alias("q2"))
        up = least.select("p", "q").join(back, F.col("q") == F.col("p2"), "left").select("p", F.when((F.col("q2") == F.col("p")) & (F.col("p") < F.col("q")), F.col("p")).otherwise(F.col("q")).alias("q"))
        moved = True
        while moved:  # twice as far in each jump, two jumps at a time
            for _ in range(2):
                on = up.select(F.col("p").alias("p2"), F.col("q").alias("q2"))
                up = up.join(on, F.col("q") == F.col("p2"), "left").select("p", F.coalesce("q2", "q").alias("q"), (F.col("q") != F.coalesce("q2", "q")).alias("moved"))
            up = kept(up, "pointers")
            moved = up.filter("moved").limit(1).count()
        to = up.select(F.col("p").alias("_p"), F.col("q").alias("_q"))
        labels = labels.join(to, F.col("root") == F.col("_p"), "left").select("id", F.coalesce("_q", "root").alias("root"))
        left = open_.join(to, F.col("p") == F.col("_p"), "left").withColumn("p", F.coalesce("_q", "p")).drop("_p", "_q")
        left = left.join(to, F.col("q") == F.col("_p"), "left").withColumn("q", F.coalesce("_q", "q")).drop("_p", "_q")
        old, open_ = open_, kept(left.filter("p <> q"), "edges")
        dropped(old)
    return labels, edges.limit(0).select("a", "b", "d") if forest is None else forest


def spanning_tree(points: DataFrame, tile: int = 1024) -> DataFrame:
    """(a, b, d): the edges of a least spanning tree of the points (_id, _x).

    Points are dealt into shares, and each two shares' own tree is a task: an edge that isn't in it is no
    shorter than all of a path that is, so these trees together span what all edges span. Of them the whole tree is
    made. A task makes its tree in the same way out of tiles of ``tile`` points, whose distances are one matrix product, so its
    memory is bounded by a share and two tiles; a share is eight tiles, or less where that would leave few tasks.
    """
    n = points.count()
    shares = max(-(-n // (8 * tile)), min(-(-n // tile), FEWEST_SHARES), 1)
    mine = F.pmod(F.xxhash64("_id"), F.lit(shares))
    pairs = points.withColumn("_m", mine).withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    if shares > 1:
        pairs = pairs.filter("_m <> _o")  # a share's own pairs are in its tasks with others
    met = pairs.select(F.least("_m", "_o").alias("t1"), F.greatest("_m", "_o").alias("t2"), "_id", "_x")
    edges = met.groupBy("t1", "t2").applyInArrow(_least_edges(tile), "a long, b long, d double").groupBy("a", "b").agg(F.min("d").alias("d"))
    return _joined_up(kept(edges, "tile-trees"))[1]


def spanning_tree_labels(df: DataFrame, key: str, vector: str, min_gap: float = 1.5, tile: int = 1024) -> DataFrame:
    """(key, cluster): single-linkage clusters, cut where the sorted tree's edges jump most.

    The cut is at the largest ratio of an edge to the one before, if it is ``min_gap`` or more; else there is
    one cluster. Clusters are numbered by their smallest key. Only the gap comes to the driver. Keys
    are whole numbers; vectors that don't fit, or of another length than most, have no cluster (null).
    """
    every = df.select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_x"))
    fit = fitting(every.filter("_id IS NOT NULL"), "_x").groupBy("_id").agg(F.min("_x").alias("_x"))
    points = kept(of_usual_length(fit, "_x"), "points")
    tree = kept(spanning_tree(points, tile), "tree")
    steps = previous(tree, [], ["d", "a", "b"], "d", "_before").filter("_before IS NOT NULL")
    gap = steps.select("d", "_before", (F.col("d") / F.greatest("_before", F.lit(1e-12))).alias("ratio")).orderBy(F.desc("ratio"), "d").first()
    short = tree if gap is None or gap["ratio"] < min_gap else tree.filter(F.col("d") <= gap["_before"])
    joined, _ = _joined_up(short)
    roots = points.select("_id").join(joined, F.col("_id") == F.col("id"), "left").select("_id", F.coalesce("root", "_id").alias("root"))
    roots = kept(roots, "roots")
    names = numbered(roots.groupBy("root").agg(F.min("_id").alias("_least")), [], ["_least"], "cluster").select("root", F.col("cluster").cast("int").alias("cluster"))
    found = roots.join(names, "root").select("_id", "cluster")
    return every.select("_id").join(found, "_id", "left").select(F.col("_id").alias(key), "cluster")


def cluster_labels(df: DataFrame, key: str, vector: str, k: int | None = None, seed: int = 0) -> DataFrame:
    """(key, cluster) by the way that the number of rows allows: a tree without ``k``, Lloyd's means, or small batches."""
    if k is None:
        return spanning_tree_labels(df, key, vector)
    centers = kmeans(df, key, vector, k, seed=seed) if df.count() <= EXACT_KMEANS else minibatch_kmeans(df, key, vector, k, seed=seed)
    return nearest_center(df, key, vector, centers).select(key, F.col("center").alias("cluster"))


def box_scores(vertices: DataFrame, asset: str) -> DataFrame:
    """(asset, up, width, depth, proportion): sorted extents of a mesh and how near height over width is to 3.5."""
    extents = vertices.groupBy(asset).agg(*((F.max(a) - F.min(a)).alias(a) for a in "xyz"))
    order = F.reverse(F.array_sort(F.array("x", "y", "z")))
    out = extents.select(asset, *(F.get(order, F.lit(i)).alias(n) for i, n in enumerate(("up", "width", "depth"))))
    tall = F.col("up") / F.greatest("width", F.lit(1e-9))
    return out.withColumn("proportion", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.abs(tall - 3.5) / 3.5)))


def nearest_in_space(points: DataFrame, others: DataFrame, asset: str, index: str) -> DataFrame:
    """(asset, index, distance) of each point's nearest other one of its asset; rows are (asset, index, x, y, z, edge) and (asset, x, y, z).

    A grid's cells are ``edge`` wide at first, and a point meets the others of its own and the 26 cells
    round it: what is no farther than an edge is the nearest. Points that found nothing so near go on
    with cells twice as wide, until cells are as wide as an asset.
    """
    cell = lambda edge: [F.floor(F.col(a) / edge).cast("long").alias(f"_c{a}") for a in "xyz"]
    near = F.explode(F.array(*(F.struct(*(F.lit(v).alias(a) for v, a in zip(o, "xyz", strict=True))) for o in itertools.product((-1, 0, 1), repeat=3)))).alias("_o")
    # The same edges for both sides: each asset's own.
    edges = points.groupBy(F.col(asset).alias("_a")).agg(F.first("edge").alias("_edge"))
    placed = others.join(edges, F.col(asset) == F.col("_a")).drop("_a")
    waiting, found, wide = points, None, 1
    while True:
        asked = waiting.select(asset, index, *"xyz", "edge", *cell(F.col("edge") * wide)).select("*", near).select(asset, index, *"xyz", "edge", *((F.col(f"_c{a}") + F.col(f"_o.{a}")).alias(f"_c{a}") for a in "xyz"))
        there = placed.select(asset, *(F.col(a).alias(f"_{a}") for a in "xyz"), *cell(F.col("_edge") * wide))
        apart = F.sqrt(sum(((F.col(a) - F.col(f"_{a}")) ** 2 for a in "xyz"), F.lit(0.0)))
        met = asked.join(there, [asset, "_cx", "_cy", "_cz"]).groupBy(asset, index).agg(F.min(apart).alias("distance"))
        known = kept(waiting.join(met, [asset, index], "left"), "grid")
        done = (F.col("distance") <= F.col("edge") * wide) | (F.col("edge") * wide > F.col("_most"))
        new = known.filter(done & F.col("distance").isNotNull()).select(asset, index, "distance")
        found = new if found is None else found.unionByName(new)
        waiting = known.filter(~F.coalesce(done, F.lit(False)) | F.col("distance").isNull()).filter(F.col("edge") * wide <= F.col("_most")).drop("distance")
        if not waiting.limit(1).count():
            return found
        wide *= 2


def symmetry_scores(vertices: DataFrame, asset: str, vid: str, sample: int | None = 800) -> DataFrame:
    """(asset, symmetry): 1 where each vertex has another one at its mirrored place, 0 where the nearest
    is a tenth of the mesh's diagonal away on average.

    The mirror stands across the second longest side, in the median. Of a mesh, ``sample``
    evenly chosen vertices are taken, or all without it, and each looks for the nearest mirrored other in a grid.
    """
    numbered_ = vertices.withColumn("_i", F.row_number().over(Window.partitionBy(asset).orderBy(vid)) - 1)
    mesh = vertices.groupBy(asset).agg(F.count("*").alias("_n"), *(F.median(a).alias(f"_c{a}") for a in "xyz"), *((F.max(a) - F.min(a)).alias(f"_e{a}") for a in "xyz"))
    longest = F.array_sort(F.array(*(F.struct((-F.col(f"_e{a}")).alias("e"), F.lit(-k).alias("k")) for k, a in enumerate("xyz"))))
    diagonal = F.sqrt(F.col("_ex") ** 2 + F.col("_ey") ** 2 + F.col("_ez") ** 2)
    mesh = mesh.withColumn("_axis", -F.get(longest, F.lit(1))["k"]).withColumn("_diagonal", diagonal)
    if sample is not None:
        chosen = mesh.select(asset, F.explode(F.array_distinct(evenly_spaced(F.col("_n"), sample))).alias("_i"))
        numbered_ = numbered_.withColumn("_i", F.col("_i").cast("long")).join(chosen, [asset, "_i"])
    points = kept(numbered_.join(mesh, asset), "points")
    taken = F.col("_n") if sample is None else F.least(F.col("_n"), F.lit(sample))
    edge = F.when(F.col("_diagonal") > 0, F.col("_diagonal") / F.cbrt(taken)).otherwise(1.0)
    turned = [F.when(F.col("_axis") == k, 2 * F.col(f"_c{a}") - F.col(a)).otherwise(F.col(a)).alias(a) for k, a in enumerate("xyz")]
    # Points and their mirrored images lie within three diagonals.
    own = points.select(asset, "_i", *"xyz", edge.alias("edge"), (3 * F.col("_diagonal") + 1.0).alias("_most"))
    near = nearest_in_space(own, points.select(asset, *turned), asset, "_i")
    mean = near.groupBy(asset).agg(F.avg("distance").alias("_d")).join(mesh, asset)
    score = 1 - F.col("_d") / (0.1 * F.when(F.col("_diagonal") > 0, F.col("_diagonal")).otherwise(1.0))
    return mean.select(asset, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("symmetry"))
