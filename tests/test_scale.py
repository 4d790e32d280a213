"""Ranges, trees, neighbours, attempts, estimators and aggregators against brute force, odd rows included."""

import collections
import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kinoframe.functions import estimators
from kinoframe.operators import aggregators, dataset, intervals, motion, publish, ranges, series, vectors
from kinoframe.operators.attempts import AttemptLog, attempt


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small ranges stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def long_rows(spark):
    """One unit of 3,000 rows, some of two or three, one of a null name; (unit, at, value, valid)."""
    rng = random.Random(6)
    rows = [("all", k, round(rng.uniform(-9, 9), 3), rng.random() < 0.01) for k in range(3000)]
    rows += [(u, k, float(k), k == 1) for u in ("b", "c", None) for k in range(3)] + [("d", 0, 1.5, False)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "unit string, at long, value double, valid boolean").repartition(5)


def by_unit(rows):
    units = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r[1]):
        units[r[0]].append(r)
    return units


def test_one_unit_lies_in_many_ranges(spark, long_rows):
    parts = ranges.ranged(long_rows[1], ["unit"], ["at"]).filter("unit = 'all'").groupBy("_range").count().collect()
    assert len(parts) >= 3 and max(r["count"] for r in parts) < 2500


def test_scans_over_ranges(long_rows):
    rows, df = long_rows
    place, total, last, mean, before = {}, {}, {}, {}, {}
    for unit, own in by_unit(rows).items():
        s, held, y, b = 0.0, None, None, None
        for k, (_, at, value, valid) in enumerate(own):
            s, held, y = s + value, value if valid else held, value if y is None else 0.05 * value + 0.95 * y
            place[unit, at], total[unit, at], last[unit, at], mean[unit, at], before[unit, at] = k, s, value if held is None else held, y, b
            b = value
    value_of = lambda got, c: {(r["unit"], r["at"]): r[c] for r in got.collect()}
    assert value_of(ranges.numbered(df, ["unit"], ["at"], "k"), "k") == place
    assert value_of(series.carry_forward(df, "unit", ["at"], "value", F.col("valid"), spread=True), "filled") == last
    assert value_of(ranges.previous(df, ["unit"], ["at"], "value", "b"), "b") == before
    for got, want in ((value_of(series.integrate(df, "unit", ["at"], "value", spread=True), "path"), total), (value_of(series.ema(df, "unit", ["at"], "value", 0.05, spread=True), "ema"), mean)):
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert ranges.numbered(df.limit(0), ["unit"], ["at"]).count() == 0


@pytest.mark.parametrize("seconds", [0.0, 3.0, 40.0, 10_000.0])
def test_windows_over_ranges(spark, seconds):
    rng = random.Random(int(seconds))
    rows = [(u, i, float(s), float(s) + rng.choice([0, 1, 2, 7, 60])) for u, n in (("a", 4000), ("b", 3), ("c", 1)) for i, s in enumerate(sorted(rng.randrange(3000) for _ in range(n)))]
    want = {}
    for unit in "abc":
        begin, number = None, -1
        for _, i, s, e in sorted((r for r in rows if r[0] == unit), key=lambda r: (r[2], r[3], r[1])):
            if begin is None or e - begin > seconds:
                begin, number = s, number + 1
            want[unit, s, e] = number
    df = spark.createDataFrame(rows, "unit string, i long, start double, end double").repartition(4)
    got = intervals.greedy_windows(df, "unit", seconds, spread=True).collect()
    assert len(got) == len(rows) and {(r["unit"], r["start"], r["end"]): r["window"] for r in got} == want


def test_medians_over_ranges(spark):
    rng = random.Random(9)
    rows = [(i, g, None if rng.random() < 0.1 else rng.choice([1.0, 1.0, 2.0, rng.random()])) for i, g in enumerate(rng.choices(["x", "y", None], [20, 1, 1], k=2000))] + [(9000 + i, "same", 4.0) for i in range(500)] + [(9999, "none", None)]
    df = spark.createDataFrame(rows, "i long, g string, v double").repartition(4)
    got = {r["g"]: (r["median"], r["n"]) for r in ranges.median(df, ["g"], "v", ["i"]).collect()}
    for g in ("x", "y", None, "same"):
        own = [v for _, h, v in rows if h == g and v is not None]
        assert got[g] == (float(np.median(own)), len(own))
    assert "none" not in got
    whole = ranges.median(df, [], "v", ["i"]).first()
    assert whole["median"] == float(np.median([v for *_, v in rows if v is not None]))


def test_exact_splits_by_selection(spark):
    import hashlib

    keys = [f"k{i}" for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in [*keys, *keys[:50]]] + [(None,)], "k string")
    place = lambda k: hashlib.md5(f"0:{k}".encode()).hexdigest()
    for fraction in (0.0, 1e-9, 0.1, 0.5, 1.0):
        m = max(1, int(len(keys) * fraction)) if fraction else 0
        got = {r["k"]: r["split"] for r in dataset.exact_split(df, "k", fraction).collect()}
        assert {k for k, s in got.items() if s == "val"} == set(sorted(keys, key=place)[:m]) and set(got) == set(keys)
    plan = dataset.exact_split(df, "k", 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan
    clips = spark.createDataFrame([("p", f"k{i}") for i in range(400)] + [("q", "k1"), ("", "k2"), (None, "k3")], "person_id string, clip_id string")
    got = publish.with_own_split(clips).filter("split = 'val'").collect()
    assert {r["clip_id"] for r in got if r["person_id"] == "p"} == set(sorted((f"k{i}" for i in range(400)), key=place)[:20]) and {r["person_id"] for r in got} == {"p", "q"}


# --- vectors ---------------------------------------------------------------------------------------

ODD = [(900, None), (901, []), (902, [1.0, None]), (903, [float("nan"), 1.0]), (904, [1.0]), (905, [float("inf"), 0.0])]


@pytest.mark.parametrize("rows", [ODD[:1], ODD, [(1, [0.0, 0.0]), *ODD, (2, [5.0, 5.0])]])
def test_centres_of_vectors_that_do_not_fit(spark, rows):
    df = spark.createDataFrame(rows, "id long, v array<double>").coalesce(1)
    got = {r["id"]: (r["center"], r["distance"]) for r in vectors.nearest_center(df, "id", "v", [[0.0, 1.0], [5.0, 5.0]]).collect()}
    assert got == {i: {1: (0, 1.0), 2: (1, 0.0)}.get(i, (None, None)) for i, _ in rows}
    assert len(vectors.kmeans(df, "id", "v", 2)) == min(2, len(vectors.fitting(df, "v").collect()))
    assert vectors.nearest_neighbors(df.withColumn("g", F.lit(1)), "id", "v", "g").count() == (2 if len(rows) > len(ODD) else 0)


def test_neighbours_by_pivots(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 8)) * 40
    x = [*(centres[k % 30] + rng.standard_normal(8) for k in range(2400)), *(rng.standard_normal((300, 8)) * 50), *np.zeros((5, 8)), *np.ones((4, 8))]
    rows = [(i, v.tolist(), 0 if i < 2700 else 1) for i, v in enumerate(x)] + [(5000, [1.0] * 8, 2), (5001, [2.0], 0), *((i + 9000, v, 0) for i, v in ODD)]
    df = spark.createDataFrame(rows, "id long, v array<double>, g int").repartition(4)
    got = {r["id"]: (r["neighbor"], r["distance"]) for r in vectors.nearest_neighbors(df, "id", "v", "g", tile=128).collect()}
    # Vectors of one length are neighbours of each other only.
    odd = {9904: (5001, 1.0), 5001: (9904, 1.0)}
    assert got.keys() == {i for i in range(len(x))} | odd.keys()
    for ids in (range(2700), range(2700, len(x))):
        m = np.array([x[i] for i in ids])
        for k, i in enumerate(ids):
            d = np.sqrt(((m - m[k]) ** 2).sum(1))
            d[k] = np.inf
            assert got[i][0] == ids[int(d.argmin())] and abs(got[i][1] - d.min()) < 1e-9
    assert {i: got[i] for i in odd} == odd


def single_linkage(ids, x, min_gap=1.5):
    """Clusters by Kruskal's way over all pairs."""
    pairs = sorted((float(np.sqrt(((x[a] - x[b]) ** 2).sum())), a, b) for a in range(len(x)) for b in range(a))
    root = list(range(len(x)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    tree = []
    for d, a, b in pairs:
        if find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
            tree.append((d, a, b))
    ratio = [tree[k + 1][0] / max(tree[k][0], 1e-12) for k in range(len(tree) - 1)]
    keep = len(tree) if not ratio or max(ratio) < min_gap else ratio.index(max(ratio)) + 1
    root = list(range(len(x)))
    for _, a, b in tree[:keep]:
        root[max(find(a), find(b))] = min(find(a), find(b))
    names = {r: c for c, r in enumerate(sorted({find(i) for i in range(len(x))}))}
    return {ids[i]: names[find(i)] for i in range(len(x))}


@pytest.mark.parametrize("case", ["blobs", "even", "copies", "one", "none"])
def test_trees(spark, case):
    rng = np.random.default_rng(4)
    x = {"blobs": np.concatenate([rng.standard_normal((40, 3)) + c for c in (0, 60, -80)]), "even": np.arange(60.0)[:, None] ** 1.02, "copies": np.repeat(rng.standard_normal((4, 2)), 30, 0), "one": np.zeros((1, 2)), "none": np.zeros((0, 2))}[case]
    ids = rng.permutation(len(x)).tolist()
    order = np.argsort(ids)
    odd = [(i + 9000, v) for i, v in ODD]
    df = spark.createDataFrame([*zip(ids, x.tolist(), strict=True), *odd], "id long, v array<double>").repartition(3)
    got = {r["id"]: r["cluster"] for r in vectors.spanning_tree_labels(df.filter("id < 9000 OR id <> 9904") if case != "none" else df.filter("id < 9904"), "id", "v", tile=32).collect()}
    want = single_linkage([ids[k] for k in order], x[order])
    assert {i: c for i, c in got.items() if i < 9000} == want
    assert all(c is None for i, c in got.items() if i >= 9000)


def test_registered_tree(spark):
    from kinoframe import plans

    from .compare import SF_DIR

    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    want = single_linkage([r[0] for r in rows], np.array([r[1] for r in rows], np.float64))
    assert {r["vec_id"]: r["cluster"] for r in plans.QUERIES["vector_tree"](spark, SF_DIR).collect()} == want


# --- attempts --------------------------------------------------------------------------------------


def test_attempts(spark):
    def work(i, x):
        if i == 3:
            raise RuntimeError("no\nway")
        return {4: None, 5: {"y": "not a number"}, 6: {"z": 1}, 7: {}, 8: {"y": x, "w": ["a", None]}}.get(i, {"y": x})

    df = spark.createDataFrame([(i, None if i == 9 else float(i)) for i in range(12)] + [(3, 1.0)], "i long, x double")
    got = collections.Counter(tuple(r) for r in df.transform(lambda d: attempt(d, ["i"], ["i", "x"], work, "y double, w array<string>")).withColumn("w", F.to_json("w")).collect())
    done = lambda i, y, w=None: (i, "done", None, y, w)
    assert {g[0]: g for g in got} | {5: None} == {i: done(i, float(i)) for i in (0, 1, 2, 10, 11)} | {3: (3, "failed", "RuntimeError: no\nway", None, None), 4: done(4, None), 5: None, 6: (6, "failed", "KeyError: 'no column z'", None, None), 7: done(7, None), 8: done(8, 8.0, '["a",null]'), 9: done(9, None)}
    assert got[3, "failed", "RuntimeError: no\nway", None, None] == 2
    five = next(g for g in got if g[0] == 5)
    assert five[1] == "failed" and five[2].startswith("Arrow")
    assert attempt(df.limit(0), ["i"], ["i", "x"], work, "y double").count() == 0


def test_attempts_resume(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def failing(bad):
        def work(i):
            calls.add(1)
            if i in bad:
                raise ValueError(str(i))
            return {"y": i * 2}

        return work

    df, log = spark.range(10).withColumnRenamed("id", "i"), AttemptLog(spark, str(tmp_path / "log"), ["i"])
    with pytest.raises(FileNotFoundError):
        log.latest()
    assert log.run(df, ["i"], failing({1, 2, 3}), "y long") == 1 and calls.value == 10
    assert log.run(df, ["i"], failing({3}), "y long") == 2 and calls.value == 13
    assert {r["i"]: (r["status"], r["y"], r["run"], r["tries"]) for r in log.latest().collect()} == {i: ("failed", None, 2, 2) if i == 3 else ("done", 2 * i, 2, 2) if i in (1, 2) else ("done", 2 * i, 1, 1) for i in range(10)}
    assert log.run(df.union(spark.range(20, 22)), ["i"], failing(set()), "y long", most=2) == 3 and calls.value == 15
    assert log.latest().filter("status = 'failed'").count() == 1


# --- table functions and aggregators -------------------------------------------------------------------


def test_estimators(spark):
    df = spark.createDataFrame([("u", 0.0, 1.0), ("u", 4.0, None), ("u", 8.0, 9.0), (None, 1.0, 2.0)], "unit string, at double, value double")
    rows = lambda d: sorted((tuple(r) for r in d.collect()), key=repr)
    assert rows(estimators.estimate(df, "Held")) == sorted([("u", 0, 0.0, 1.0, True), ("u", 1, 4.0, 1.0, False), ("u", 2, 8.0, 9.0, True), (None, 0, 1.0, 2.0, True)], key=repr)
    assert rows(estimators.estimate(df.filter("unit = 'u'"), "linear", fps=0.5)) == [("u", k, 2.0 * k, 1.0 + 2 * k) for k in range(5)]
    for name in ("nothing", ""):
        with pytest.raises(AnalysisException, match="no estimator"):
            estimators.estimate(df, name).schema
    with pytest.raises(AnalysisException, match="fps"):
        estimators.estimate(df, "linear", fps=0).schema
    with pytest.raises(AnalysisException, match="no column"):
        estimators.register(spark)
        df.drop("value").createOrReplaceTempView("short")
        spark.sql("SELECT * FROM estimate_motion(TABLE(short), 'held')").collect()
    assert estimators.estimate(df.limit(0), "held").count() == 0


def test_aggregators(spark):
    rng = random.Random(3)
    words = "alpha beta gamma delta the and ox".split()
    rows = [(rng.choice(["big", "big", "big", "small", None]), i, None if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randrange(6)))) for i in range(900)] + [("none", 1, None)]
    df = spark.createDataFrame(rows, "g string, at long, text string").repartition(7)
    got = {r["g"]: r["tags"] for r in aggregators.aggregated(df, ["g"], "at", "text", "tags", n=3).collect()}
    said = {r["g"]: r["description"] for r in aggregators.aggregated(df, ["g"], "at", "text", "summary", lead="Body:").collect()}
    for g in ("big", "small", None, "none"):
        texts = [t for h, _, t in rows if h == g and t is not None]
        count = collections.Counter(w for t in texts for w in t.split() if len(w) > 2 and w not in ("the", "and"))
        assert got[g] == [w for w, _ in count.most_common(3)]
        assert said[g] == f"Body: {texts[0] if texts else 'empty'} ({len(texts)} frames observed.)"
    with pytest.raises(ValueError, match="no aggregator"):
        aggregators.aggregated(df, ["g"], "at", "text", "sum")
    with pytest.raises(ValueError, match="no captioner"):
        aggregators.captioned(F.col("text"), "x")


def test_pictures_of_several_sizes(spark):
    rng = np.random.default_rng(1)
    rows = []
    for unit, (h, dy, dx) in enumerate(((8, 2, 1), (4, -1, 3), (8, 0, 0))):
        p = rng.standard_normal((h, 8))
        rows += [(unit, 0, p.ravel().tolist()), (unit, 1, np.roll(p, (dy, dx), (0, 1)).ravel().tolist())]
    rows += [(3, 0, [1.0] * 64), (4, 0, None), (4, 1, [1.0] * 64), (5, 0, [1.0] * 8), (5, 1, [1.0] * 16)]
    df = spark.createDataFrame(rows, "unit long, frame int, p array<double>")
    got = {r["unit"]: round(r["shift"], 6) for r in motion.camera_shift(df, "unit", "frame", "p", 8).collect()}
    assert got == {0: round(5**0.5, 6), 1: round(10**0.5, 6), 2: 0.0, 3: 0.0, 4: 0.0, 5: 0.0}


@pytest.mark.parametrize("scale", [1.0, 1e140])
def test_trees_of_tiles(scale):
    """A task's tree out of its tiles' trees is as short as one out of all distances, copies and far numbers too."""
    import pyarrow as pa

    from kinoframe.operators import vectors

    rng = np.random.default_rng(5)
    x = (np.concatenate([np.repeat(rng.standard_normal((4, 3)), 8, 0), rng.integers(0, 5, (30, 3))]) + 70) * scale
    points = pa.table({"_id": pa.array(range(len(x)), pa.int64()), "_x": pa.array(x.tolist(), pa.list_(pa.float64()))})
    want = [d for d, _, _ in shortest([*range(len(x))], x)]
    for tile in (4, 9, 31, 99):
        got = vectors._least_edges(tile)(points)
        assert np.allclose(np.sort(got["d"].to_numpy()) / scale, np.array(want) / scale, rtol=1e-9)


def shortest(nodes, x):
    """The edges (d, a, b) of a least spanning tree, shortest first."""
    near, edges = {k: (float(np.linalg.norm((x[k] - x[0]) / x.max()) * x.max()), 0) for k in nodes[1:]}, []
    while near:
        k = min(near, key=near.get)
        edges.append((near[k][0], near.pop(k)[1], k))
        for o in near:
            near[o] = min(near[o], (float(np.linalg.norm((x[o] - x[k]) / x.max()) * x.max()), k))
    return sorted(edges)
