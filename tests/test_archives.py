"""Archives written and read as a data source; nearest points in a grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinoframe.operators import vectors
from kinoframe.sources import archives


def test_round_trip(spark, tmp_path):
    rows = [(u, f, [float(f), 1.0], [9.0] if u == "b" else None, 30.0, f * 2) for u, n in (("a", 5000), ("b", 2), ("c", 1)) for f in range(n)]
    df = spark.createDataFrame(rows, "unit string, frame int, pose array<float>, left_hand array<float>, fps double, n long").repartition(6)
    path = str(tmp_path / "motion")
    archives.write_archives(df, path)
    assert sorted(p.name for p in (tmp_path / "motion").iterdir()) == ["a.npz", "b.npz", "c.npz"]
    with np.load(tmp_path / "motion" / "a.npz") as d:
        assert set(d.files) == {"pose", "fps", "n"} and d["pose"].dtype == np.float32 and d["pose"].shape == (5000, 2)
    whole = "unit string, frame int, pose array<float>, left_hand array<float>, fps double, n long"
    assert sorted(map(tuple, archives.read_archives(spark, path, whole).collect())) == sorted(rows)
    some = archives.read_archives(spark, path, "n long, unit string").filter("unit <> 'a'")
    assert sorted(map(tuple, some.collect())) == [(0, "b"), (0, "c"), (2, "b")]
    archives.write_archives(df.filter("unit = 'c'").withColumn("unit", F.lit("d")), path)
    assert archives.read_archives(spark, path, "unit string").distinct().count() == 4


def test_other_forms_and_errors(spark, tmp_path):
    np.savez(tmp_path / "x.npz", poses=np.arange(6.0).reshape(3, 1, 2), fps=25.0, frame_of=np.array("global"), betas=np.ones(4))
    got = archives.read_archives(spark, str(tmp_path), "unit string, poses array<double>, fps double, frame_of string, betas array<float>, none array<float>").collect()
    assert sum(r["poses"] == [0.0, 1.0] for r in got) == 1 and len(got) == 3 and {(r["fps"], r["frame_of"], r["none"]) for r in got} == {(25.0, "global", None)}
    df = spark.createDataFrame([("a", 0, [1.0]), ("b", 0, [1.0]), ("a", 1, [1.0])], "unit string, frame int, pose array<float>").coalesce(1)
    spark.dataSource.register(archives.ArchiveSource)
    with pytest.raises(Exception, match="more than one stretch"):
        df.write.format("archive").mode("append").save(str(tmp_path / "new"))
    assert list((tmp_path / "new").iterdir()) == []
    assert archives.read_archives(spark, str(tmp_path / "new"), "unit string").count() == 0


def test_nearest_in_a_grid(spark):
    rng = np.random.default_rng(3)
    points = {"even": rng.uniform(0, 1, (600, 3)), "far": np.concatenate([rng.uniform(0, 1, (50, 3)), rng.uniform(90, 91, (3, 3))]), "flat": np.zeros((4, 3))}
    others = {"even": rng.uniform(0, 1, (500, 3)), "far": rng.uniform(0, 1, (40, 3)), "flat": np.full((1, 3), 2.0)}
    a = spark.createDataFrame([(k, i, *map(float, p), 0.05, 500.0) for k, x in points.items() for i, p in enumerate(x)], "asset string, i long, x double, y double, z double, edge double, _most double")
    b = spark.createDataFrame([(k, *map(float, p)) for k, x in others.items() for p in x], "asset string, x double, y double, z double")
    got = {(r["asset"], r["i"]): r["distance"] for r in vectors.nearest_in_space(a, b, "asset", "i").collect()}
    assert len(got) == sum(map(len, points.values()))
    for k, x in points.items():
        d = np.sqrt(((x[:, None] - others[k][None]) ** 2).sum(2)).min(1)
        assert np.allclose([got[k, i] for i in range(len(x))], d)
