"""The registered clusterings train to the end: their labels are those of centres found by brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinoframe import plans
from kinoframe.operators import vectors

from .compare import SF_DIR


def nearest(x, c):
    return ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)


@pytest.fixture(scope="module")
def table(spark):
    """The ids and vectors of the table, and the first centres."""
    e = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = e.select("vec_id", "embedding").collect()
    return e, [r[0] for r in rows], np.array([r[1] for r in rows], np.float64), np.array(vectors.first_centers(e, "vec_id", "embedding", 10))


def test_kmeans_labels(spark, table):
    _, ids, x, c = table
    for _ in range(50):
        at = nearest(x, c)
        new = np.stack([x[at == k].mean(0) if (at == k).any() else c[k] for k in range(len(c))])
        if np.allclose(new, c):
            break
        c = new
    got = {r["vec_id"]: r["center"] for r in plans.QUERIES["kmeans_labels"](spark, SF_DIR).collect()}
    assert [got[i] for i in ids] == nearest(x, c).tolist()


def test_minibatch_labels(spark, table):
    e, ids, x, c = table
    met, at_row = np.zeros(len(c)), {i: k for k, i in enumerate(ids)}
    order = [r[0] for r in e.orderBy(F.xxhash64(F.lit(1), F.col("vec_id")), "vec_id").select("vec_id").collect()]
    drawn = x[[at_row[i] for i in order]]
    for i in range(200):
        sample = drawn[[(i * 256 + k) % len(drawn) for k in range(min(256, len(drawn)))]]
        at = nearest(sample, c)
        for k in np.unique(at):
            m = (at == k).sum()
            met[k] += m
            c[k] += (sample[at == k].sum(0) - m * c[k]) / met[k]
    got = {r["vec_id"]: r["center"] for r in plans.QUERIES["minibatch_labels"](spark, SF_DIR).collect()}
    assert [got[i] for i in ids] == nearest(x, c).tolist()
