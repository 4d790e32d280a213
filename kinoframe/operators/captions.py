"""Segments, their labels, and the frames looked at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = ["video_id", "seg_index"]


def labelled(segments: DataFrame, labels: DataFrame, key: list[str] = SEGMENT) -> DataFrame:
    """Segments with their labels; one without a label is left out."""
    return segments.join(labels, key)


def unlabelled(segments: DataFrame, labels: DataFrame, key: list[str] = SEGMENT) -> DataFrame:
    """Segments that have no label yet: where a job goes on."""
    return segments.join(labels.select(*key), key, "left_anti")


def distinct_counts(df: DataFrame, **columns: Column) -> DataFrame:
    """One row: how many different values each column has."""
    return df.agg(*(F.count_distinct(c).alias(n) for n, c in columns.items()))


def evenly_spaced(n: Column, most: int) -> Column:
    """Places of ``most`` evenly spaced ones of ``n``, or all of fewer, the first and the last among them; none of none."""
    m = F.least(F.lit(most), n).cast("int")
    at = lambda i: F.floor(i * (n - 1) / (m - 1)).cast("long")
    return F.when(m <= 0, F.array().cast("array<long>")).when(m == 1, F.array(F.lit(0).cast("long"))).otherwise(F.transform(F.sequence(F.lit(0), m - 1), at))
