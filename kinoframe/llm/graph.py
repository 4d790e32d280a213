"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import dropped, written


def components(links: DataFrame, *, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``: component is the smallest node reachable.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    its smallest one, then its smaller neighbours. Each table of links is written before
    the next step; a node with very many links is split like any skewed join.
    """
    links = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u > v").distinct()
    links = written(links, "links")

    def star(both: DataFrame, larger: bool) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        near = both.join(least, "u")
        near = near.filter("v > u") if larger else near
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not larger:
            out = out.unionByName(least.select("u", F.col("m").alias("v")))
        return out.filter("u > v").distinct()

    before = None
    while True:
        turned = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
        old, links = links, written(star(star(links.unionByName(turned), True), False), "links")
        dropped(old)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
