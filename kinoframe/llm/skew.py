"""Joins on keys of which a few hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than 1/SHARE of the counted rows is split; so at most SHARE keys are.
SHARE = 2048


def salted(left: DataFrame, right: DataFrame, on: list[str], spread: str, *, count: str = "n") -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``_salt`` to join on beside ``on``.

    ``right`` is a written table with about one row for each key and its rows on the left,
    ``count``. A key with more than 1/SHARE of all counted rows gets as many salts as it
    has such shares: the left's rows are dealt among them by the column ``spread``, the
    right's row is there for each. Split keys are SHARE at most, so they are broadcast.
    """
    total = right.agg(F.sum(count)).first()[0] or 0  # one number
    most = max(1, total // SHARE)
    salts = F.ceil(F.col(count) / F.lit(most)).cast("int")
    hot = right.filter(F.col(count) > most).select(*(F.col(c).alias(f"_{c}") for c in on), salts.alias("_salts")).distinct()
    same = None
    for c in on:
        one = F.col(c) == F.col(f"_{c}")
        same = one if same is None else same & one
    dealt = left.join(F.broadcast(hot), same, "left").drop(*(f"_{c}" for c in on))
    dealt = dealt.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    again = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col(count) > most, salts - 1).otherwise(0))))
    return dealt, again


def tiles_of(members: Column, most: int, parts: int = 8) -> Column:
    """Tiles into which a group's members are dealt, every two of which meet in a task: about ``parts``
    of 64 members or more, so that one group is work for many tasks, and as many of ``most`` as it takes.
    """
    size = F.least(F.lit(most), F.greatest(F.lit(64), F.ceil(members / F.lit(parts))))
    return F.ceil(members / size).cast("int")
