"""Mixing sources to target weights by weighted fair queueing.

Sources share a budget of words by weight, none beyond a multiple of its size. Each
source's documents stand in a shuffled order, all of them, and then stand there again.
A copy's virtual finish time is the words of its source up to its end, divided by the
source's target; the copies of all sources are sorted by that time, and the order is cut
at the budget, inside a document if need be. At time 1 each source has its target, so
that what it gets differs from it by a document at most.

Orders are ranges over many tasks. A running sum adds to a row's place in its range the
sums of the ranges before, of which there is one row for each range (and source).

Defined results: a null text has size 0 and is never taken; a null source is a source
of its own, last in order; rows that share an id count each for themselves; equal rows
are interchangeable, and rows of one id that differ in any column are told apart; an empty table gives no rows. Columns of ``docs`` other than the
id, the text and the source are not read by ``mix_schedule`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) of each (source, source_size): level = the weight's worth at which the budget is used up.

    One row for each source; the sources' order and running sums need them in one task.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.partitionBy(F.lit(0)).orderBy("ratio", "place")
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights)))
    return (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.sum("cap").over(by_ratio) + F.col("cap")) / (F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight")))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything)["level"])
        .withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
        .select("source", "source_size", "target")
    )


def _running(df: DataFrame, group: list[str], order: list[Column | str], value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each in ``order``, in its group (a prefix of the order)."""
    ranged = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*group, "_range").agg(F.sum(value).alias("_s")).withColumn("_s", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    sums = sums.select(*(F.col(g).alias(f"_{g}") for g in group), F.col("_range").alias("_r"), "_s")
    same = F.col("_range") == F.col("_r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    inside = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_i", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, same)
    return summed.withColumn(out, F.col("_s") + F.col("_i")).drop("_range", "_r", "_s", "_i", *(f"_{g}" for g in group))


def mix_schedule(
    docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix", id_col: str = "doc_id", text: str = "text", source: str = "source", by_row: bool = True, tag: Column | None = None
) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken and mix_start, the
    words of the mixture before its first copy (null if it isn't taken).

    ``weights`` go to the sources in order of code points again and again; ``share`` times all
    words is the budget; no target is over ``most`` times its source's size. Without
    ``by_row`` there is a row for each copy taken instead, with its copy and ``tag``, a hash by
    which rows that share an id are told apart.
    """
    if most != int(most) or share > most:
        raise ValueError("most is a whole number, and share not larger")
    sized = written(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source).alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("shuffle"), (F.xxhash64(text) if tag is None else tag).alias("tag"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(source_targets(sources, weights, share, most), "sources").withColumnRenamed("source", "_source")
    # The budget; one row.
    budget = int((sized.agg(F.sum("size")).first()[0] or 0) * share)
    served = _running(sized.filter("size > 0"), ["source"], [F.col("source"), "shuffle", "size", "tag", "row"], "size", "done")
    finish = (F.col("copy") * F.col("source_size") + F.col("done") + F.col("size")) / F.col("target")
    copies = (
        served.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(int(most) - 1))))
        .withColumn("finish", finish)
        .drop("done", "source_size", "target")
    )
    placed = _running(copies, [], ["finish", "source", "shuffle", "copy", "tag", "row"], "size", "mix_start")
    placed = placed.filter(F.col("mix_start") < budget).withColumn("served", F.least("size", F.lit(budget) - F.col("mix_start")))
    if not by_row:
        return placed.select("doc_id", "tag", "row", "copy", "size", "served", "mix_start")
    taken = placed.groupBy(F.col("row").alias("_row")).agg(F.sum("served").alias("taken"), F.min("mix_start").alias("mix_start"))
    return (
        sized.join(taken, F.col("row") == F.col("_row"), "left")
        .join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "mix_start")
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mixture: ``docs`` once for each copy taken, with copy (0 or 1) and mix_start; a copy
    that is cut keeps its first words, joined by single spaces.
    """
    own = [c for c in docs.columns if c not in ("copy", "mix_start")]
    # Rows are told apart by all columns but those with maps in them, which have no hash; what is equal then is one row.
    tag = F.xxhash64(*(F.col(c) for c, kind in docs.select(*own).dtypes if "map<" not in kind))
    taken = mix_schedule(docs, id_col=id_col, text=text, by_row=False, tag=tag, **options)
    plan = taken.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "copy", F.col("served").alias("_served"), F.col("size").alias("_size"), "mix_start")
    left = docs.select(*own).withColumn("_t", tag).dropDuplicates([id_col, "_t"])
    joined = left.join(plan, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_tag")))
    words = F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})")), F.lit(1), F.col("_served").cast("int"))
    cut = F.when(F.col("_served") < F.col("_size"), F.array_join(words, " ")).otherwise(F.col(text))
    return joined.withColumn(text, cut).select(*own, "copy", "mix_start")
