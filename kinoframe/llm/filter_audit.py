"""Interaction of five filters: what each removes in every order in which they may be applied.

The fifth filter asks for exact duplicates. They are found by partition refinement: documents
are split by their length in code points, the parts by the hash of the texts' first block, then
of the second, and so on, each block ``GROWTH`` times the one before and the last as long as the
text; a part of one document is dropped as soon as it appears. Full texts are compared only in
the parts that are left, by grouping on them, and all but the smallest id of a text are marked.

A document then is a mask of five bits. Masks are counted in each part of the table, and all
120 orders are worked out from these counts, 32 at most for each part.

Refinement works on narrow rows (id, length, hashes); parts with many members are counted before
they are shuffled and split among tasks where members are joined to them. Full texts are read a
second time for what is left: against the hashes of the parts left where these fit in
``BROADCAST_ROWS`` rows, else by a shuffle, which Spark's run-time Bloom filter thins out.

Defined results: a null text is empty; a null lang is the part ""; a null doc_id is no smaller
id, has none and no labels, so it is no duplicate; rows that share id and text are no duplicates of each
other and count one by one; a document with several rows in ``labels`` is good or toxic if one
says so; an empty table gives no rows. Only doc_id, text and lang are read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import salted
from .storage import dropped, written

FILTERS = "ABCDE"
#: Bit of each filter in a mask.
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
#: Code points of the first block, growth of the next ones, number of blocks; the last takes the rest.
FIRST, GROWTH, BLOCKS = 64, 16, 3
#: Most parts whose hashes are sent to every task.
BROADCAST_ROWS = 1 << 20
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def word_filters(text: Column) -> Column:
    """Mask of the four filters that look at a text alone, A to D."""
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    n = F.size(words)
    fails = {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    mask = F.lit(0)
    for name, failed in fails.items():
        mask = mask + F.when(failed, BIT[name]).otherwise(0)
    return mask


def block_hashes(text: Column) -> list[Column]:
    """Hashes of a text's successive blocks, b1, b2 and so on."""
    out, at, size = [], 1, FIRST
    for k in range(1, BLOCKS + 1):
        block = F.substring(text, at, size if k < BLOCKS else F.lit(2**31 - 1))
        out.append(F.xxhash64(block).alias(f"b{k}"))
        at, size = at + size, size * GROWTH
    return out


def _refined(rows: DataFrame) -> DataFrame:
    """The rows of (doc_id, length, b1 ..) of which others have the same length and hashes, and how many, ``n``."""
    keys, left, old = ["length"], rows, None
    for k in range(BLOCKS + 1):
        parts = written(left.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1"), "parts")
        a, b = salted(left.drop("n"), parts, keys, "doc_id")
        left = written(a.join(b, [*keys, "_salt"]).drop("_salt"), "refined")
        dropped(parts, *([old] if old is not None else []))
        old = left
        keys = [*keys, f"b{k + 1}"]
    return left


def duplicates(docs: DataFrame, narrow: DataFrame | None = None) -> DataFrame:
    """(doc_id, length, b1 ..) of documents whose text stands under a smaller doc_id; for each id and text once.

    ``docs`` holds doc_id and text, not null; ``narrow`` is the same with lengths and hashes.
    """
    rows = docs.select("doc_id", F.length("text").alias("length"), *block_hashes(F.col("text")), "text").filter("doc_id IS NOT NULL")
    keys = ["length", *(f"b{k}" for k in range(1, BLOCKS + 1))]
    narrow = rows.drop("text") if narrow is None else narrow.filter("doc_id IS NOT NULL").select("doc_id", *keys)
    left = _refined(narrow)
    parts = written(left.groupBy(*keys).agg(F.first("n").alias("n")), "parts")
    if parts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        texts = rows.join(F.broadcast(parts.drop("n")), keys, "left_semi")
    else:
        a, b = salted(rows, parts, keys, "doc_id")
        texts = a.join(b.drop("n"), [*keys, "_salt"]).drop("_salt")
    least = texts.groupBy(*keys, "text").agg(F.min("doc_id").alias("doc_id")).drop("text")
    return left.drop("n").distinct().join(least, ["doc_id", *keys], "left_anti")


def audit(masks: DataFrame) -> DataFrame:
    """The report over (part, mask, n, good, toxic), numbers of documents for each part and mask.

    One row for each part, order and step; every part has all of them, with zeros.
    """
    bits = F.create_map(*(F.lit(x) for pair in BIT.items() for x in pair))
    bit = lambda letter: bits[letter]
    letters = F.split("filter_order", "")
    before = F.aggregate(F.slice(letters, 1, F.col("step") - 1), F.lit(0), lambda sum_, x: sum_ + bit(x))
    # 32 masks at most in a part, 600 steps for each.
    steps = masks.select("*", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.withColumn("bit", bit(F.element_at(letters, F.col("step")))).withColumn("before", before)
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda when, x="n": F.sum(F.when(when, F.col(x)).otherwise(0)).cast("long")
    rows = steps.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
    )
    shapley = rows.groupBy("part", "bit").agg(F.sum("removed").cast("long").alias("shapley"))
    return rows.join(shapley, ["part", "bit"]).drop("bit")


def filter_audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row for each part (lang), filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    whole = F.coalesce(F.col(text), F.lit(""))
    every = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("part"), whole.alias("text"))
    keys = ["length", *(f"b{k}" for k in range(1, BLOCKS + 1))]
    narrow = written(every.select("doc_id", "part", word_filters(F.col("text")).alias("mask"), F.length("text").alias("length"), *block_hashes(F.col("text"))), "audit")
    copies = duplicates(every.select("doc_id", "text"), narrow).select("doc_id", *keys, F.lit(BIT["E"]).alias("e"))
    says = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    rows = narrow.join(copies, ["doc_id", *keys], "left").join(marks, "doc_id", "left")
    mask = (F.col("mask") + F.coalesce("e", F.lit(0))).alias("mask")
    of = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
    counts = rows.groupBy("part", mask).agg(F.count("*").alias("n"), of("good"), of("toxic"))
    return audit(counts)
