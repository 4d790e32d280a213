"""Search expressions over a written index: all, any, not, near, phrases, prefixes, columns.

An expression is built of objects: ``All(Word("license"), Not(Phrase("all rights")))``. It reads the
postings of its words alone, out of the buckets they lie in, brings those of a document together and is a
column over them; documents are ranked by BM25 over the words that the expression asks for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import terms
from .search import B, K1, _counted

#: Places of a column's words are its number times this and their own.
SPAN = 1 << 40
#: Buckets by which written postings are partitioned.
BUCKETS = 64


@dataclass(frozen=True)
class Word:
    """A word, or with a last ``*`` all words that begin so."""

    word: str


@dataclass(frozen=True)
class Phrase:
    """Words one after the other."""

    words: str


@dataclass(frozen=True)
class Near:
    """Two words of one column with at most ``most`` words between them, in any order."""

    one: str
    other: str
    most: int = 10


@dataclass(frozen=True)
class In:
    """An expression in one column only."""

    column: str
    inner: Expression


@dataclass(frozen=True, init=False)
class All:
    parts: tuple[Expression, ...]

    def __init__(self, *parts: Expression):
        object.__setattr__(self, "parts", parts)


@dataclass(frozen=True, init=False)
class Any:
    parts: tuple[Expression, ...]

    def __init__(self, *parts: Expression):
        object.__setattr__(self, "parts", parts)


@dataclass(frozen=True)
class Not:
    inner: Expression


Expression = Word | Phrase | Near | In | All | Any | Not
#: A word in a column; None is any column.
Atom = tuple[str | None, str]


def atoms(e: Expression, column: str | None = None, asked: bool = True) -> Iterator[tuple[Atom, bool]]:
    """The words of an expression with their columns, and whether it asks for them."""
    if isinstance(e, Word):
        yield (column, e.word.lower()), asked
    elif isinstance(e, Phrase):
        for w in e.words.lower().split():
            yield (column, w), asked
    elif isinstance(e, Near):
        yield (column, e.one.lower()), asked
        yield (column, e.other.lower()), asked
    elif isinstance(e, In):
        yield from atoms(e.inner, e.column, asked)
    elif isinstance(e, Not):
        yield from atoms(e.inner, column, not asked)
    else:
        for part in e.parts:
            yield from atoms(part, column, asked)


def _positive(e: Expression) -> bool:
    """Whether a document without any of the words can't match."""
    if isinstance(e, Not):
        return False
    if isinstance(e, All):
        return any(map(_positive, e.parts))
    if isinstance(e, Any):
        return bool(e.parts) and all(map(_positive, e.parts))
    return _positive(e.inner) if isinstance(e, In) else True


def _shifted(places: Column, by: int) -> Column:
    return F.transform(places, lambda p: p - by)


def _matches(e: Expression, places: dict[Atom, Column], column: str | None = None) -> Column:
    at = lambda w: places[column, w.lower()]
    if isinstance(e, Word):
        return F.size(at(e.word)) > 0
    if isinstance(e, Phrase):
        first, *rest = e.words.split()
        starts = at(first)
        for k, w in enumerate(rest, 1):
            starts = F.array_intersect(starts, _shifted(at(w), k))
        return F.size(starts) > 0
    if isinstance(e, Near):
        # Each of the one's places stands for the span in which the other may be.
        return F.exists(at(e.one), lambda x: F.exists(at(e.other), lambda y: (x != y) & (F.abs(x - y) <= e.most + 1)))
    if isinstance(e, In):
        return _matches(e.inner, places, e.column)
    if isinstance(e, Not):
        return ~_matches(e.inner, places, column)
    out = None
    for part in e.parts:
        one = _matches(part, places, column)
        out = one if out is None else (out & one if isinstance(e, All) else out | one)
    return F.lit(isinstance(e, All)) if out is None else out


def _bucket(term: Column) -> Column:
    # By the first two letters, so that a prefix of two or more lies in one bucket.
    return F.pmod(F.crc32(F.substring(term, 1, 2)), F.lit(BUCKETS)).cast("int")


def write_postings(docs: DataFrame, key: str, columns: list[str], path: str) -> None:
    """``postings`` (term, key, place of its column, n, places) partitioned by bucket, and ``lengths`` (key, length) of all documents."""
    words = [terms(F.col(c)) for c in columns]
    spark = docs.sparkSession
    # A column's words are brought together in their row, those of several columns by the reader.
    every = [_counted(w, k * SPAN) for k, w in enumerate(words)]
    rows = docs.select(key, F.explode(F.concat(*every)).alias("w")).select("w.term", key, "w.n", "w.places").withColumn("bucket", _bucket(F.col("term")))
    # Buckets in parts, about two a task, so that a very frequent word is in several; in a file, row groups without a term are passed over.
    parts = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // BUCKETS)
    dealt = rows.repartition("bucket", F.pmod(F.xxhash64(key), F.lit(parts)))
    dealt.sortWithinPartitions("bucket", "term", key).write.partitionBy("bucket").parquet(f"{path}/postings")
    length = sum((F.coalesce(F.size(w), F.lit(0)) for w in words), F.lit(0))
    docs.select(key, F.greatest(length, F.lit(0)).cast("long").alias("length")).write.parquet(f"{path}/lengths")


def found(index: DataFrame, lengths: DataFrame, key: str, columns: list[str], expression: Expression, k: int | None = None) -> DataFrame:
    """(key, score) of the documents that match, best first if ``k`` are asked for.

    ``columns`` are those of the index, in its order. An expression that documents without any of
    its words would match is an error.
    """
    if not _positive(expression):
        raise ValueError("an expression must ask for a word: Not alone matches what isn't in the index")
    unknown = {c for (c, _), _ in atoms(expression)} - {None, *columns}
    if unknown:
        raise ValueError(f"no column {sorted(unknown)[0]}; there are {', '.join(columns)}")
    asked = dict.fromkeys(a for a, yes in atoms(expression) if yes)
    every = list(dict.fromkeys(a for a, _ in atoms(expression)))
    is_word = lambda w: F.col("term").startswith(w[:-1]) if w.endswith("*") else F.col("term") == w
    some, buckets = F.lit(False), set()
    for w in {w for _, w in every}:
        some = some | is_word(w)
        buckets.add(None if w.endswith("*") and len(w) < 3 else w[:2])
    rows = index.filter(some)
    if None not in buckets:
        spark = index.sparkSession
        numbers = spark.createDataFrame([(b,) for b in sorted(buckets)], "b string").select(_bucket(F.col("b"))).collect()  # one for each word
        rows = rows.filter(F.col("bucket").isin(sorted({r[0] for r in numbers})))

    def inside(column: str | None):
        return (lambda p: F.lit(True)) if column is None else (lambda p: F.floor(p / SPAN) == columns.index(column))

    held = {a: F.filter(F.flatten(F.collect_list(F.when(is_word(a[1]), F.col("places")))), inside(a[0])) for a in every}
    got = rows.groupBy(key).agg(*(c.alias(f"_p{i}") for i, c in enumerate(held.values())))
    places = {a: F.col(f"_p{i}") for i, a in enumerate(every)}
    counted = got.join(lengths, key)
    n = {a: F.size(places[a]) for a in asked}
    stats = lengths.agg(F.count("*").alias("_docs"), F.avg("length").alias("_mean"))
    df = got.agg(*(F.count_if(n[a] > 0).alias(f"_d{i}") for i, a in enumerate(asked)))
    score = F.lit(0.0)
    for i, a in enumerate(asked):
        d = F.col(f"_d{i}")
        idf = F.log(F.lit(1.0) + (F.col("_docs") - d + 0.5) / (d + 0.5))
        score = score + idf * n[a] * (K1 + 1) / (n[a] + K1 * (1 - B + B * F.col("length") / F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(1.0)))
    hits = counted.filter(_matches(expression, places)).join(F.broadcast(stats.join(df))).select(key, score.alias("score"))  # one row of the corpus
    return hits if k is None else hits.orderBy(F.desc("score"), key).limit(k)
