"""URL filters: a temporal join of captures with dated lists.

Each entry of a list adds a rule or takes it off at a time; ordered by time they become
intervals, from an entry to the next of the same list and rule. A capture meets the
rules of its host, of every domain above it, and of its host and first path segment. The
join on rule and time is as-of: captures and entries of a rule and list are sorted together
by time, and each capture sees the entry before it, whose interval holds it. So a rule
with many intervals costs no more than its entries. Of the rules active, the longest
decides, and of equals a blocking list. Rules that a large part of all captures meet are
split among tasks, each with all of the rule's entries.

Defined results: a null or host-less url has a null host and meets no rule; a null
fetch time meets none; entries of one list, rule and time count in the order remove,
add, so that an add stays; entries with a null are left out; repeated captures give a row
each; empty lists leave every capture without verdict. Columns of ``captures`` beside the
three named are not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import salted
from .storage import written


def url_host(url: Column) -> Column:
    """Host in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def rule_keys(url: Column, host: Column, labels: int) -> Column:
    """Rules of at most ``labels`` labels that may meet the url: the host, the domains above it, and host/first segment."""
    size = F.size(F.split(host, r"\."))
    domains = F.transform(F.sequence(F.lit(1), F.least(size, F.lit(max(1, labels)))), lambda i: F.call_function("substring_index", host, F.lit("."), -i))
    segment = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    with_path = F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(domains, with_path))


def list_intervals(entries: DataFrame) -> DataFrame:
    """(rule, list, blocks, valid_from, valid_to) of entries (list, rule, blocks, adds, at); valid_to is null while a rule stands."""
    order = Window.partitionBy("list", "rule").orderBy("at", "adds")
    return (
        entries.dropna().dropDuplicates(["list", "rule", "at", "adds"])
        .withColumn("valid_to", F.lead("at").over(order))
        .filter("adds AND (valid_to IS NULL OR valid_to > at)")
        .select("rule", "list", "blocks", F.col("at").alias("valid_from"), "valid_to")
    )


def as_of(asked: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows (rule, list, _salt, at, ...) of ``asked`` with the interval that holds ``at``, if there is one: blocks."""
    marks = intervals.select("rule", "list", "_salt", F.col("valid_from").alias("at"), F.struct("blocks", "valid_to").alias("entry"))
    both = asked.withColumn("asks", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    along = Window.partitionBy("rule", "list", "_salt").orderBy("at", F.col("asks").asc_nulls_first())
    seen = both.withColumn("entry", F.last("entry", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return seen.filter("asks AND entry IS NOT NULL AND (entry.valid_to IS NULL OR at < entry.valid_to)").withColumn("blocks", F.col("entry.blocks")).drop("entry", "asks")


def url_verdicts(captures: DataFrame, entries: DataFrame, *, id_col: str = "page_id", url: str = "url", at: str = "fetched") -> DataFrame:
    """One row for each capture: its id, url, host, fetch time, n_active, verdict (block, allow or none) and rule."""
    own = captures.select(F.col(id_col).alias("_id"), F.col(url).alias("_url"), F.col(at).alias("_at")).groupBy("_id", "_url", "_at").agg(F.count("*").alias("_n"))
    own = own.withColumn("host", url_host(F.col("_url")))
    intervals = written(list_intervals(entries), "intervals")
    lists = intervals.groupBy("rule").agg(F.collect_set("list").alias("lists"))
    # One number: no domain of more labels than the longest rule's can meet one.
    labels = intervals.agg(F.max(F.size(F.split("rule", r"\.")))).first()[0] or 1
    asked = own.filter("host IS NOT NULL AND _at IS NOT NULL").select("_id", "_url", F.col("_at").alias("at"), F.explode(rule_keys(F.col("_url"), F.col("host"), labels)).alias("rule"))
    counted = written(asked.groupBy("rule").agg(F.count("*").alias("n")).join(lists, "rule"), "rules-met")
    dealt, rules = salted(asked, counted, ["rule"], "_id")
    spread = intervals.join(rules.select("rule", "_salt"), "rule")
    met = (
        as_of(dealt.join(rules, ["rule", "_salt"]).select("_id", "_url", "at", "rule", "_salt", F.explode("lists").alias("list")), spread)
        .groupBy("_id", "_url", "at")
        .agg(F.count("*").alias("n_active"), F.max(F.struct(F.length("rule").alias("length"), "blocks", "rule")).alias("top"))
        .select(F.col("_id").alias("_i"), F.col("_url").alias("_u"), F.col("at").alias("_a"), "n_active", "top")
    )
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_url") == F.col("_u")) & (F.col("_at") == F.col("_a"))
    verdict = F.when(F.col("top").isNull(), "none").when(F.col("top.blocks"), "block").otherwise("allow")
    return (
        own.join(met, same, "left")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))))
        .select(
            F.col("_id").alias(id_col), F.col("_url").alias(url), "host", F.col("_at").alias(at),
            F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), verdict.alias("verdict"), F.col("top.rule").alias("rule"),
        )
    )
