"""Sinks: datasets, indexes, windows, lists and logs, written by all tasks at once; a folder where one file was."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import utc_text
from ..operators.dataset import dataset_stats
from ..operators.publish import split_lists


def write_motion(frames: DataFrame, path: str) -> None:
    """Motion in its stored form: Parquet, a hand or mask that was never estimated null, not zeros."""
    frames.write.parquet(path)


def write_dataset(entries: DataFrame, frames: DataFrame | None, path: str, order: str = "clip_id") -> None:
    """A dataset's folder: ``index`` by split, ``stats`` of one row as JSON, and ``motion`` by split."""
    entries.write.partitionBy("split").parquet(f"{path}/index")
    dataset_stats(entries, order).coalesce(1).write.json(f"{path}/stats")
    if frames is not None:
        frames.join(entries.select("clip_id", "split"), "clip_id").write.partitionBy("split").parquet(f"{path}/motion")


def write_person_datasets(entries: DataFrame, path: str, person: str = "person_id") -> None:
    """Entries in a folder for each person and split: ``person_id=.../split=...``."""
    entries.write.partitionBy(person, "split").parquet(path)


def write_json_rows(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines: an index of captions, windows, a registry."""
    rows.write.json(path)


def write_registry(people: DataFrame, path: str) -> None:
    """A registry of (person_id, display_name, granted, scope, granted_on, method) as ``read_registry`` reads it: a JSON object of people from each task."""
    have = lambda n: F.col(n) if n in people.columns else F.lit(None).cast("string")
    consent = F.struct(F.col("granted").alias("granted"), have("scope").alias("scope"), have("granted_on").alias("granted_on"), have("method").alias("method"))
    person = F.struct(F.col("person_id").cast("string"), F.struct(have("display_name").alias("display_name"), consent.alias("consent")))
    parts = people.withColumn("_part", F.spark_partition_id()).groupBy("_part").agg(F.map_from_entries(F.collect_list(person)).alias("people"))
    parts.select(F.to_json(F.struct("people")).alias("value")).write.text(path)


def write_search_index(rows: DataFrame, postings: DataFrame, path: str) -> None:
    """Caption rows with their tags as one text, and the postings by term, so that a query reads its terms' files."""
    rows.withColumn("tags", F.array_join("tags", " ")).write.parquet(f"{path}/captions")
    bucket = F.pmod(F.xxhash64("term"), F.lit(64))
    postings.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("term").write.partitionBy("bucket").parquet(f"{path}/postings")


def write_lines(rows: DataFrame, path: str, line: str) -> None:
    """One line of text for each row."""
    rows.select(F.col(line).alias("value")).write.text(path)


def append_events(events: DataFrame, path: str) -> None:
    """Adds events to a log of JSON lines, each with the time it is written, in UTC to the second; what is there stays."""
    stamped = events if "at" in events.columns else events.withColumn("at", utc_text(F.current_timestamp()))
    stamped.write.mode("append").json(path)


def write_split_lists(entries: DataFrame, path: str) -> None:
    """The ids of train, val and test, a folder of text each."""
    split_lists(entries).withColumnRenamed("clip_id", "value").withColumn("value", F.col("value").cast("string")).write.partitionBy("list").text(path)


def append_captions(missing: DataFrame, path: str) -> None:
    """Adds the captions of clips that had none; those that are there stay as they are."""
    missing.write.mode("append").parquet(path)
