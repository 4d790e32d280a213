"""A keyed work queue as tables: inserts, updates, leases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import import_status


def insert_new(store: DataFrame, rows: DataFrame, key: str = "clip_id") -> DataFrame:
    """``store`` with the rows whose key it lacks; a row that is there isn't changed."""
    fresh = rows.dropDuplicates([key]).join(store.select(key), key, "left_anti")
    return store.unionByName(fresh, allowMissingColumns=True)


def merge_json(old: Column, new: Column) -> Column:
    """Keys of both objects in order, the new values where both have one; values keep their types, nested ones whole."""
    a, b = (F.coalesce(F.from_json(c, "map<string, variant>"), F.create_map().cast("map<string, variant>")) for c in (old, new))
    merged = F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)
    keys = F.array_sort(F.map_keys(merged))
    return F.to_json(F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(merged, k))))


def apply_updates(store: DataFrame, updates: DataFrame, key: str = "clip_id") -> DataFrame:
    """Status and time of the latest update of each key, its worker if it names one, and its data merged over the stored."""
    latest = updates.groupBy(key).agg(F.max_by(F.struct("status", "worker", "updated", "data"), F.col("updated")).alias("u"))
    joined = store.join(latest, key, "left")
    new = F.col("u").isNotNull()
    pick = {c: F.when(new, F.col(f"u.{c}")).otherwise(F.col(c)) for c in ("status", "updated")} | {"worker": F.coalesce("u.worker", "worker")}
    data = F.when(new & F.col("u.data").isNotNull(), merge_json(F.col("data"), F.col("u.data"))).otherwise(F.col("data"))
    return joined.withColumns(pick | {"data": data}).drop("u")


def next_pending(store: DataFrame, key: str = "clip_id") -> DataFrame:
    """The smallest pending key, which a single worker would take; Spark itself deals out partitions."""
    return store.filter("status = 'pending'").agg(F.min(key).alias(key))


def release_stale(store: DataFrame, now: float, timeout: float) -> DataFrame:
    """Rows in progress that weren't touched for ``timeout`` seconds become pending without a worker."""
    stale = (F.col("status") == "in_progress") & (F.col("updated") < now - timeout)
    return store.withColumns({"worker": F.when(~stale, F.col("worker")), "status": F.when(stale, "pending").otherwise(F.col("status"))})


def stale_counts(store: DataFrame, now: float, timeout: float) -> DataFrame:
    """One row: keys in progress, and those of them that ``release_stale`` would give back."""
    held = F.col("status") == "in_progress"
    return store.agg(F.count_if(held).alias("in_progress"), F.count_if(held & (F.col("updated") < now - timeout)).alias("released"))


def import_inventory(clips: DataFrame, path: str = "rel_path") -> DataFrame:
    return clips.select("clip_id", import_status(F.col("status")).alias("status"), F.col(path).alias("source"))


def upsert_labels(store: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """Labels replace those of the same key."""
    return store.join(labels.select(*key), key, "left_anti").unionByName(labels)
