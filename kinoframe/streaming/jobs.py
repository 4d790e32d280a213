"""Structured Streaming forms of incremental processing.

A stream reads a folder of files; what was read is remembered in a checkpoint, so a job
that stops takes up where it was. ``availableNow`` drains what is there and ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.folds import packed_windows, running_mean
from ..sources.folders import work_dir


def file_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A stream of the Parquet files at a path: a folder, or one file by its name in its folder; ``files`` at most in a batch."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    reader = reader if files is None else reader.option("maxFilesPerTrigger", files)
    folder, name = path.rsplit("/", 1)
    files = {f.rsplit("/", 1)[0] for f in spark.read.parquet(path).inputFiles()[:1]}
    if any(f.endswith(f"/{name}") for f in files):  # a folder of files
        return reader.parquet(path)
    return reader.option("pathGlobFilter", name).parquet(folder)


def tumbling(stream: DataFrame, key: str, value: str, width: str, lateness: str = "1 hour") -> DataFrame:
    """(key, start, n, total) of event-time windows; events later than ``lateness`` are dropped."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return timed.groupBy(key, F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(key, F.col("w.start").alias("start"), "n", "total")


def sliding(stream: DataFrame, key: str, value: str, width: str, slide: str, lateness: str = "1 hour") -> DataFrame:
    """The same of windows that start every ``slide``, so that they overlap."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return timed.groupBy(key, F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(key, F.col("w.start").alias("start"), "n", "total")


def first_events(spark: SparkSession, path: str, keys: list[str], lateness: str) -> DataFrame:
    """Events of a stream without those that repeat an earlier one's keys within ``lateness``."""
    base = work_dir(spark, "stream")
    timed = file_stream(spark, path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    q = timed.dropDuplicatesWithinWatermark(keys).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(timed.schema).parquet(f"{base}/out")


def label_rest(spark: SparkSession, path: str, key: list[str], labels: str, label: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Labels of all segments of a stream: a batch labels those that have none at ``labels`` yet, so a job
    that stopped goes on at the first one without, and a batch that comes again adds nothing.
    """

    def resume(batch: DataFrame, number: int) -> None:
        known = batch.sparkSession.read.parquet(labels).select(*key)
        label(batch.join(known, key, "left_anti")).write.mode("append").parquet(labels)

    q = file_stream(spark, path).writeStream.option("checkpointLocation", f"{work_dir(spark, 'stream')}/checkpoint").foreachBatch(resume).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(labels)


def streamed_mean(spark: SparkSession, path: str, key: str, order: list[str], value: str, alpha: float) -> DataFrame:
    """(order, mean): causal means of each key's values, the last one kept as state between batches, which come in order."""
    base, run = work_dir(spark, "stream"), running_mean(alpha)
    stream = file_stream(spark, path).select(key, *order, F.col(value).cast("double").alias("x"))
    kinds = dict(stream.dtypes)

    def fold(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts).sort_values(order)
        last, got = run(state.get[0] if state.exists else None, rows["x"].to_numpy())
        state.update((float(last),))
        yield rows[order].assign(mean=got)

    out = stream.groupBy(key).applyInPandasWithState(fold, ", ".join([*(f"{c} {kinds[c]}" for c in order), "mean double"]), "last double", "append", GroupStateTimeout.NoTimeout)
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def drained(spark: SparkSession, path: str, job: Callable[..., DataFrame], **options) -> DataFrame:
    """Result of an aggregating job over all of a stream: every batch's changes, the last of each key."""
    base = work_dir(spark, "stream")
    out = job(file_stream(spark, path), **options)
    keys = [c for c in out.columns if c not in ("n", "total")]

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    q = out.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").foreachBatch(keep).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{base}/out")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct("n", "total"), "_batch").alias("s"))
    return last.select(*keys, "s.n", "s.total")


def upsert(batch: DataFrame, number: int, base: str, key: str, order: str) -> None:
    """Writes a batch's latest row of each key as a version of its own; a batch that comes again replaces itself."""
    columns = [c for c in batch.columns if c not in (key, order)]
    latest = batch.groupBy(key).agg(F.max_by(F.struct(order, *columns), order).alias("s")).select(key, "s.*")
    latest.write.mode("overwrite").parquet(f"{base}/out/batch={number}")


def latest(spark: SparkSession, path: str, key: str, order: str, columns: dict[str, str]) -> DataFrame:
    """(key, order, columns): each key's row of the greatest order out of a stream of changes."""
    base = work_dir(spark, "stream")
    stream = file_stream(spark, path).select(key, order, *(F.col(v).alias(k) for k, v in columns.items()))
    q = stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(lambda b, n: upsert(b, n, base, key, order)).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{base}/out").drop("batch")
    return rows.groupBy(key).agg(F.max_by(F.struct(order, *columns), order).alias("s")).select(key, "s.*")


def streamed_windows(spark: SparkSession, path: str, seconds: float) -> DataFrame:
    """(event_id, window): greedy windows of each user's events; a stream's batches must come in order of time."""
    base, run = work_dir(spark, "stream"), packed_windows(seconds)
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double")
    spans = file_stream(spark, path).select("user_id", "event_id", start.alias("a"), (start + F.col("value")).alias("b"))

    def pack(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts).sort_values(["a", "b", "event_id"])  # one key's rows of one batch
        held, numbers = run(state.get if state.exists else None, rows["a"].to_numpy(), rows["b"].to_numpy())
        state.update((float(held[0]), int(held[1])))
        yield pd.DataFrame({"event_id": rows["event_id"].to_numpy(), "window": numbers})

    packed = spans.groupBy("user_id").applyInPandasWithState(pack, "event_id long, window long", "begin double, number long", "append", GroupStateTimeout.NoTimeout)
    q = packed.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("event_id long, window long").parquet(f"{base}/out")


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (path, length, modificationTime) of files as they appear, their content not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")


def release_on_timeout(leases: DataFrame, timeout_ms: int) -> DataFrame:
    """(clip_id, status): a claimed key comes back as pending if no heartbeat follows in time."""

    def watch(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"clip_id": [key[0]], "status": ["pending"]})
            return
        last = None
        for part in parts:
            last = part["status"].iloc[-1]
        if last == "in_progress":
            state.update((last,))
            state.setTimeoutDuration(timeout_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"clip_id": [key[0]], "status": [last]})

    return leases.groupBy("clip_id").applyInPandasWithState(watch, "clip_id string, status string", "status string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def monitor_curve(spark: SparkSession, folder: str, base: str, patience: int, stop: Callable[[dict], None]):
    """A stream over a run's metric files (run, step, val_loss); ``stop`` gets the verdict of a run that turned up."""
    from ..operators.dataset import curve_verdict

    curve = spark.readStream.schema("run string, step long, train_loss double, val_loss double").option("header", "true").csv(folder)

    def judge(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/seen/batch={number}")
        seen = batch.sparkSession.read.parquet(f"{base}/seen").filter("val_loss IS NOT NULL")
        for row in curve_verdict(seen, "run", "step", "val_loss", patience).filter("overfit").toLocalIterator():
            stop(row.asDict())

    return curve.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(judge)
