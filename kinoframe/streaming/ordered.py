"""Folds over streams whose rows come in any order, on ``transformWithState``.

A key's rows wait in list state until the watermark has passed their time; an event-time timer
then gives them to the fold in order, and the fold's own state is a value. So batches and files
may come in any order within the lateness; a row that comes again waits once. What is later
than that, Spark drops. ``folded`` drains a stream and closes it: all that waits is released.

State lies in RocksDB and is written with the checkpoint, so a job that stops takes up where it
was. A key's waiting rows are in memory when its timer fires: as many as come within the lateness.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources.folders import work_dir
from .jobs import file_stream

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The time of the row that closes a stream.
END = datetime.datetime(9000, 1, 1)
#: Rows of a state's entry at most.
BLOCK = 4096


class Fold:
    """A fold of a key's rows in order; ``state`` and ``output`` are DDL, states and outputs tuples of them."""

    state = ""
    output = ""

    def take(self, state: tuple | None, at: int, row: dict) -> tuple[tuple | None, list[tuple]]:
        """The state after a row at a time in microseconds, and what it gives."""
        raise NotImplementedError

    def idle(self, state: tuple | None, until: int) -> tuple[tuple | None, list[tuple]]:
        """The same where no row came before a time."""
        return state, []

    def wakes(self, state: tuple | None) -> int | None:
        """When ``idle`` has something to say if no row comes first, in microseconds."""
        return None


class CarryForward(Fold):
    """Each row's last valid value so far; its own before the first valid one."""

    state = "value double"
    output = "id long, filled double"

    def take(self, state, at, row):
        state = (row["value"],) if row["valid"] and row["value"] is not None else state
        return state, [(row["id"], row["value"] if state is None else state[0])]


class Mean(Fold):
    """The causal mean y = alpha x + (1 - alpha) y before; a null value leaves it as it is."""

    state = "mean double"
    output = "id long, mean double"

    def __init__(self, alpha: float):
        self.alpha = alpha

    def take(self, state, at, row):
        x = row["value"]
        if x is not None:
            state = (x if state is None else self.alpha * x + (1 - self.alpha) * state[0],)
        return state, [(row["id"], None if state is None else state[0])]


class Packing(Fold):
    """Greedy windows: a row that ends more than ``seconds`` after the open window's start opens the next one."""

    state = "begin double, number long"
    output = "id long, window long"

    def __init__(self, seconds: float):
        self.seconds = seconds

    def take(self, state, at, row):
        start, end = row["start"], row["end"]
        if state is None or end - state[0] > self.seconds:
            state = (start, 0 if state is None else state[1] + 1)
        return state, [(row["id"], state[1])]


class Leases(Fold):
    """Status changes as they are, and ``pending`` for a claim that no row follows within ``timeout`` seconds."""

    state = "since long"
    output = "status string, at_us long, released boolean"

    def __init__(self, timeout: float):
        self.timeout = int(timeout * 1_000_000)

    def take(self, state, at, row):
        state, out = self.idle(state, at)
        out.append((row["status"], at, False))
        return ((at,) if row["status"] == "in_progress" else None), out

    def idle(self, state, until):
        if state is not None and until > state[0] + self.timeout:
            return None, [("pending", state[0] + self.timeout, True)]
        return state, []

    def wakes(self, state):
        return None if state is None else state[0] + self.timeout


def _blocks(rows: list[tuple]) -> list[tuple]:
    """Rows as blocks of ``BLOCK`` at most, a list for each column."""
    return [tuple(map(list, zip(*rows[lo : lo + BLOCK], strict=True))) for lo in range(0, len(rows), BLOCK)]


class _Ordered(StatefulProcessor):
    def __init__(self, fold: Fold, key: str, row_type: T.StructType, state_type: T.StructType, output_type: T.StructType):
        self.fold, self.key, self.row_type, self.state_type, self.output = fold, key, row_type, state_type, Row(*output_type.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Rows lie in blocks, a column a list: a state's entry is a message to Spark, whatever it holds.
        place = [T.StructField("_at", T.LongType()), T.StructField("_tie", T.LongType())]
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in [*place, *self.row_type.fields]]))
        self.held = handle.getValueState("held", self.state_type)
        self.next = handle.getValueState("next", T.StructType([T.StructField("ms", T.LongType())]))

    def _wake(self, at: int | None, fresh: bool = False) -> None:
        """One timer, at the first of the times asked for; ``fresh`` if none is set."""
        if at is None:
            return
        ms = at // 1000 + 1
        held = None if fresh else self.next.get()
        before = None if held is None else held[0]
        if before is None or ms < before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(ms)
            self.next.update((ms,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(row["_at"], row["_tie"], *(row[c] for c in self.row_type.names)) for row in rows if row["_at"] is not None]
        if new:
            self.waiting.appendList(_blocks(new))
            self._wake(min(row[0] for row in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        # What came again waits once: the last of the same place.
        waiting = {(row[0], row[1]): row for block in self.waiting.get() for row in zip(*block, strict=True)}
        ordered = sorted(waiting, key=lambda p: (p[0], p[1] is not None, p[1] or 0))
        due = [p for p in ordered if p[0] < until]
        rest = [waiting[p] for p in ordered[len(due) :]]
        if rest:
            self.waiting.put(_blocks(rest))
        elif waiting:
            self.waiting.clear()
        held = self.held.get()
        state = before = None if held is None else tuple(held)
        first = rest[0][0] if rest else None
        names = self.row_type.names
        for place in due:
            state, out = self.fold.take(state, place[0], dict(zip(names, waiting[place][2:], strict=True)))
            yield from (self._row(key, o) for o in out)
        state, out = self.fold.idle(state, until)
        yield from (self._row(key, o) for o in out)
        if state is not None and state != before:
            self.held.update(state)
        elif state is None and before is not None:
            self.held.clear()
        wakes = [t for t in (first, self.fold.wakes(state)) if t is not None]
        if wakes:
            self._wake(min(wakes), fresh=True)
        else:
            self.next.clear()

    def _row(self, key, out: tuple) -> Row:
        return self.output(key[0], *out)

    def close(self) -> None:
        pass


def in_order(stream: DataFrame, key: str, time: str, tie: str, columns: list[str], fold: Fold, lateness: str) -> DataFrame:
    """(key, output): the fold over each key's rows by (time, tie), of a stream in any order.

    Rows with the same key, time and tie are one. Its query needs RocksDB as state store; ``folded`` sets it.
    """
    timed = stream.withColumn("_ts", F.col(time).cast("timestamp")).withWatermark("_ts", lateness)
    rows = timed.select(key, "_ts", F.unix_micros("_ts").alias("_at"), F.col(tie).cast("long").alias("_tie"), *columns)
    row_type = T.StructType([rows.schema[c] for c in columns])
    output = T.StructType([rows.schema[key], *T._parse_datatype_string(fold.output).fields])
    worker = _Ordered(fold, key, row_type, T._parse_datatype_string(fold.state), output)
    return rows.groupBy(key).transformWithState(worker, output, "Append", "EventTime")


def folded(spark: SparkSession, path: str, key: str, time: str, tie: str, columns: list[str], fold: Fold, lateness: str = "1 hour", files: int = 2, prepare=lambda stream: stream) -> DataFrame:
    """``in_order``'s rows of all files at a path, ``files`` of them in a batch, drained and closed.

    The row that closes the stream has the last time there is, a null tie and a null key, and gives nothing.
    """
    base = work_dir(spark, "ordered")
    source = prepare(file_stream(spark, path, files)).select(key, time, tie, *dict.fromkeys(c for c in columns if c not in (key, time, tie)))
    closing = spark.createDataFrame([(END,)], "t timestamp").select(*(F.col("t").cast(f.dataType).alias(f.name) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema))
    source.sparkSession.createDataFrame([], source.schema).write.parquet(f"{base}/closing")
    both = source.unionByName(spark.readStream.schema(source.schema).parquet(f"{base}/closing"))
    out = in_order(both, key, time, tie, columns, fold, lateness)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        for last in (False, True):
            if last:
                closing.write.mode("append").parquet(f"{base}/closing")
            q = out.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out").trigger(availableNow=True).start()
            q.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    rows = spark.read.schema(out.schema).parquet(f"{base}/out")
    return rows.filter(F.col(key).isNotNull())
