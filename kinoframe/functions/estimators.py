"""Estimators as table functions: registered by name, called laterally from SQL or a DataFrame.

A table function takes a table of detections, PARTITION BY unit ORDER BY time, and the name of an
estimator, whose columns are the function's schema: it is known, and an unknown name refused, when
the query is analysed. Rows of a unit stream through, and an estimator keeps what it has to of them,
so units of any length are fine. Own estimators are registered before the function is.

``estimate_motion``: table(unit, at, value), estimator, options as JSON.
``estimate_hands``: table(unit, at, right, value), estimator, options as JSON.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


class Estimator:
    """Takes a unit's detections one by one and gives rows of ``columns``."""

    columns: dict[str, DataType] = {"frame": LongType(), "value": DoubleType()}

    def __init__(self, **options: Any):
        self.options = options

    def take(self, row: dict) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> Iterator[tuple]:
        """Rows that follow a unit's last detection."""
        return iter(())


class Held(Estimator):
    """A frame for each detection; one that is missing or below ``least`` holds the last valid value."""

    columns = {"frame": LongType(), "at": DoubleType(), "value": DoubleType(), "valid": BooleanType()}

    def __init__(self, least: float | None = None):
        self.least, self.frame, self.last = least, 0, None

    def take(self, row: dict) -> Iterator[tuple]:
        value = row["value"]
        valid = value is not None and (self.least is None or value >= self.least)
        self.last = value if valid else self.last
        yield self.frame, row["at"], self.last, valid
        self.frame += 1


class Resampled(Estimator):
    """Frames at a fixed rate from the first detection to the last, linear between detections."""

    columns = {"frame": LongType(), "at": DoubleType(), "value": DoubleType()}

    def __init__(self, fps: float = 1.0):
        if fps <= 0:
            raise ValueError("fps must be positive")
        self.fps, self.frame, self.first, self.before = float(fps), 0, None, None

    def take(self, row: dict) -> Iterator[tuple]:
        at, value = row["at"], row["value"]
        if at is None or value is None:
            return
        if self.before is None:
            self.first = at
        else:
            a, x = self.before
            while (now := self.first + self.frame / self.fps) < at:
                yield self.frame, now, x + (value - x) * (now - a) / (at - a)
                self.frame += 1
        self.before = (at, value)

    def close(self) -> Iterator[tuple]:
        if self.before is not None and self.first + self.frame / self.fps <= self.before[0]:
            yield self.frame, self.first + self.frame / self.fps, self.before[1]


class Sides(Estimator):
    """A frame for each time with the left and the right hand, where one is missing the last one held and marked invalid."""

    columns = {"frame": LongType(), "at": DoubleType(), "left": DoubleType(), "right": DoubleType(), "left_valid": BooleanType(), "right_valid": BooleanType()}

    def __init__(self):
        self.frame, self.now, self.seen = 0, None, False
        self.hands: dict[bool, float | None] = {False: None, True: None}
        self.valid = {False: False, True: False}

    def _out(self) -> Iterator[tuple]:
        if self.seen:
            yield self.frame, self.now, self.hands[False], self.hands[True], self.valid[False], self.valid[True]
            self.frame += 1

    def take(self, row: dict) -> Iterator[tuple]:
        if not self.seen or row["at"] != self.now:
            yield from self._out()
            self.now, self.seen, self.valid = row["at"], True, {False: False, True: False}
        if row["right"] is not None and row["value"] is not None:
            self.hands[row["right"]], self.valid[row["right"]] = row["value"], True

    def close(self) -> Iterator[tuple]:
        yield from self._out()


MOTION: dict[str, type[Estimator]] = {"held": Held, "resampled": Resampled}
HANDS: dict[str, type[Estimator]] = {"sides": Sides}
#: Other names of estimators.
ALIASES = {"hold": "held", "carry": "held", "linear": "resampled", "resample": "resampled", "both": "sides"}


def found(registry: dict[str, type[Estimator]], name: str | None) -> type[Estimator]:
    """The estimator of that name or alias; an error that names those there are."""
    known = (name or "").lower()
    known = ALIASES.get(known, known)
    if known not in registry:
        raise ValueError(f"no estimator {name}; there are {', '.join(sorted(registry))}")
    return registry[known]


def table_function(registry: dict[str, type[Estimator]], needs: tuple[str, ...]):
    """A table function class over (table, estimator, options) that runs the registry's estimators."""

    class Estimated:
        @staticmethod
        def analyze(table: AnalyzeArgument, name: AnalyzeArgument, options: AnalyzeArgument | None = None) -> AnalyzeResult:
            if not table.isTable:
                raise ValueError("the first argument is a table")
            missing = [c for c in ("unit", *needs) if c not in table.dataType.names]
            if missing:
                raise ValueError(f"the table has no column {missing[0]}")
            kind = found(registry, name.value)
            kind(**json.loads(options.value or "{}") if options is not None else {})
            schema = StructType([table.dataType["unit"], *(StructField(c, t) for c, t in kind.columns.items())])
            return AnalyzeResult(schema, partitionBy=[PartitioningColumn("unit")], orderBy=[OrderingColumn(c) for c in needs])

        def __init__(self):
            self.worker = None

        def eval(self, row, name, options=None):
            if self.worker is None:
                self.unit, self.worker = row["unit"], found(registry, name)(**json.loads(options or "{}"))
            for got in self.worker.take({c: row[c] for c in needs}):
                yield (self.unit, *got)

        def terminate(self):
            if self.worker is not None:
                for got in self.worker.close():
                    yield (self.unit, *got)

    return Estimated


def register(spark: SparkSession, motion: dict[str, type[Estimator]] | None = None, hands: dict[str, type[Estimator]] | None = None) -> None:
    """``estimate_motion`` and ``estimate_hands`` as SQL table functions, with own estimators beside those there are."""
    spark.udtf.register("estimate_motion", F.udtf(table_function(MOTION | (motion or {}), ("at", "value"))))
    spark.udtf.register("estimate_hands", F.udtf(table_function(HANDS | (hands or {}), ("at", "right", "value"))))


def estimate(detections: DataFrame, name: str, hands: bool = False, registry: dict[str, type[Estimator]] | None = None, **options: Any) -> DataFrame:
    """The estimator's rows of all units of ``detections`` (unit, at, value; hands: right, too)."""
    needs = ("at", "right", "value") if hands else ("at", "value")
    function = F.udtf(table_function((HANDS if hands else MOTION) | (registry or {}), needs))
    return function(detections.select("unit", *needs).asTable(), F.lit(name), F.lit(json.dumps(options)))
