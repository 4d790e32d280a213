"""Python functions over items, each failing by itself: one bad item is a row, not the end of a job.

``attempt`` gives every item a status and, where its function raised, the error's text. A log of
attempts in the shared folder makes a job resumable: a run takes the items without a success,
and its rows are one Parquet folder of the log, which is there whole or not at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.folders import exists

DONE, FAILED = "done", "failed"
#: Items of a batch whose results are held before they go out.
ITEMS = 256


def attempt(df: DataFrame, keys: list[str], inputs: list[str], function: Callable[..., dict[str, Any] | None], returns: str) -> DataFrame:
    """(keys, status, error, returned columns): ``function(*inputs)`` of every row, a dict by column or None.

    An exception, or a result that doesn't fit ``returns``, makes the row failed, with the error as
    ``Type: message`` and nulls for the rest; the other rows go on. What the function got
    are Python values of the inputs, nulls as None. Columns that a result leaves out are null.
    """
    out = T.StructType([*(df.schema[k] for k in keys), T.StructField("status", T.StringType()), T.StructField("error", T.StringType()), *T._parse_datatype_string(returns).fields])
    made = T._parse_datatype_string(returns)
    kinds = list(to_arrow_schema(made))
    schema = to_arrow_schema(out)

    def one(values: list) -> tuple[str, str | None, list[pa.Array]]:
        try:
            got = function(*values) or {}
            unknown = set(got) - {f.name for f in kinds}
            if unknown:
                raise KeyError(f"no column {sorted(unknown)[0]}")
            return DONE, None, [pa.array([got.get(f.name)], f.type) for f in kinds]
        except Exception as error:  # an item's own failure
            return FAILED, f"{type(error).__name__}: {error}", [pa.nulls(1, f.type) for f in kinds]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ITEMS):
                part = batch.slice(lo, ITEMS)
                rows = [one([part.column(len(keys) + k)[i].as_py() for k in range(len(inputs))]) for i in range(part.num_rows)]
                results = [pa.concat_arrays([r[2][k] for r in rows]) for k in range(len(kinds))]
                columns = [*(part.column(k) for k in range(len(keys))), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), *results]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, schema, strict=True)], names=schema.names)

    return df.select(*keys, *(F.col(c).alias(f"_in{k}") for k, c in enumerate(inputs))).mapInArrow(run, out)


class AttemptLog:
    """Attempts at the items of a job, in a folder: one folder of Parquet for each run."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def attempts(self) -> DataFrame | None:
        """All attempts (keys, status, error, results, run); None before the first run."""
        return self.spark.read.parquet(self.path) if exists(self.spark, self.path) else None

    def rest(self, df: DataFrame, most: int | None = None) -> DataFrame:
        """The rows of ``df`` without a success, and with fewer than ``most`` failures."""
        seen = self.attempts()
        if seen is None:
            return df
        told = seen.groupBy(*self.keys).agg(F.bool_or(F.col("status") == DONE).alias("_done"), F.count("*").alias("_tries"))
        over = told.filter(F.col("_done") if most is None else F.col("_done") | (F.col("_tries") >= most))
        return df.join(over.select(*self.keys), self.keys, "left_anti")

    def run(self, df: DataFrame, inputs: list[str], function: Callable[..., dict[str, Any] | None], returns: str, most: int | None = None) -> int:
        """Attempts what is left of ``df``; the run's number, from 1.

        The run's folder takes its name when all its rows are there: a run that is lost leaves no row.
        """
        seen = self.attempts()
        number = 1 if seen is None else seen.agg(F.max("run")).first()[0] + 1
        attempt(self.rest(df, most), self.keys, inputs, function, returns).write.mode("overwrite").parquet(f"{self.path}/run={number}")
        return number

    def latest(self) -> DataFrame:
        """Each item's last attempt: (keys, status, error, results, run, tries)."""
        seen = self.attempts()
        if seen is None:
            raise FileNotFoundError(f"no attempts at {self.path}")
        rest = [c for c in seen.columns if c not in self.keys]
        last = seen.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "run").alias("s"), F.count("*").alias("tries"))
        return last.select(*self.keys, *(F.col(f"s.{c}").alias(c) for c in rest), "tries")
