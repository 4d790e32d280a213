"""Folds over sorted rows, for what depends on all rows before it.

Rows stream through sorted partitions in runs of one unit, and only a state passes from one
run to the next, so a unit of any length takes constant memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A run's values from the state before it: (state or None, columns) -> (state, values).
Run = Callable[..., tuple[Any, np.ndarray]]


def fold_sorted(df: DataFrame, unit: str, order: list[str], inputs: list[str], run: Run, out: str, out_type: str) -> DataFrame:
    """``df`` with ``out`` added by ``run`` over each unit's rows in order, a stretch of them at a time."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T._parse_datatype_string(out_type))])
    arrow = {"double": pa.float64(), "long": pa.int64()}[out_type]

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last = None, object()
        for batch in batches:
            units, *columns = (batch.column(batch.schema.get_field_index(c)) for c in [unit, *inputs])
            values = [c.to_numpy(zero_copy_only=False) for c in columns]
            codes = units.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            edges = np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1, len(codes)] if len(codes) else np.zeros(1, int)
            made = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                name = units[lo].as_py()
                state, got = run(state if name == last else None, *(v[lo:hi] for v in values))
                last = name
                made.append(got)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(made) if made else np.zeros(0), arrow)], names=[*batch.schema.names, out])

    return df.repartition(unit).sortWithinPartitions(unit, *order).mapInArrow(fold, schema)


def packed_windows(seconds: float) -> Run:
    """Numbers of greedy windows of (start, end): the next row that ends too late after the window's start opens another."""

    def run(state, start: np.ndarray, end: np.ndarray) -> tuple[Any, np.ndarray]:
        begin, number = state or (None, -1)
        out, at = np.empty(len(start), np.int64), 0
        while at < len(start):
            if begin is None:
                begin, number = float(start[at]), number + 1
                out[at] = number
                at += 1
            reach, to = 16, at
            while to < len(start):  # in growing steps to the first row beyond the window
                beyond = np.flatnonzero(end[to : to + reach] - begin > seconds)
                if len(beyond):
                    to += int(beyond[0])
                    break
                to, reach = min(len(start), to + reach), 2 * reach
            out[at:to] = number
            at = to
            if at < len(start):
                begin, number = float(start[at]), number + 1
                out[at] = number
                at += 1
        return (begin, number), out

    return run


def running_mean(alpha: float, block: int = 256) -> Run:
    """Causal mean y = alpha x + (1 - alpha) y before, a block at a time as a product with its triangle of weights."""
    age = np.subtract.outer(np.arange(block), np.arange(block))
    triangle = np.where(age >= 0, alpha * (1 - alpha) ** np.maximum(age, 0).astype(float), 0.0)
    fade = (1 - alpha) ** np.arange(1, block + 1).astype(float)

    def run(state, x: np.ndarray) -> tuple[Any, np.ndarray]:
        x, out, at = x.astype(np.float64), np.empty(len(x)), 0
        if state is None and len(x):
            state = out[0] = x[0]
            at = 1
        for lo in range(at, len(x), block):
            part = x[lo : lo + block]
            out[lo : lo + block] = triangle[: len(part), : len(part)] @ part + fade[: len(part)] * state
            state = out[lo + len(part) - 1]
        return state, out

    return run
