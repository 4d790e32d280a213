"""Orders over many tasks: what depends on all rows before a row, without a unit in one task.

Rows are parted by ranges of (unit, order), so that a unit of many rows lies in several ranges
and small units share one. A range tells what it does to whatever comes before it in a row for
each unit in it; these few rows are composed in order, and each range goes on from what
it then gets. A scan takes a write of the rows and two shuffles, whatever the units' sizes.

The order must tell rows apart: rows equal in all of it lie in one range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import kept
from . import folds

RANGE = "_range"


def ranged(df: DataFrame, unit: list[str], order: list[str]) -> DataFrame:
    """``df`` written by ranges of (unit, order), with the range's number."""
    return kept(df.repartitionByRange(*unit, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def _inside(unit: list[str], order: list[str]):
    return Window.partitionBy(RANGE, *unit).orderBy(*order)


def _before(unit: list[str]):
    return Window.partitionBy(*(unit or [F.lit(0)])).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def _met(rows: DataFrame, sums: DataFrame, unit: list[str], *columns: str) -> DataFrame:
    """Rows with what their unit's range gets, a row of ``sums`` for each unit and range."""
    named = sums.select(*(F.col(u).alias(f"_u{k}") for k, u in enumerate(unit)), F.col(RANGE).alias("_r"), *columns)
    same = F.col(RANGE) == F.col("_r")
    for k, u in enumerate(unit):
        same = same & F.col(u).eqNullSafe(F.col(f"_u{k}"))
    return rows.join(named, same).drop("_r", *(f"_u{k}" for k in range(len(unit))))


def numbered(df: DataFrame, unit: list[str], order: list[str], out: str = "row") -> DataFrame:
    """``df`` with each row's place in its unit's order, from 0."""
    rows = ranged(df, unit, order)
    counts = rows.groupBy(*unit, RANGE).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(_before(unit)), F.lit(0)))
    met = _met(rows, counts, unit, "_first")
    return met.withColumn(out, F.col("_first") + F.row_number().over(_inside(unit, order)) - 1).drop("_first", RANGE)


def running_sum(df: DataFrame, unit: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``df`` with the sum of a value up to each row, nulls aside; null before the first value."""
    rows = ranged(df, unit, order)
    sums = rows.groupBy(*unit, RANGE).agg(F.sum(value).alias("_s"))
    sums = sums.withColumn("_s", F.sum("_s").over(_before(unit)))
    met = _met(rows, sums, unit, "_s")
    own = F.sum(value).over(_inside(unit, order).rowsBetween(Window.unboundedPreceding, 0))
    return met.withColumn("_own", own).withColumn(out, F.coalesce(F.col("_s") + F.col("_own"), "_own", "_s")).drop("_s", "_own", RANGE)


def last_valid(df: DataFrame, unit: list[str], order: list[str], value: str, valid: Column, out: str) -> DataFrame:
    """``df`` with the last valid value up to each row; null before the first."""
    rows = ranged(df.withColumn("_v", F.when(valid, F.col(value))), unit, order)
    place = F.struct(*order)
    lasts = rows.groupBy(*unit, RANGE).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), place)).alias("_l"))
    lasts = lasts.withColumn("_l", F.last("_l", ignorenulls=True).over(_before(unit)))
    met = _met(rows, lasts, unit, "_l")
    own = F.last("_v", ignorenulls=True).over(_inside(unit, order).rowsBetween(Window.unboundedPreceding, 0))
    return met.withColumn("_own", own).withColumn(out, F.coalesce("_own", "_l")).drop("_l", "_v", "_own", RANGE)


def previous(df: DataFrame, unit: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``df`` with the value of the row before, null in a unit's first row."""
    rows = ranged(df, unit, order)
    lasts = rows.groupBy(*unit, RANGE).agg(F.max_by(F.struct(value), F.struct(*order)).alias("_l"))
    lasts = lasts.withColumn("_l", F.last("_l").over(_before(unit)))
    met = _met(rows, lasts, unit, "_l")
    own = F.lag(F.struct(value)).over(_inside(unit, order))
    return met.withColumn("_own", own).withColumn(out, F.coalesce("_own", "_l")[value]).drop("_l", "_own", RANGE)


def median(df: DataFrame, group: list[str], value: str, tie: list[str], out: str = "median") -> DataFrame:
    """(group, median, n): the middle value of each group's values that aren't null, the mean of two where n is even.

    ``tie`` are columns that tell rows of equal value apart, so that a group of equal values is dealt out too.
    """
    rows = numbered(df.filter(F.col(value).isNotNull()).select(*group, value, *(c for c in tie if c not in group)), group, [value, *tie], "_at")
    n = df.groupBy(*group).agg(F.count(value).alias("n"))
    same = F.lit(True)
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    sizes = n.select(*(F.col(g).alias(f"_g{k}") for k, g in enumerate(group)), "n")
    middle = rows.join(sizes, same) if group else rows.join(F.broadcast(sizes))  # one row
    middle = middle.filter((F.col("_at") == F.floor((F.col("n") - 1) / 2)) | (F.col("_at") == F.floor(F.col("n") / 2)))
    return middle.groupBy(*group).agg(F.avg(value).alias(out), F.first("n").alias("n"))


# --- folds whose ranges are functions of what comes before ----------------------------------------


def _by_range(rows: DataFrame, unit: str) -> DataFrame:
    """A ranged table with a text for each unit in each range, ``_k``, a unit of its own for ``fold_sorted``."""
    return rows.withColumn("_k", F.to_json(F.struct(RANGE, unit)))


def running_mean(df: DataFrame, unit: str, order: list[str], value: str, alpha: float, out: str) -> DataFrame:
    """``df`` with the causal mean y = alpha x + (1 - alpha) y before, from the unit's first value.

    A range of n rows takes y to (1 - alpha)^n y + b, where b is its mean from 0, and its k-th
    row is its own mean and (1 - alpha)^k times what comes in; a unit's first value comes into its first range.
    """
    mean = folds.running_mean(alpha)

    def from_zero(state, x: np.ndarray):
        return mean(0.0 if state is None else state, x)

    def composed(state, first: np.ndarray, last: np.ndarray, n: np.ndarray):
        got = np.empty(len(first))
        for k in range(len(first)):  # a unit's ranges
            got[k] = state = first[k] if state is None else state
            state = last[k] + (1 - alpha) ** n[k] * state
        return state, got

    rows = _by_range(ranged(df, [unit], order), unit)
    own = kept(folds.fold_sorted(rows, "_k", order, [value], from_zero, "_y", "double").withColumn("_i", F.row_number().over(_inside([unit], order))), "means")
    ends = own.groupBy(unit, RANGE).agg(F.min_by(F.col(value).cast("double"), "_i").alias("_x"), F.max_by("_y", "_i").alias("_b"), F.max("_i").alias("_n"))
    met = _met(own, folds.fold_sorted(ends, unit, [RANGE], ["_x", "_b", "_n"], composed, "_in", "double"), [unit], "_in")
    return met.withColumn(out, F.col("_y") + F.pow(F.lit(1 - alpha), F.col("_i")) * F.col("_in")).drop("_y", "_i", "_in", "_k", RANGE)


def _leaving(start: np.ndarray, end: np.ndarray, seconds: float, row: int, known: dict[int, tuple[float, int]]) -> tuple[float, int]:
    """(start of the last window, windows) if a window opens at ``row`` of a range."""
    path = []
    while row not in known:
        path.append(row)
        reach, to = 16, row + 1
        while to < len(start):
            beyond = np.flatnonzero(end[to : to + reach] - start[row] > seconds)
            if len(beyond):
                to += int(beyond[0])
                break
            to, reach = to + reach, 2 * reach
        if to >= len(start):
            known[row] = (float(start[row]), 1)
            path.pop()
            break
        row = to
    last, windows = known[row]
    for r in reversed(path):
        windows += 1
        known[r] = (last, windows)
    return last, windows


def packed_windows(df: DataFrame, unit: str, order: list[str], start: str, end: str, seconds: float, out: str) -> DataFrame:
    """``df`` with the number of each row's greedy window: the next row that ends too late after its start opens another.

    What a range does depends on the open window's start alone, and only up to the range's own
    first start, so it is a table of steps: the rows that a start may make open a window are those that
    end later than all before, up to the first that its first start would. Each step holds the start and number of
    windows with which the range is left; steps that end alike are one.
    """
    kind = df.schema[unit].dataType.simpleString()
    names = f"`{unit}` {kind}, {RANGE} int"

    def steps(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in order])
        s, e = (table.column(c).to_numpy().astype(np.float64) for c in (start, end))
        top = np.maximum.accumulate(e)
        records = np.flatnonzero(np.r_[True, top[1:] > top[:-1]])
        reached = np.flatnonzero(e[records] - s[0] > seconds)
        records = records[: reached[0] + 1] if len(reached) else records
        known: dict[int, tuple[float, int]] = {}
        below, last, windows = [], [], []
        for row in records.tolist():
            got = _leaving(s, e, seconds, row, known)
            if below and (last[-1], windows[-1]) == got:
                below[-1] = float(e[row])
            else:
                below.append(float(e[row]))
                last.append(got[0])
                windows.append(got[1])
        first = _leaving(s, e, seconds, 0, known)
        one = table.slice(0, 1)
        lists = [pa.array([below], pa.list_(pa.float64())), pa.array([last], pa.list_(pa.float64())), pa.array([windows], pa.list_(pa.int64()))]
        return pa.table([one.column(unit), one.column(RANGE), *lists, pa.array([first[0]]), pa.array([first[1]], pa.int64())], names=[unit, RANGE, "below", "last", "windows", "first", "opened"])

    def composed(table: pa.Table) -> pa.Table:
        table = table.sort_by(RANGE)
        begins, numbers, state = [], [], None
        for row in table.to_pylist():  # a unit's ranges
            begins.append(None if state is None else state[0])
            numbers.append(None if state is None else state[1])
            if state is None:
                state = (row["first"], row["opened"] - 1)
                continue
            # The first step that ends later than the window reaches, by the rows' own test.
            k = next((k for k, b in enumerate(row["below"]) if b - state[0] > seconds), None)
            if k is not None:
                state = (row["last"][k], state[1] + row["windows"][k])
        return pa.table([table.column(unit), table.column(RANGE), pa.array(begins, pa.float64()), pa.array(numbers, pa.int64())], names=[unit, RANGE, "_begin", "_number"])

    pack = folds.packed_windows(seconds)

    def run(state, a: np.ndarray, b: np.ndarray, begin: np.ndarray, number: np.ndarray):
        if state is None and len(a) and not np.isnan(begin[0]):
            state = (float(begin[0]), int(number[0]))
        return pack(state, a, b)

    rows = ranged(df, [unit], order)
    cut = rows.select(unit, RANGE, *dict.fromkeys([*order, start, end])).groupBy(unit, RANGE).applyInArrow(steps, f"{names}, below array<double>, last array<double>, windows array<long>, first double, opened long")
    states = cut.groupBy(unit).applyInArrow(composed, f"{names}, _begin double, _number long")
    met = _by_range(_met(rows, states, [unit], "_begin", "_number"), unit)
    return folds.fold_sorted(met, "_k", order, [start, end, "_begin", "_number"], run, out, "long").drop("_k", "_begin", "_number", RANGE)
