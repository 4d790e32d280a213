"""Time series in long form: one row for each unit and frame.

Neighbours are windows over (unit, order), so a unit is one sort run; every function
adds columns and keeps the rest. Where a unit may hold a large part of all rows, ``spread``
deals its rows out by ranges, at the cost of writing them once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranges
from .folds import fold_sorted, running_mean

EPS = 1e-16
WIDEST = 256


def in_order(unit: str, order: list[str]):
    return Window.partitionBy(unit).orderBy(*order)


def whole(unit: str):
    return Window.partitionBy(unit)


def difference(df: DataFrame, unit: str, order: list[str], value: str, out: str = "diff") -> DataFrame:
    """Value less the one before; null in a unit's first row."""
    return df.withColumn(out, F.col(value) - F.lag(value).over(in_order(unit, order)))


def speed(df: DataFrame, unit: str, order: list[str], axes: list[str], fps: float, out: str = "speed") -> DataFrame:
    """Length of the difference over the axes for a second; the first row borrows the second's."""
    w = in_order(unit, order)
    step = F.sqrt(sum(((F.col(a) - F.lag(a).over(w)) ** 2 for a in axes), F.lit(0.0))) * fps
    return df.withColumn("_step", step).withColumn(out, F.coalesce("_step", F.lead("_step").over(w))).drop("_step")


def second_difference(df: DataFrame, unit: str, order: list[str], value: str, out: str = "accel") -> DataFrame:
    """x[i-1] - 2 x[i] + x[i+1], in the middle of its three rows; the ends borrow from the next row."""
    w = in_order(unit, order)
    middle = F.lag(value).over(w) - 2 * F.col(value) + F.lead(value).over(w)
    return df.withColumn("_mid", middle).withColumn(out, F.coalesce("_mid", F.lead("_mid").over(w), F.lag("_mid").over(w))).drop("_mid")


def jitter(df: DataFrame, unit: str, order: list[str], values: list[str]) -> DataFrame:
    """(unit, jitter): population variance of the second differences of all channels, 0 below three rows."""
    w = in_order(unit, order)
    inner = [(F.lag(v).over(w) - 2 * F.col(v) + F.lead(v).over(w)).alias(v) for v in values]
    long = df.select(unit, *inner).select(unit, F.explode(F.array(*values)).alias("_d"))
    return long.groupBy(unit).agg(F.coalesce(F.var_pop("_d"), F.lit(0.0)).alias("jitter"))


def savgol_kernel(window: int, polyorder: int) -> list[float]:
    """Weights that fit a polynomial over a centred window and take its middle."""
    if window % 2 == 0 or window < polyorder + 2:
        raise ValueError("the window must be odd and at least polyorder + 2")
    x = np.arange(window) - window // 2
    return np.linalg.pinv(np.vander(x, polyorder + 1, increasing=True))[0].tolist()


def savgol(df: DataFrame, unit: str, order: list[str], value: str, window: int = 9, polyorder: int = 2, out: str = "smooth") -> DataFrame:
    """Savitzky-Golay smoothing; the ends reflect without repeating the edge. Units of up to ``window`` rows stay as they are."""
    half, kernel = window // 2, savgol_kernel(window, polyorder)
    w = in_order(unit, order)
    i, n = F.row_number().over(w) - 1, F.count("*").over(whole(unit))
    near = F.collect_list(F.col(value).cast("double")).over(w.rowsBetween(-half, half))
    df = df.withColumns({"_i": i, "_n": n, "_near": near})

    def sample(k: int) -> Column:
        j = F.abs(F.col("_i") + k)
        j = F.when(j > F.col("_n") - 1, 2 * (F.col("_n") - 1) - j).otherwise(j)
        return F.get("_near", (F.least(F.col("_i"), F.lit(half)) + j - F.col("_i")).cast("int"))

    total = sum((c * sample(k - half) for k, c in enumerate(kernel)), F.lit(0.0))
    return df.withColumn(out, F.when(F.col("_n") > window, total).otherwise(F.col(value))).drop("_i", "_n", "_near")


def confidence_smooth(df: DataFrame, unit: str, order: list[str], value: str, window: int = 9, polyorder: int = 2, kappa: float = 0.02, strength: float = 1.0, out: str = "smooth") -> DataFrame:
    """Blend with the Savitzky-Golay fit by how much the row accelerates: a / (a + kappa)."""
    df = second_difference(savgol(df, unit, order, value, window, polyorder, "_fit"), unit, order, value, "_acc")
    a = F.abs(F.coalesce("_acc", F.lit(0.0)))
    weight = a / (a + kappa) * strength
    return df.withColumn(out, (1 - weight) * F.col(value) + weight * F.col("_fit")).drop("_fit", "_acc")


def ema(df: DataFrame, unit: str, order: list[str], value: str, alpha: float = 0.4, out: str = "ema", spread: bool = False) -> DataFrame:
    """Causal mean y[i] = alpha x[i] + (1 - alpha) y[i-1], from y[0] = x[0].

    Weights below 1e-16 don't change a double, so a window of bounded width gives the
    whole sum; where that would be wide, a fold over sorted rows does.
    """
    if spread:
        return ranges.running_mean(df, unit, order, value, alpha, out)
    width = 1 if alpha >= 1 else math.ceil(math.log(EPS) / math.log(1 - alpha))
    if width > WIDEST:
        return fold_sorted(df, unit, order, [value], running_mean(alpha), out, "double")
    w = in_order(unit, order)
    df = df.withColumns({"_i": F.row_number().over(w) - 1, "_near": F.collect_list(F.col(value).cast("double")).over(w.rowsBetween(-width, 0))})
    age = lambda k: F.size("_near") - 1 - k
    weight = lambda k: F.pow(F.lit(1 - alpha), age(k)) * F.when(age(k) == F.col("_i"), 1.0).otherwise(alpha)
    total = F.aggregate(F.transform("_near", lambda x, k: x * weight(k)), F.lit(0.0), lambda s, x: s + x)
    return df.withColumn(out, total).drop("_i", "_near")


def carry_forward(df: DataFrame, unit: str, order: list[str], value: str, valid: Column, out: str = "filled", spread: bool = False) -> DataFrame:
    """Last valid value so far; rows before the first valid one keep their own."""
    if spread:
        return ranges.last_valid(df, [unit], order, value, valid, out).withColumn(out, F.coalesce(out, value))
    last = F.last(F.when(valid, F.col(value)), ignorenulls=True).over(in_order(unit, order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, F.coalesce(last, F.col(value)))


def mark_runs(df: DataFrame, unit: str, order: list[str], mask: Column, min_len: int, out: str = "run") -> DataFrame:
    """Number of the run of true rows that a row belongs to, null outside runs of at least ``min_len`` rows."""
    w = in_order(unit, order)
    df = df.withColumn("_m", F.coalesce(mask, F.lit(False)))
    df = df.withColumn("_g", F.row_number().over(w) - F.row_number().over(Window.partitionBy(unit, "_m").orderBy(*order)))
    size = F.count("*").over(Window.partitionBy(unit, "_m", "_g"))
    df = df.withColumn("_k", F.col("_m") & (size >= min_len))
    first = F.col("_k") & ~F.coalesce(F.lag("_k").over(w), F.lit(False))
    number = F.sum(first.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, F.when(F.col("_k"), number)).drop("_m", "_g", "_k")


def runs(df: DataFrame, unit: str, order: list[str], mask: Column, min_len: int) -> DataFrame:
    """(unit, run_start, run_end): half-open row ranges of the runs of true rows."""
    w = in_order(unit, order)
    marked = mark_runs(df.withColumn("_i", F.row_number().over(w) - 1), unit, order, mask, min_len, "_run")
    return marked.filter("_run IS NOT NULL").groupBy(unit, "_run").agg(F.min("_i").cast("long").alias("run_start"), (F.max("_i") + 1).cast("long").alias("run_end")).drop("_run")


def anti_drift(df: DataFrame, unit: str, order: list[str], values: list[str], fps: float, speed_limit: float = 0.02, seconds: float = 0.2, damping: float = 0.7, spread: bool = False) -> DataFrame:
    """Rows of a standing run pulled towards the run's median, in columns named ``<value>_held``.

    Medians are taken over rows in runs only; with ``spread`` a run's median is found by ranges of its values.
    """
    moving = speed(df, unit, order, values, fps, "_speed")
    min_len = max(2, round(seconds * fps))
    marked = mark_runs(moving, unit, order, F.col("_speed") < speed_limit, min_len, "_run")
    held = marked.filter("_run IS NOT NULL")
    for v in values:
        if spread:
            middle = ranges.median(held, [unit, "_run"], v, order, "_med")
        else:
            middle = held.groupBy(unit, "_run").agg(F.median(v).alias("_med"))
        middle = middle.select(F.col(unit).alias("_u"), F.col("_run").alias("_r"), "_med")
        marked = marked.join(middle, F.col(unit).eqNullSafe(F.col("_u")) & (F.col("_run") == F.col("_r")), "left")
        pulled = (1 - damping) * F.col(v) + damping * F.col("_med")
        marked = marked.withColumn(f"{v}_held", F.when(F.col("_run").isNotNull(), pulled).otherwise(F.col(v))).drop("_u", "_r", "_med")
    return marked.drop("_speed", "_run")


def resample(df: DataFrame, unit: str, order: list[str], values: list[str], fps: float, target: float) -> DataFrame:
    """(unit, frame_idx, values): linear resampling to ``max(2, round(duration * target) + 1)`` rows over the same duration."""
    w = in_order(unit, order)
    rows = df.select(unit, (F.row_number().over(w) - 1).alias("_i"), *values, *(F.lead(v).over(w).alias(f"_{v}") for v in values))
    if abs(fps - target) < 1e-6:
        return rows.select(unit, F.col("_i").cast("long").alias("frame_idx"), *values)
    sizes = df.groupBy(unit).agg(F.count("*").alias("_n"))
    m = F.when(F.col("_n") < 2, F.col("_n")).otherwise(F.greatest(F.lit(2), F.bround((F.col("_n") - 1) / fps * target) + 1)).cast("long")
    grid = sizes.withColumn("_m", m).select(unit, "_n", "_m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)).alias("frame_idx"))
    at = F.when(F.col("_n") < 2, F.lit(0.0)).otherwise(F.col("frame_idx") * (F.col("_n") - 1) / (F.col("_m") - 1))
    grid = grid.withColumn("_at", at).withColumn("_i", F.greatest(F.lit(0), F.least(F.floor("_at"), F.col("_n") - 2)).cast("int")).drop("_n", "_m")
    part = F.col("_at") - F.col("_i")
    mixed = [F.when(part == 0, F.col(v)).otherwise(F.col(v) + part * (F.col(f"_{v}") - F.col(v))).alias(v) for v in values]
    return grid.join(rows, [unit, "_i"]).select(unit, "frame_idx", *mixed)


def integrate(df: DataFrame, unit: str, order: list[str], value: str, out: str = "path", spread: bool = False) -> DataFrame:
    """Running sum from the unit's first row."""
    if spread:
        return ranges.running_sum(df, [unit], order, value, out)
    return df.withColumn(out, F.sum(value).over(in_order(unit, order).rowsBetween(Window.unboundedPreceding, 0)))


def bending_smoother(n: int, strength: float) -> np.ndarray:
    """Matrix that takes n samples to the least squares of their distance and ``strength`` times their second differences."""
    normal = np.eye(n)
    for row in range(n - 2):  # each second difference adds its own square
        normal[row : row + 3, row : row + 3] += strength * np.outer((1, -2, 1), (1, -2, 1))
    return np.linalg.inv(normal)


def variational_smooth(df: DataFrame, unit: str, order: list[str], value: str, strength: float = 10.0, window: int = 128, out: str = "smooth") -> DataFrame:
    """Least squares with a penalty on acceleration, in windows that overlap by half.

    A row goes to each window over it, every window is solved by itself, in a task of its own if
    need be, and a row's solutions are averaged by a Hann taper. So a unit of any length is many
    small groups. Units of fewer than five rows stay as they are.
    """
    if strength <= 0 or window < 5:
        return df.withColumn(out, F.col(value).cast("double"))
    w = in_order(unit, order)
    rows = df.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count("*").over(whole(unit))})
    size = F.least(F.lit(window), F.col("_n")).cast("int")
    half = F.greatest(F.lit(1), F.floor(size / 2)).cast("int")
    last = (F.col("_n") - size).cast("int")
    first = F.greatest(F.lit(0), F.ceil((F.col("_i") - size + 1) / half)).cast("int")
    most = F.least(F.floor(F.col("_i") / half), F.floor(last / half)).cast("int")
    regular = F.when(first <= most, F.transform(F.sequence(first, most), lambda k: (k * half).cast("int"))).otherwise(F.array().cast("array<int>"))
    starts = F.when(F.col("_i") >= last, F.array_union(regular, F.array(last))).otherwise(regular)
    dealt = rows.filter("_n >= 5").select(F.col(unit).alias("_u"), "_i", F.col(value).cast("double").alias("_x"), size.alias("_w"), F.explode(starts).alias("_s"))

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("_i")
        x = table.column("_x").to_numpy()
        taper = np.hanning(len(x)) + 1e-6
        return pa.table({"_u": table.column("_u"), "_i": table.column("_i"), "_y": taper * (bending_smoother(len(x), strength) @ x), "_t": taper})

    kind = dict(df.dtypes)[unit]
    solved = dealt.groupBy("_u", "_s").applyInArrow(solve, f"_u {kind}, _i int, _y double, _t double").groupBy("_u", "_i").agg((F.sum("_y") / F.sum("_t")).alias("_r"))
    joined = rows.join(solved, (F.col(unit) == F.col("_u")) & (rows["_i"] == solved["_i"]), "left")
    return joined.select(*(rows[c] for c in df.columns), F.coalesce("_r", F.col(value).cast("double")).alias(out))


def blend(original: Column, refined: Column, strength: float) -> Column:
    """(1 - s) x + s y of two arrays; an error where their lengths differ."""
    mixed = F.zip_with(original, refined, lambda x, y: (1 - strength) * x + strength * y)
    return F.when(F.size(original) == F.size(refined), mixed).otherwise(F.raise_error(F.lit("refined array has another length")))


#: Ways to refine a series by name; each takes (df, unit, order, value, out=...).
REFINERS = {"savgol": savgol, "confidence": confidence_smooth, "variational": variational_smooth}


def refine(df: DataFrame, method: str, unit: str, order: list[str], value: str, strength: float = 1.0, out: str = "refined", **options) -> DataFrame:
    """``df`` with its value blended with a method's refined one; ``none`` leaves it as it is."""
    if method == "none":
        return df.withColumn(out, F.col(value))
    if method not in REFINERS:
        raise ValueError(f"no refiner {method}; there are none, {', '.join(REFINERS)}")
    got = REFINERS[method](df, unit, order, value, out="_refined", **options)
    return got.withColumn(out, (1 - strength) * F.col(value) + strength * F.col("_refined")).drop("_refined")
