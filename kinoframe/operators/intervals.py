"""Half-open time spans in seconds: merge, split, slice, pack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranges
from .folds import fold_sorted, packed_windows


def merge_short(scenes: DataFrame, unit: str, min_seconds: float, start: str = "start", end: str = "end") -> DataFrame:
    """(unit, start, end): scenes under ``min_seconds`` join the one before; a short first one joins the next.

    A scene starts a span when it is long or first, so spans are counted, not folded:
    only a unit's first span can then be short, and it joins the second.
    """
    w = Window.partitionBy(unit).orderBy(start, end)
    opens = (F.col(end) - F.col(start) >= min_seconds) | (F.row_number().over(w) == 1)
    marked = scenes.select(unit, start, end, F.sum(opens.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_k"))
    spans = marked.groupBy(unit, "_k").agg(F.min(start).alias(start), F.max_by(end, F.struct(start, end)).alias(end))
    first = F.col("_k") == 1
    short = first & (F.col(end) - F.col(start) < min_seconds)
    by_k = Window.partitionBy(unit).orderBy("_k")
    spans = spans.withColumns({"_short": short, "_n": F.count("*").over(Window.partitionBy(unit))})
    spans = spans.withColumn(start, F.when((F.col("_k") == 2) & F.lag("_short").over(by_k), F.lag(start).over(by_k)).otherwise(F.col(start)))
    return spans.filter(~(F.col("_short") & (F.col("_n") > 1))).select(unit, start, end)


def even_split(spans: DataFrame, max_seconds: float, start: str = "start", end: str = "end") -> DataFrame:
    """Spans longer than ``max_seconds`` in the fewest equal parts; the last ends where the span does."""
    length = F.col(end) - F.col(start)
    n = F.greatest(F.lit(1), F.ceil(length / max_seconds)).cast("int")
    parts = spans.withColumns({"_n": n, "_step": length / n}).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    a = F.col(start) + F.col("_i") * F.col("_step")
    b = F.when(F.col("_i") < F.col("_n") - 1, F.col(start) + (F.col("_i") + 1) * F.col("_step")).otherwise(F.col(end))
    return parts.withColumns({"_a": a, "_b": b}).drop(start, end, "_n", "_step", "_i").withColumnsRenamed({"_a": start, "_b": end})


def plan_segments(scenes: DataFrame, videos: DataFrame, unit: str, max_seconds: float, min_seconds: float, duration: str = "duration") -> DataFrame:
    """(unit, seg_index, start, end) of every video: its scenes merged and split; without scenes the whole duration."""
    none = videos.join(scenes.select(unit).distinct(), unit, "left_anti").select(unit, F.lit(0.0).alias("start"), F.col(duration).cast("double").alias("end"))
    spans = even_split(merge_short(scenes.select(unit, "start", "end").unionByName(none), unit, min_seconds), max_seconds)
    index = F.row_number().over(Window.partitionBy(unit).orderBy("start", "end")) - 1
    return spans.select(unit, index.alias("seg_index"), F.bround("start", 3).alias("start"), F.bround("end", 3).alias("end"))


def frame_times(start: Column, end: Column, rate: float, most: int) -> Column:
    """Midpoints of equal parts of a span, at ``rate`` a second and ``most`` at most; the start of an empty span."""
    length = F.greatest(F.lit(0.0), end - start)
    n = F.least(F.lit(most), F.greatest(F.lit(1), F.floor(length * rate).cast("int")))
    times = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.bround(start + (i + 0.5) * (length / n), 3))
    return F.when((length <= 0) | F.lit(rate <= 0), F.array(start)).otherwise(times)


def frame_range(start: Column, end: Column, fps: Column, n: Column) -> tuple[Column, Column]:
    """First frame and end frame of a span of seconds in a clip of ``n`` frames."""
    return F.greatest(F.lit(0), F.bround(start * fps)).cast("long"), F.least(n, F.bround(end * fps)).cast("long")


def slice_frames(frames: DataFrame, spans: DataFrame, unit: str, frame: str = "frame_idx", fps: float = 20.0, bin_frames: int = 256) -> DataFrame:
    """Frames of each span (unit, span_id, start, end): a range join in bins, so a long unit isn't met frame by span.

    Spans of fewer than two frames give none.
    """
    n = frames.groupBy(unit).agg((F.max(frame) + 1).alias("_n"))
    i0, i1 = frame_range(F.col("start"), F.col("end"), F.lit(fps), F.col("_n"))
    cut = spans.join(n, unit).select(unit, "span_id", i0.alias("_i0"), i1.alias("_i1")).filter("_i1 - _i0 >= 2")
    bins = cut.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_i0") / bin_frames), F.floor((F.col("_i1") - 1) / bin_frames))))
    dealt = frames.withColumn("_bin", F.floor(F.col(frame) / bin_frames))
    return dealt.join(bins, [unit, "_bin"]).filter(F.col(frame).between(F.col("_i0"), F.col("_i1") - 1)).drop("_bin", "_i0", "_i1")


def greedy_windows(rows: DataFrame, unit: str, seconds: float, start: str = "start", end: str = "end", out: str = "window", spread: bool = False) -> DataFrame:
    """Rows with the number of their window: a row joins while its end is within ``seconds`` of the window's start.

    With ``spread`` a unit's rows are dealt out by ranges.
    """
    if spread:
        return ranges.packed_windows(rows, unit, [start, end], start, end, seconds, out)
    return fold_sorted(rows, unit, [start, end], [start, end], packed_windows(seconds), out, "long")


def windows(rows: DataFrame, unit: str, seconds: float, entry: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(unit, window, start, end, entries): the windows with their rows in order."""
    packed = greedy_windows(rows, unit, seconds, start, end)
    items = F.array_sort(F.collect_list(F.struct(F.col(start).alias("start"), F.col(end).alias("end"), *[c for c in entry if c not in ("start", "end")])))
    return packed.groupBy(unit, "window").agg(F.min(start).alias("start"), F.max(end).alias("end"), items.alias("entries"))


def finetune_payload(windows_: DataFrame, unit: str, prompt: str) -> DataFrame:
    """(unit, window, payload): JSON of a window's conversation, times from its start to two places."""
    base = F.col("start")
    answer = F.to_json(F.transform("entries", lambda e: F.struct(F.bround(e["start"] - base, 2).alias("start"), F.bround(e["end"] - base, 2).alias("end"), e["description"].alias("description"), e["tags"].alias("tags"))))
    turns = F.array(F.struct(F.lit("user").alias("role"), F.lit(prompt).alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    payload = F.to_json(F.struct(F.col(unit).alias("video"), F.array("start", "end").alias("window"), turns.alias("messages")))
    return windows_.select(unit, "window", payload.alias("payload"))
