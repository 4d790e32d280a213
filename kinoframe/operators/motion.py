"""Verdicts over motion: quality, handedness, frozen channels, features, tracks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rotations import mirror_hand, mirror_pose, mirror_position
from . import ranges
from .series import in_order

#: Issues that no real movement has.
HARD_ISSUES = ("non_finite", "root_teleport", "pose_jump")


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < float("inf"))


def quality_verdict(df: DataFrame, unit: str, order: list[str], root: str, pose: str, fps: float, max_speed: float = 12.0, max_step: float = 1.5, min_motion: float = 1e-3) -> DataFrame:
    """(unit, issues): what is wrong with each unit's motion; a non-finite value is its only issue."""
    w = in_order(unit, order)
    steps = df.select(
        unit, (~finite(F.col(root)) | ~finite(F.col(pose))).alias("_bad"),
        (F.abs(F.col(root) - F.lag(root).over(w)) * fps).alias("_v"), F.abs(F.col(pose) - F.lag(pose).over(w)).alias("_s"),
    )
    got = steps.groupBy(unit).agg(F.bool_or("_bad").alias("_bad"), F.max("_v").alias("_v"), F.max("_s").alias("_s"), F.avg("_s").alias("_m"))
    rules = [("root_teleport", F.col("_v") > max_speed), ("pose_jump", F.col("_s") > max_step), ("static_low_motion", F.col("_m") < min_motion)]
    issues = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules)), lambda x: x.isNotNull())
    return got.select(unit, F.when(F.col("_bad"), F.array(F.lit("non_finite"))).otherwise(issues).alias("issues"))


def is_hard(issues: Column) -> Column:
    return F.arrays_overlap(issues, F.array(*map(F.lit, HARD_ISSUES)))


def quality_union(verdicts: DataFrame, clip: str, issues: str = "issues") -> DataFrame:
    """(clip, issues, low_quality) over a clip's units."""
    each = verdicts.select(clip, F.explode_outer(issues).alias("_i"))
    return each.groupBy(clip).agg(F.array_sort(F.collect_set("_i")).alias("issues")).withColumn("low_quality", is_hard(F.col("issues")))


def energy(df: DataFrame, unit: str, order: list[str], channel: str, value: str) -> DataFrame:
    """(unit, channel, n, energy): sum of squared steps of each channel."""
    w = Window.partitionBy(unit, channel).orderBy(*order)
    return df.withColumn("_d", F.col(value) - F.lag(value).over(w)).groupBy(unit, channel).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("_d") ** 2), F.lit(0.0)).alias("energy"))


def handedness(energies: DataFrame, unit: str, channel: str, left: list[str], right: list[str]) -> DataFrame:
    """(unit, score): (right - left) / (right + left) of the energies, 0 without any."""
    r, l = (F.coalesce(F.sum(F.when(F.col(channel).isin(k), F.col("energy"))), F.lit(0.0)) for k in (right, left))
    return energies.groupBy(unit).agg(r.alias("_r"), l.alias("_l")).select(unit, F.coalesce(F.try_divide(F.col("_r") - F.col("_l"), F.col("_r") + F.col("_l")), F.lit(0.0)).alias("score"))


def mirror_flags(scores: DataFrame, group: list[str], score: str = "score", margin: float = 0.15, least: int = 3, spread: list[str] | None = None) -> DataFrame:
    """Rows that lean against their group's median by the margin; none in groups of fewer than ``least``.

    The group's median and count come from an aggregate that joins back. Where a group may hold a large part
    of all rows, ``spread`` names columns that tell rows apart, and the median is found by ranges of the scores.
    """
    key = group or [F.lit(0).alias("_all")]
    names = group or ["_all"]
    if spread:
        keyed = scores if group else scores.withColumn("_all", F.lit(0))
        of_group = ranges.median(keyed, names, score, spread, "_med").select(*names, "_med").join(keyed.groupBy(*names).agg(F.count("*").alias("_n")), names)
    else:
        of_group = scores.groupBy(*key).agg(F.median(score).alias("_med"), F.count("*").alias("_n"))
    side = F.when(F.col("_med") >= 0, 1.0).otherwise(-1.0)
    against = (F.signum(F.col(score)) == -side) & (F.abs(F.col(score)) >= margin)
    joined = (scores if group else scores.withColumn("_all", F.lit(0))).join(of_group, names)
    return joined.withColumn("mirrored", F.when(F.col("_n") < least, F.lit(False)).otherwise(against)).drop("_med", "_n", *([] if group else ["_all"]))


def frozen_channels(energies: DataFrame, unit: str, channel: str, threshold: float = 1e-4, min_active: int = 4, min_frames: int = 3) -> DataFrame:
    """(unit, channels) that never move while at least ``min_active`` others do."""
    frozen = F.col("energy") < threshold
    of_unit = energies.groupBy(unit).agg(
        F.count_if(~frozen).alias("_active"), F.max("n").alias("_n"), F.array_sort(F.collect_list(F.when(frozen, F.col(channel)))).alias("_c")
    )
    ok = (F.col("_active") >= min_active) & (F.col("_n") >= min_frames)
    return of_unit.select(unit, F.when(ok, F.col("_c")).otherwise(F.array().cast("array<string>")).alias("channels"))


def dominant_track(frames: DataFrame, unit: str, track: str, order: list[str]) -> DataFrame:
    """(unit, track, n): the most frequent track; of equals the one seen first."""
    counts = frames.groupBy(unit, track).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("_first"))
    best = counts.groupBy(unit).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("_first"), F.col(track).alias("t"))).alias("b"))
    return best.select(unit, F.col("b.t").alias(track), (-F.col("b.m")).alias("n"))


def longest_track(tracks: DataFrame, unit: str, track: str, length: str) -> DataFrame:
    """(unit, track, length) of the longest; of equals the smallest id."""
    best = tracks.groupBy(unit).agg(F.min(F.struct((-F.col(length)).alias("m"), F.col(track).alias("t"))).alias("b"))
    return best.select(unit, F.col("b.t").alias(track), (-F.col("b.m")).alias(length))


def largest_box(detections: DataFrame, frame: list[str], box: tuple[str, str, str, str], key: str) -> DataFrame:
    """One detection for each frame, of the largest area; of equals the smallest key."""
    x0, y0, x1, y1 = map(F.col, box)
    area = (x1 - x0) * (y1 - y0)
    best = detections.groupBy(*frame).agg(F.min(F.struct((-area).alias("a"), F.col(key).alias("k"))).alias("b"))
    return best.select(*frame, F.col("b.k").alias(key), (-F.col("b.a")).alias("area"))


def clip_features(df: DataFrame, unit: str, order: list[str], channel: str, value: str, fps: float) -> DataFrame:
    """(unit, channel, mean_speed, std_speed) with the population deviation."""
    w = Window.partitionBy(unit, channel).orderBy(*order)
    speed = F.abs(F.col(value) - F.lag(value).over(w)) * fps
    return df.withColumn("_v", speed).groupBy(unit, channel).agg(F.coalesce(F.avg("_v"), F.lit(0.0)).alias("mean_speed"), F.coalesce(F.stddev_pop("_v"), F.lit(0.0)).alias("std_speed"))


def hands_by_side(detections: DataFrame, frame: list[str], is_right: str, value: str) -> DataFrame:
    """(frame, left, right, left_valid, right_valid): the first detection of each side."""
    pick = lambda side: F.min(F.when(F.col(is_right) == side, F.col(value)))
    return detections.groupBy(*frame).agg(pick(False).alias("left"), pick(True).alias("right")).withColumns({"left_valid": F.col("left").isNotNull(), "right_valid": F.col("right").isNotNull()})


def graft(body: DataFrame, hands: DataFrame, key: list[str]) -> DataFrame:
    """Body rows with the hand columns of the same frame, null where there are none."""
    return body.join(hands, key, "left")


def subject_frames(frames: DataFrame, unit: str, track: str, order: list[str]) -> DataFrame:
    """Frames of each unit's most frequent track, numbered in order: ``place`` from 0."""
    subject = dominant_track(frames, unit, track, order).select(unit, track)
    return frames.join(subject, [unit, track]).withColumn("place", F.row_number().over(in_order(unit, order)) - 1)


def stacked(frames: DataFrame, unit: str, order: list[str], value: str) -> DataFrame:
    """(unit, frames): each unit's values in order, one array of a clip's frames."""
    rows = F.array_sort(F.collect_list(F.struct(*order, value)))
    return frames.groupBy(unit).agg(F.transform(rows, lambda r: r[value]).alias("frames"))


def mirrored(motion: DataFrame) -> DataFrame:
    """Motion (pose, trans, left_hand, right_hand) seen in a mirror: twice gives it back."""
    return motion.withColumns({"pose": mirror_pose(F.col("pose")), "trans": mirror_position(F.col("trans")), "left_hand": mirror_hand(F.col("right_hand")), "right_hand": mirror_hand(F.col("left_hand"))})


def activity(frames: DataFrame, unit: str, frame: str, pixels: str) -> DataFrame:
    """(unit, activity): mean of the mean differences between neighbouring frames of grey pixels of 0 to 255; 0 below two frames."""
    before = F.lag(pixels).over(in_order(unit, [frame]))
    step = F.aggregate(F.zip_with(pixels, before, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, x: s + x) / F.size(pixels)
    return frames.withColumn("_d", F.when(before.isNotNull(), step)).groupBy(unit).agg((F.coalesce(F.avg("_d"), F.lit(0.0)) / 255.0).alias("activity"))


def camera_shift(frames: DataFrame, unit: str, frame: str, pixels: str, width: int) -> DataFrame:
    """(unit, shift): median length in pixels of the translation between neighbouring frames, by phase correlation; 0 below two frames."""

    @F.arrow_udf("double")
    def translation(before: pa.Array, now: pa.Array) -> pa.Array:
        """Batches of pictures of one size are transformed together."""
        sizes = np.where(pc.is_valid(before).to_numpy(zero_copy_only=False) & pc.is_valid(now).to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(now), 0).to_numpy(zero_copy_only=False), 0)
        sizes = np.where(sizes == pc.fill_null(pc.list_value_length(before), 0).to_numpy(zero_copy_only=False), sizes, 0)
        out = np.full(len(now), np.nan)
        for size in np.unique(sizes[sizes > 0]).tolist():
            at = np.flatnonzero(sizes == size)
            for lo in range(0, len(at), 1024):
                part = pa.array(at[lo : lo + 1024])
                a, b = (x.take(part).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1, width) for x in (before, now))
                spectrum = np.fft.fft2(a) * np.fft.fft2(b).conj()
                peak = np.fft.ifft2(spectrum / (np.abs(spectrum) + 1e-8)).real
                y, x = np.unravel_index(peak.reshape(len(part), -1).argmax(1), peak.shape[1:])
                y, x = (np.where(2 * k <= n, k, k - n) for k, n in zip((y, x), peak.shape[1:], strict=True))
                out[at[lo : lo + 1024]] = np.hypot(y, x)
        return pa.array(out, mask=np.isnan(out))

    pairs = frames.withColumn("_b", F.lag(pixels).over(in_order(unit, [frame])))
    return pairs.withColumn("_s", translation("_b", pixels)).groupBy(unit).agg(F.coalesce(F.median("_s"), F.lit(0.0)).alias("shift"))
