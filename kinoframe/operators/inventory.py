"""Inventories of files and the state of their processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import camera_of, glob_match, stable_id, suffix

#: Joints of each body region.
REGIONS = {
    "legs": (1, 2, 4, 5, 7, 8, 10, 11),
    "left_leg": (1, 4, 7, 10),
    "right_leg": (2, 5, 8, 11),
    "feet": (10, 11),
    "arms": (13, 14, 16, 17, 18, 19, 20, 21, 22, 23),
    "left_arm": (13, 16, 18, 20, 22),
    "right_arm": (14, 17, 19, 21, 23),
    "hands": (22, 23),
    "head": (12, 15),
    "lower_body": (1, 2, 4, 5, 7, 8, 10, 11),
}
#: Columns of state that a rescan keeps, with what a new file gets.
STATE = {"status": "pending", "error": None, "n_frames": None, "note": None}


def media_files(paths: DataFrame, extensions: list[str], depth: int = 1, path: str = "rel_path") -> DataFrame:
    """Rows whose suffix is listed, in whatever case, with a stable id and a camera."""
    p = F.col(path)
    listed = paths.filter(suffix(p).isin([e.lower() for e in extensions]))
    return listed.withColumns({"clip_id": stable_id(p), "camera": camera_of(p, depth)})


def exclude(clips: DataFrame, ids: list[str] = (), patterns: list[str] = (), note: str | None = None, path: str = "rel_path") -> DataFrame:
    """Clips matched by id or glob become excluded; those already so keep their note."""
    hit = (F.col("clip_id").isin(list(ids)) | glob_match(F.col(path), list(patterns))) & (F.col("status") != "excluded")
    return clips.withColumns({"note": F.when(hit, F.lit(note)).otherwise(F.col("note")), "status": F.when(hit, "excluded").otherwise(F.col("status"))})


def include(clips: DataFrame, ids: list[str] = (), patterns: list[str] = (), path: str = "rel_path") -> DataFrame:
    """Excluded clips matched by id or glob become pending and lose their note."""
    hit = (F.col("clip_id").isin(list(ids)) | glob_match(F.col(path), list(patterns))) & (F.col("status") == "excluded")
    return clips.withColumns({"note": F.when(~hit, F.col("note")), "status": F.when(hit, "pending").otherwise(F.col("status"))})


def rescan(fresh: DataFrame, known: DataFrame, key: str = "clip_id") -> DataFrame:
    """Files found now with the state they had; new ones start afresh and vanished ones go.

    All columns of ``known`` that ``fresh`` lacks are state; ``STATE`` has defaults.
    """
    state = [c for c in known.columns if c != key and c not in fresh.columns]
    joined = fresh.join(known.select(key, *state, F.lit(True).alias("_known")), key, "left")
    fill = {c: F.when(F.col("_known"), F.col(c)).otherwise(F.lit(STATE.get(c)).cast(known.schema[c].dataType)) for c in state}
    return joined.withColumns(fill).drop("_known")


def todo(clips: DataFrame, statuses: list[str], limit: int | None = None, path: str = "rel_path") -> DataFrame:
    """Clips to process, in path order."""
    out = clips.filter(F.col("status").isin(list(statuses))).orderBy(path)
    return out if limit is None else out.limit(limit)


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"))


def status_totals(df: DataFrame, status: str, frames: str, fps: float, flags: dict[str, Column]) -> DataFrame:
    """Per status: rows, frames, hours, and rows with each flag."""
    total = F.sum(F.coalesce(F.col(frames), F.lit(0)))
    return df.groupBy(F.col(status).alias("status")).agg(
        F.count("*").alias("n"), total.alias("frames"), F.round(total / fps / 3600, 6).alias("hours"), *(F.count_if(c).alias(k) for k, c in flags.items())
    )


def gate_videos(clips: DataFrame, activity: str, shift: str, min_activity: float, min_shift: float) -> DataFrame:
    """Clips with too little activity are excluded; the others are tagged static or moving by the camera's shift."""
    idle = F.col(activity) < min_activity
    return clips.withColumns({
        "status": F.when(idle, "excluded").otherwise(F.col("status")),
        "camera_motion": F.when(~idle, F.when(F.col(shift) < min_shift, "static").otherwise("moving")),
    })


def occluded_joints(cameras: DataFrame, camera: str = "camera", region: str = "region", partial: str | None = None) -> DataFrame:
    """(camera, joints): union of the joints of each camera's hidden regions, and of the legs where ``partial`` is true; an unknown region is an error."""
    known = F.create_map(*(x for k, v in REGIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    joints = F.get(F.array(known[F.lower(F.trim(F.col(region)))]), F.lit(0))
    checked = F.when(joints.isNotNull(), joints).otherwise(F.raise_error(F.concat(F.lit("unknown body region: "), F.col(region))))
    none = F.array().cast("array<int>")
    hidden = F.when(F.col(region).isNull(), none).otherwise(checked)
    if partial is not None:
        hidden = F.array_union(hidden, F.when(F.col(partial), F.array(*map(F.lit, REGIONS["legs"]))).otherwise(none))
    each = cameras.select(camera, F.explode_outer(hidden).alias("joint"))
    return each.groupBy(camera).agg(F.array_sort(F.collect_set("joint")).alias("joints"))


def joint_mask(tagged: Column, inferred: Column, joints: int = 24) -> Column:
    """True for each joint outside both lists; null if both are empty."""
    none = F.array().cast("array<int>")
    bad = F.array_union(F.coalesce(tagged, none), F.coalesce(inferred, none))
    mask = F.transform(F.sequence(F.lit(0), F.lit(joints - 1)), lambda j: ~F.array_contains(bad, j))
    return F.when(F.size(bad) > 0, mask)


def checked_unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, or an error when it is read if a key comes twice."""
    n = df.groupBy(key).agg(F.count("*").alias("_n"))
    ok = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("repeated key: "), F.col(key).cast("string"))))
    return df.join(n.select(key, ok.alias("_ok")), key).filter("_ok").drop("_ok")
