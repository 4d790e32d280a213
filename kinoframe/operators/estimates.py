"""Estimators' detections as motion, whatever names and forms they use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rotations import axis_angle_of_matrix, body_pose, hand_pose
from ..sources.readers import first_present, first_value
from .motion import longest_track, subject_frames

#: Names that estimators give to a body's joints, its world orientation, places, tracks and frames.
POSE = ("smpl_thetas", "poses", "pose")
WORLD_ORIENTATION = ("world_global_rotmat", "world_global_rots", "global_rotmat")
TRACK = ("track_ids", "track_id", "subject_ids")
FRAME = ("reorganize_idx", "frame_ids", "frame_id")
PLACES = {True: ("world_trans", "cam_trans"), False: ("cam_trans", "world_trans")}


def subject_motion(detections: DataFrame, unit: str, world: bool = True) -> DataFrame:
    """(unit, frame_idx, pose, trans) of the person seen most: detections of all frames and tracks, by whatever names they go.

    With ``world`` a world orientation, if there is one, takes the place of the camera's.
    """
    none = F.array_repeat(F.lit(0.0), 3)
    theta = first_value(detections, *POSE)
    rows = detections.select(
        unit, F.coalesce(first_value(detections, *TRACK).cast("string"), F.lit("")).alias("track"), first_value(detections, *FRAME).cast("long").alias("frame"), theta.alias("theta"),
        first_value(detections, *WORLD_ORIENTATION).alias("world"), F.coalesce(first_value(detections, *PLACES[world]), none).alias("trans"),
    )
    turned = F.when(F.lit(world) & F.col("world").isNotNull(), axis_angle_of_matrix(F.col("world").cast("array<double>"))).otherwise(F.slice("theta", 1, 3))
    subject = subject_frames(rows, unit, "track", ["frame"])
    return subject.select(unit, F.col("place").alias("frame_idx"), body_pose(turned, F.slice("theta", 4, 69)).alias("pose"), "trans")


def longest_track_motion(detections: DataFrame, unit: str, track: str, frame: str) -> DataFrame:
    """Detections of each unit's longest track."""
    lengths = detections.groupBy(unit, track).agg(F.count("*").alias("n"))
    return detections.join(longest_track(lengths, unit, track, "n").select(unit, track), [unit, track])


@dataclass(frozen=True)
class Form:
    """How an estimator writes a detection: names of its columns, first those of the world's frame, and whose rows count.

    ``whole`` columns hold all of a body's joints, ``joints`` of them, in axis-angle or matrices; without them
    ``orient`` and ``body`` do. ``subject`` is ``longest`` (track), ``most`` (frames, of equals the one seen first) or
    ``only``, where a second detection of a frame is an error.
    """

    whole: tuple[tuple[str, ...], tuple[str, ...]] = ((), ())
    joints: int = 24
    orient: tuple[str, ...] = ()
    body: tuple[str, ...] = ()
    places: tuple[tuple[str, ...], tuple[str, ...]] = ((), ())
    hands: tuple[tuple[str, ...], tuple[str, ...]] = ((), ())
    subject: str = "longest"
    place_needed: bool = True


def _both(*names: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    return names, names


#: The forms of estimators by name; names in the world's frame, then in the camera's.
FORMS = {
    "gvhmr": Form(orient=("global_orient",), body=("body_pose",), places=_both("transl"), subject="only"),
    "wham": Form(whole=(("pose_world", "pose"), ("pose",)), places=(("trans_world", "trans"), ("trans",))),
    "tram": Form(whole=_both("pred_rotmat", "rotmat"), places=(("pred_trans_world", "pred_trans"), ("pred_trans",))),
    "4dhumans": Form(orient=("global_orient",), body=("body_pose",), places=_both("camera"), subject="most", place_needed=False),
    "hybrik": Form(whole=_both("pred_thetas", "pred_theta_mats"), joints=55, places=_both("transl"), subject="only", place_needed=False),
    "smplx_frames": Form(
        orient=("global_orient", "root_pose"), body=("body_pose",), places=_both("transl", "trans", "cam_trans"),
        hands=(("left_hand_pose", "lhand_pose"), ("right_hand_pose", "rhand_pose")), subject="only", place_needed=False,
    ),
}
#: Of 55 joints those of the body after the root, of the left and of the right hand, first and number.
BODY_55, HANDS_55 = (1, 21), ((25, 15), (40, 15))


def _needed(detections: DataFrame, method: str, names: tuple[str, ...], what: str) -> Column:
    c = first_present(detections, *names)
    if c is None:
        raise ValueError(f"{method} detections have no {what}: none of {', '.join(names)} among {', '.join(detections.columns)}")
    return first_value(detections, *names).cast("array<double>")


def motion_of(method: str, detections: DataFrame, unit: str, frame: str, track: str | None = None, world: bool = True) -> DataFrame:
    """(unit, frame_idx, pose, trans, left_hand, right_hand) of each unit's subject, out of an estimator's own form.

    A frame's number is its place among the subject's frames. A hand that the form doesn't give is null, a place
    that it needn't give is the origin.
    """
    if method.lower() not in FORMS:
        raise ValueError(f"no form {method}; there are {', '.join(sorted(FORMS))}")
    form, side = FORMS[method.lower()], 0 if world else 1
    hands: list[Column] = [F.lit(None).cast("array<double>")] * 2
    if form.whole[side]:
        whole = _needed(detections, method, form.whole[side], "pose")
        # Three numbers a joint, or nine: matrices.
        size = F.when(F.size(whole) == 9 * form.joints, 9).when(F.size(whole) == 3 * form.joints, 3).otherwise(F.raise_error(F.format_string(f"{method} pose of %d numbers for {form.joints} joints", F.size(whole))).cast("int"))
        part = lambda first, n: F.slice(whole, first * size + 1, n * size)
        first, n = BODY_55 if form.joints == 55 else (1, form.joints - 1)
        orient, body = part(0, 1), part(first, n)
        if form.joints == 55:
            hands = [hand_pose(part(*h)) for h in HANDS_55]
    else:
        orient, body = _needed(detections, method, form.orient, "orientation"), _needed(detections, method, form.body, "body")
    for k, names in enumerate(form.hands):
        if names and first_present(detections, *names) is not None:
            given = first_value(detections, *names).cast("array<double>")
            hands[k] = F.when(given.isNotNull(), hand_pose(given))
    origin = F.array_repeat(F.lit(0.0), 3)
    if form.place_needed:
        trans = _needed(detections, method, form.places[side], "place")
    else:
        trans = F.coalesce(first_value(detections, *form.places[side]).cast("array<double>"), origin)
    name = F.lit("") if track is None else F.coalesce(F.col(track).cast("string"), F.lit(""))
    rows = detections.select(unit, F.col(frame).alias("_f"), name.alias("_t"), body_pose(orient, body).alias("pose"), trans.alias("trans"), hands[0].alias("left_hand"), hands[1].alias("right_hand"))
    if form.subject == "longest":
        lengths = rows.groupBy(unit, "_t").agg(F.count("*").alias("_n"))
        rows = rows.join(longest_track(lengths, unit, "_t", "_n").select(unit, "_t"), [unit, "_t"])
    elif form.subject == "only":
        twice = rows.groupBy(unit, "_f").agg(F.count("*").alias("_n")).select(unit, "_f", F.when(F.col("_n") > 1, F.raise_error(F.format_string(f"%d {method} detections in one frame", "_n")).cast("boolean")).alias("_one"))
        rows = rows.join(twice, [unit, "_f"]).filter("_one IS NULL").withColumn("_t", F.lit("")).drop("_one")
    out = subject_frames(rows, unit, "_t", ["_f"])
    return out.select(unit, F.col("place").alias("frame_idx"), "pose", "trans", "left_hand", "right_hand")
