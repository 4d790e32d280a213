"""The 24-joint skeleton: offsets, kinematics, retarget tables, text export."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rotations import PARENTS, euler_zyx_degrees, matrix_of_axis_angle, rotate

#: Names of the joints, and bone names of two rigs.
JOINTS = (
    "Pelvis", "L_Hip", "R_Hip", "Spine1", "L_Knee", "R_Knee", "Spine2", "L_Ankle", "R_Ankle", "Spine3", "L_Foot", "R_Foot",
    "Neck", "L_Collar", "R_Collar", "Head", "L_Shoulder", "R_Shoulder", "L_Elbow", "R_Elbow", "L_Wrist", "R_Wrist", "L_Hand", "R_Hand",
)
MIXAMO = (
    "Hips", "LeftUpLeg", "RightUpLeg", "Spine", "LeftLeg", "RightLeg", "Spine1", "LeftFoot", "RightFoot", "Spine2", "LeftToeBase", "RightToeBase",
    "Neck", "LeftShoulder", "RightShoulder", "Head", "LeftArm", "RightArm", "LeftForeArm", "RightForeArm", "LeftHand", "RightHand", None, None,
)
UE5 = (
    "pelvis", "thigh_l", "thigh_r", "spine_01", "calf_l", "calf_r", "spine_02", "foot_l", "foot_r", "spine_03", "ball_l", "ball_r",
    "neck_01", "clavicle_l", "clavicle_r", "head", "upperarm_l", "upperarm_r", "lowerarm_l", "lowerarm_r", "hand_l", "hand_r", None, None,
)
TARGETS = {"mixamo": ("mixamorig:", MIXAMO), "ue5": ("", UE5), "smpl": ("", JOINTS)}


def joint_table(spark: SparkSession, target: str = "smpl") -> DataFrame:
    """(joint, name, parent, bone) of the skeleton; bone is null where the rig has none."""
    prefix, bones = TARGETS[target]
    rows = [(j, n, PARENTS[j] if PARENTS[j] >= 0 else None, b and prefix + b) for j, (n, b) in enumerate(zip(JOINTS, bones, strict=True))]
    return spark.createDataFrame(rows, "joint int, name string, parent int, bone string")


def rest_joints(weights: DataFrame, vertices: DataFrame) -> DataFrame:
    """(joint, x, y, z) from (joint, vid, w) and (vid, x, y, z): each joint's weighted vertices."""
    return weights.join(vertices, "vid").groupBy("joint").agg(*(F.sum(F.col("w") * F.col(a)).alias(a) for a in "xyz"))


def rest_offsets(rest: DataFrame, joints: DataFrame) -> DataFrame:
    """(joint, name, parent_name, bone, offset, length): every joint from its parent, in metres."""
    up = joints.join(rest, "joint").select(F.col("joint").alias("parent"), F.col("name").alias("parent_name"), *(F.col(a).alias(f"p{a}") for a in "xyz"))
    d = [F.coalesce(F.col(a) - F.col(f"p{a}"), F.lit(0.0)) for a in "xyz"]
    length = F.sqrt(sum((x * x for x in d[1:]), d[0] * d[0]))
    return joints.join(rest, "joint").join(up, "parent", "left").select("joint", "name", "parent_name", "bone", F.array(*(F.round(x, 6) for x in d)).alias("offset"), F.round(length, 6).alias("length"))


def retarget_config(rest: DataFrame, target: str) -> DataFrame:
    """One row with the JSON of a rig's bone map, parents, offsets, lengths and unmapped joints."""
    t = rest_offsets(rest, joint_table(rest.sparkSession, target))
    rows = F.array_sort(F.collect_list(F.struct("joint", "name", "parent_name", "bone", "offset", "length")))
    as_map = lambda c: F.map_from_entries(F.transform("r", lambda s: F.struct(s["name"], s[c])))
    one = t.agg(rows.alias("r"))  # 24 rows
    unmapped = F.array_sort(F.transform(F.filter("r", lambda s: s["bone"].isNull()), lambda s: s["name"]))
    body = F.struct(
        F.lit("smpl24").alias("source"), F.lit(target).alias("target"), as_map("bone").alias("bone_map"), as_map("parent_name").alias("parents"),
        as_map("offset").alias("rest_offsets_m"), as_map("length").alias("rest_lengths_m"), unmapped.alias("unmapped"),
    )
    return one.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("config"))


def _matrices(v: np.ndarray) -> np.ndarray:
    angle = np.linalg.norm(v, axis=-1, keepdims=True)
    x, y, z = np.moveaxis(v / np.where(angle < 1e-8, 1.0, angle), -1, 0)
    zero = np.zeros_like(x)
    k = np.stack([zero, -z, y, z, zero, -x, -y, x, zero], -1).reshape(*x.shape, 3, 3)
    return np.eye(3) + np.sin(angle)[..., None] * k + (1 - np.cos(angle))[..., None] * (k @ k)


def global_rotations(frames: DataFrame, pose: str, out: str = "global_rotation") -> DataFrame:
    """``frames`` with the 24 joints' world rotations (9 numbers each): products down the tree, many frames at a time."""

    @F.pandas_udf("array<double>")
    def turn(poses: pd.Series) -> pd.Series:
        local = _matrices(np.array(poses.tolist(), np.float64).reshape(len(poses), 24, 3))
        world = local.copy()
        for j, p in enumerate(PARENTS):
            if p >= 0:
                world[:, j] = world[:, p] @ local[:, j]
        return pd.Series(list(world.reshape(len(poses), -1)))

    return frames.withColumn(out, turn(pose))


def _children() -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for j, p in enumerate(PARENTS):
        out.setdefault(p, []).append(j)
    return out


def depth_first() -> list[int]:
    """Joints from the root down, each before its children, as a hierarchy lists them and its channels follow."""
    children, order, waiting = _children(), [], [0]
    while waiting:
        order.append(waiting.pop())
        waiting += reversed(children.get(order[-1], []))
    return order


def bvh_hierarchy(offsets: dict[str, list[float]], scale: float = 100.0) -> str:
    """Header of motion capture text: joints depth first with their offsets; a leaf's end lies as far on as its bone is long."""
    children = _children()

    def block(j: int, depth: int) -> list[str]:
        pad, inner = "\t" * depth, "\t" * (depth + 1)
        place = "OFFSET " + " ".join(f"{v * scale:.6f}" for v in ([0.0] * 3 if depth == 0 else offsets[JOINTS[j]]))
        channels = "CHANNELS 6 Xposition Yposition Zposition Zrotation Yrotation Xrotation" if depth == 0 else "CHANNELS 3 Zrotation Yrotation Xrotation"
        lines = [f"{pad}{'JOINT' if depth else 'ROOT'} {JOINTS[j]}", pad + "{", inner + place, inner + channels]
        for c in children.get(j, []):
            lines += block(c, depth + 1)
        if j not in children:
            lines += [inner + "End Site", inner + "{", inner + "\t" + place, inner + "}"]
        return [*lines, pad + "}"]

    return "\n".join(["HIERARCHY", *block(0, 0)])


def bvh_text(frames: DataFrame, unit: str, frame: str, pose: str, trans: str, offsets: dict[str, list[float]], fps: float, scale: float = 100.0) -> DataFrame:
    """(unit, frames, text): each unit's motion capture text, metres times ``scale``: the hierarchy, then a line for
    each frame with the root's place and the angles about Z, Y and X of every joint, depth first.
    """
    order = F.array(*map(F.lit, depth_first()))
    turns = F.flatten(F.transform(order, lambda j: euler_zyx_degrees(matrix_of_axis_angle(F.slice(pose, 3 * j + 1, 3)))))
    numbers = F.concat(F.transform(trans, lambda v: v * scale), turns)
    line = F.array_join(F.transform(numbers, lambda v: F.format_string("%.6f", v)), " ")
    each = frames.groupBy(unit).agg(F.count("*").alias("frames"), F.array_sort(F.collect_list(F.struct(F.col(frame).alias("f"), line.alias("l")))).alias("_r"))
    head = F.concat(F.lit(bvh_hierarchy(offsets, scale) + "\nMOTION\nFrames: "), F.col("frames").cast("string"), F.lit(f"\nFrame Time: {1.0 / fps:.8f}\n"))
    return each.select(unit, "frames", F.concat(head, F.array_join(F.transform("_r", lambda r: r["l"]), "\n"), F.lit("\n")).alias("text"))


def _root_path(frames: DataFrame, unit: str, frame: str, vector: str, *carried: Column) -> DataFrame:
    """(unit, frame, _q, _x, _h, _z, carried): a root's turn and path out of 263-number frames.

    Sorted are the root's four numbers and what is carried, not the vectors.
    """
    w = Window.partitionBy(unit).orderBy(frame)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    narrow = frames.select(unit, frame, *(F.get(vector, F.lit(i)).alias(n) for i, n in enumerate(("_turn", "_vx", "_vz", "_h"))), *carried)
    turned = narrow.withColumns({"_a": F.coalesce(F.sum("_turn").over(before), F.lit(0.0)), "_px": F.coalesce(F.lag("_vx").over(w), F.lit(0.0)), "_pz": F.coalesce(F.lag("_vz").over(w), F.lit(0.0))}).drop("_turn", "_vx", "_vz")
    turned = turned.withColumn("_q", F.array(F.cos("_a"), F.lit(0.0) * F.col("_a"), F.sin("_a"), F.lit(0.0) * F.col("_a"))).drop("_a")
    step = rotate(F.col("_q"), F.array(F.col("_px"), F.lit(0.0), F.col("_pz")), inverse=True)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    stepped = turned.withColumns({"_sx": F.get(step, F.lit(0)), "_sz": F.get(step, F.lit(2))}).drop("_px", "_pz")
    return stepped.withColumns({"_x": F.sum("_sx").over(run), "_z": F.sum("_sz").over(run)}).drop("_sx", "_sz")


def feature_root(frames: DataFrame, unit: str, frame: str, vector: str) -> DataFrame:
    """(unit, frame, x, y, z) of the root alone, out of 263-number frames; no joint's places are sorted or worked out."""
    return _root_path(frames, unit, frame, vector).select(unit, frame, F.col("_x").alias("x"), F.col("_h").alias("y"), F.col("_z").alias("z"))


def feature_joints(frames: DataFrame, unit: str, frame: str, vector: str) -> DataFrame:
    """(unit, frame, joint, x, y, z) of 263-number frames: the root's turn and path integrated, then each joint turned and moved.

    The vector holds the root's turning speed, its velocity across the floor, its height,
    and 21 joints' places from the root.
    """
    moved = _root_path(frames, unit, frame, vector, F.slice(vector, 5, 63).alias("_v"))
    place = lambda j: F.array(*(F.get("_v", 3 * j + c) for c in range(3)))
    # The root is joint 0, at its own place whatever way it has turned.
    joints = F.transform(F.sequence(F.lit(0), F.lit(20)), place)
    each = moved.select(unit, frame, "_q", "_x", "_h", "_z", F.posexplode(F.concat(F.array(F.lit(None).cast("array<double>")), joints)).alias("joint", "_p"))
    turned = each.withColumn("_r", F.when(F.col("joint") > 0, rotate(F.col("_q"), F.col("_p"), inverse=True)).otherwise(F.array(F.lit(0.0), F.col("_h"), F.lit(0.0))))
    return turned.select(unit, frame, "joint", (F.get("_r", F.lit(0)) + F.col("_x")).alias("x"), F.get("_r", F.lit(1)).alias("y"), (F.get("_r", F.lit(2)) + F.col("_z")).alias("z"))


def bvh_lines(frames: DataFrame, unit: str, frame: str, pose: str, trans: str, offsets: dict[str, list[float]], fps: float, scale: float = 100.0) -> DataFrame:
    """(unit, no, line): the same text a line a row, ``no`` in order: a unit of any length is many rows."""
    order = F.array(*map(F.lit, depth_first()))
    turns = F.flatten(F.transform(order, lambda j: euler_zyx_degrees(matrix_of_axis_angle(F.slice(pose, 3 * j + 1, 3)))))
    numbers = F.concat(F.transform(trans, lambda v: v * scale), turns)
    line = F.array_join(F.transform(numbers, lambda v: F.format_string("%.6f", v)), " ")
    head = bvh_hierarchy(offsets, scale).split("\n")
    start = [*head, "MOTION"]
    n = frames.groupBy(unit).agg(F.count("*").alias("_n"))
    lines = F.concat(F.array(*map(F.lit, start)), F.array(F.concat(F.lit("Frames: "), F.col("_n").cast("string")), F.lit(f"Frame Time: {1.0 / fps:.8f}")))
    top = n.select(unit, F.posexplode(lines).alias("no", "line")).select(unit, F.col("no").cast("long").alias("no"), "line")
    return top.unionByName(frames.select(unit, (F.col(frame) + len(start) + 2).cast("long").alias("no"), line.alias("line")))


def write_bvh(lines: DataFrame, unit: str, path: str) -> None:
    """``bvh_lines`` as text, a folder for each unit; a long unit's files follow each other by name."""
    lines.repartitionByRange(unit, "no").sortWithinPartitions(unit, "no").select(unit, "line").write.partitionBy(unit).text(path)
