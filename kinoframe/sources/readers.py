"""Readers of file inventories, manifests, labels, curves, registries and motion files.

What is missing is an error where a job can't go on without it, and an empty table where it can.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import stem
from ..operators.inventory import media_files
from .folders import exists, qualified, required

_TRACK = "track_id string, person_id string, n_frames int, pose_rel string, suspected_mirrored boolean, mirrored boolean"
_CLIP = (
    "clip_id string, camera string, rel_path string, status string, error string, n_frames int, note string, partial_body boolean, suspected_mirrored boolean, "
    "mirrored boolean, low_quality boolean, quality_issues array<string>, action_cluster int, camera_motion string, unreliable_joints array<int>"
)

#: Columns that may hold a curve's step, training loss and held-out loss, first present first.
STEP_COLUMNS = ("step", "Step", "samples")
TRAIN_COLUMNS = ("loss", "train_loss", "loss_q0")
HELD_OUT_COLUMNS = ("eval_loss", "val_loss", "Eval/loss", "eval_fid", "fid", "eval_matching_score")


# --- inventories ----------------------------------------------------------------------


def scan_files(spark: SparkSession, root: str, extensions: list[str], depth: int = 1) -> DataFrame:
    """(rel_path, length, modified, clip_id, camera) of the files below ``root`` with a listed suffix, by path; their content isn't read."""
    required(spark, root, "folder")
    base = qualified(spark, root)[1].toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rel = F.substring(F.col("path"), len(base) + 2, 1 << 20)
    return media_files(files.select(rel.alias("rel_path"), "length", F.col("modificationTime").alias("modified")), extensions, depth).orderBy("rel_path")


def scan_videos(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """The same with a video's id, and without a camera."""
    return scan_files(spark, root, extensions).drop("camera").withColumnRenamed("clip_id", "video_id")


def read_manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Clips of manifests (JSON with footage_root and clips), absent fields null and absent tracks empty; ``lines`` where each line is a manifest."""
    required(spark, path, "manifest")
    clip, track = (", ".join(f.replace(" ", ":", 1) for f in ddl.split(", ")) for ddl in (_CLIP, _TRACK))
    schema = f"footage_root string, clips array<struct<{clip}, tracks:array<struct<{track}>>>>"
    clips = spark.read.schema(schema).json(path, multiLine=not lines).select("footage_root", F.explode("clips").alias("c")).select("footage_root", "c.*")
    none = F.array().cast(clips.schema["tracks"].dataType)
    return clips.withColumn("tracks", F.coalesce("tracks", none))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The rows of one key, or an error when they are read if there are none."""
    found = df.filter(F.col(key) == F.lit(value))
    wanted = df.sparkSession.range(1).select(F.lit(value).cast(df.schema[key].dataType).alias(key)).join(found.withColumn("_found", F.lit(True)), key, "left")
    return wanted.filter(F.coalesce("_found", F.raise_error(F.lit(f"no {key} {value}")).cast("boolean"))).select(*df.columns)


# --- captions ---------------------------------------------------------------------------


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, value): whole files, the video's id being the file's stem."""
    return spark.read.text(path, wholetext=True).select(stem(F.input_file_name()).alias("video_id"), "value")


def label_map(payload: Column) -> Column:
    """Map of a segment's number to its description and tags out of a JSON object with numbers as keys; absent tags are empty."""
    raw = F.from_json(payload, "map<string, struct<description:string, tags:array<string>>>")
    entries = F.transform(F.map_entries(raw), lambda e: F.struct(e["key"].cast("int").alias("k"), F.struct(e["value"]["description"].alias("description"), F.coalesce(e["value"]["tags"], F.array().cast("array<string>")).alias("tags")).alias("v")))
    return F.map_from_entries(entries)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, seg_index, description, tags) of label files, one for each video; none yet is no label."""
    if not exists(spark, path):
        return spark.createDataFrame([], "video_id string, seg_index int, description string, tags array<string>")
    return _whole(spark, path).select("video_id", F.explode(label_map(F.col("value"))).alias("seg_index", "l")).select("video_id", "seg_index", "l.*")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, seg_index, start, end) of segment files, one for each video."""
    if not exists(spark, path):
        return spark.createDataFrame([], "video_id string, seg_index int, start double, end double")
    s = F.from_json("value", "segments array<struct<index:int, start:double, end:double>>")["segments"]
    return _whole(spark, path).select("video_id", F.explode(s).alias("s")).select("video_id", F.col("s.index").alias("seg_index"), "s.start", "s.end")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a dataset's index, JSON with ``clips`` or the Parquet that ``write_dataset`` writes; an error if there is none."""
    if exists(spark, f"{path}/index"):
        return spark.read.parquet(f"{path}/index")
    required(spark, f"{path}/index.json", "dataset index")
    return spark.read.json(f"{path}/index.json", multiLine=True).select(F.explode("clips").alias("c")).select("c.*")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(person_id, display_name, granted, scope, granted_on, method) of a registry; empty if there is none."""
    person = "display_name:string, consent:struct<granted:boolean, scope:string, granted_on:string, method:string>"
    if not exists(spark, path):
        return spark.createDataFrame([], "person_id string, display_name string, granted boolean, scope string, granted_on string, method string")
    lines = spark.read.text(path)
    pretty = lines.limit(1).filter("value LIKE '%{%}%'").count() == 0  # one object over many lines
    source = spark.read.text(path, wholetext=True) if pretty else lines
    rows = source.select(F.explode(F.from_json("value", f"people map<string, struct<{person}>>")["people"]).alias("person_id", "p"))
    return rows.select("person_id", "p.display_name", F.coalesce("p.consent.granted", F.lit(False)).alias("granted"), "p.consent.scope", "p.consent.granted_on", "p.consent.method")


# --- curves -----------------------------------------------------------------------------


def first_present(df: DataFrame, *names: str) -> Column | None:
    """The first of the columns that ``df`` has."""
    return next((F.col(f"`{n}`") for n in names if n in df.columns), None)


def first_value(df: DataFrame, *names: str) -> Column:
    """The first of the columns present that isn't null, row by row; null if there is none."""
    held = [F.col(f"`{n}`") for n in names if n in df.columns]
    return F.coalesce(*held) if held else F.lit(None)


def _curve(rows: DataFrame, step: Column, train: Column | None, held_out: Column) -> DataFrame:
    kept = rows.filter(held_out.isNotNull() & (held_out.cast("string") != ""))
    number = lambda c: F.lit(None).cast("double") if c is None else F.nullif(c.cast("string"), F.lit("")).cast("double")
    return kept.select(step.cast("double").cast("long").alias("step"), number(train).alias("train_loss"), held_out.cast("double").alias("val_loss"))


def read_curve(spark: SparkSession, path: str) -> DataFrame:
    """(step, train_loss, val_loss) of evaluated steps; JSON lines or CSV with a header, by the first character."""
    first = spark.read.text(path).filter("trim(value) <> ''").first()
    if first is None:
        raise ValueError(f"metrics at {path} are empty")
    rows = spark.read.json(path) if first[0].lstrip()[0] in "{[" else spark.read.csv(path, header=True)
    step, held_out = first_present(rows, "step"), first_present(rows, "val_loss")
    if step is None or held_out is None:
        raise ValueError(f"metrics at {path} have no val_loss by step")
    return _curve(rows, step, first_present(rows, "train_loss"), held_out)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The same of a logger's CSV, whose columns go by several names."""
    rows = spark.read.csv(path, header=True)
    step, held_out = first_present(rows, *STEP_COLUMNS), first_present(rows, *HELD_OUT_COLUMNS)
    if step is None or held_out is None:
        raise ValueError(f"{path} has no held-out column; looked for {', '.join(HELD_OUT_COLUMNS)}")
    return _curve(rows, step, first_present(rows, *TRAIN_COLUMNS), held_out)


#: Where each trainer's method writes its curve, and its reader; other methods have none that is known.
METRICS: dict[str, tuple[str, Callable[[SparkSession, str], DataFrame]]] = {"noop": ("metrics.jsonl", read_curve), "mdm": ("progress.csv", read_progress), "closd": ("progress.csv", read_progress)}


def read_metrics(spark: SparkSession, method: str, folder: str) -> DataFrame | None:
    """A method's curve in a run's folder; None if the method or the file isn't there."""
    if method.lower() not in METRICS:
        return None
    name, reader = METRICS[method.lower()]
    return reader(spark, f"{folder}/{name}") if exists(spark, f"{folder}/{name}") else None


# --- motion -----------------------------------------------------------------------------

_MOTION = "unit_id string, frame_idx int, fps double, pose array<float>, trans array<float>, left_hand array<float>, right_hand array<float>, frame string"


def _archive(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw), allow_pickle=False) as d:
        return {k: d[k] for k in d.files}


def read_motion(spark: SparkSession, path: str) -> DataFrame:
    """Frames of motion archives (npz), a hand null where its presence flag is false."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _MOTION.split(", ")]
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                d = _archive(raw)
                n = len(d["poses"])
                lists = lambda x, n=n: pa.array([None] * n if x is None else list(x.reshape(n, -1).astype(np.float32)), pa.list_(pa.float32()))
                hand = lambda side, d=d: d[f"{side}_hand_pose"] if bool(d.get(f"has_{side}", False)) else None
                columns = [pa.array([name] * n), pa.array(np.arange(n, dtype=np.int32)), pa.array([float(d["fps"])] * n), lists(d["poses"]), lists(d["trans"]), lists(hand("left")), lists(hand("right")), pa.array([str(d["frame"])] * n)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz").load(path)
    return files.select(stem(F.col("path")).alias("name"), "content").mapInArrow(run, _MOTION)


def read_vertices(spark: SparkSession, path: str) -> DataFrame:
    """(asset_id, vid, x, y, z) of meshes: Parquet in that form, or npz archives that hold ``vertices``, ``verts`` or ``v``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                d = _archive(raw)
                v = next((d[k] for k in ("vertices", "verts", "v") if k in d), np.zeros((0, 3))).reshape(-1, 3).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(v), pa.string()), pa.array(np.arange(len(v), dtype=np.int32)), *(pa.array(v[:, k].copy()) for k in range(3))], names=["asset_id", "vid", "x", "y", "z"])

    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz").load(path)
    if archives.limit(1).count():
        return archives.select(stem(F.col("path")).alias("name"), "content").mapInArrow(run, "asset_id string, vid int, x double, y double, z double")
    return spark.read.parquet(path).select("asset_id", "vid", "x", "y", "z")
