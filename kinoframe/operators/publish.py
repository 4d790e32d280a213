"""Publication of datasets: which motion goes with which captions, index entries, splits, totals, hand-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rotations import export_pose
from ..functions.text import clip_caption
from .dataset import exact_split
from .ranges import numbered

# --- units and attributes -----------------------------------------------------------------


def existing_units(units: DataFrame, files: DataFrame, file: str = "pose_rel") -> DataFrame:
    """Units whose motion file is there."""
    return units.join(files.select(F.col("rel_path").alias(file)), file, "left_semi")


def with_attributes(entries: DataFrame, extra: DataFrame, key: str = "clip_id") -> DataFrame:
    """Entries with further columns of the same key, null where there are none; a column of both is replaced where the extra one isn't null."""
    added = [c for c in extra.columns if c != key]
    joined = entries.join(extra.select(key, *(F.col(c).alias(f"_{c}") for c in added)), key, "left")
    return joined.withColumns({c: F.coalesce(f"_{c}", c) if c in entries.columns else F.col(f"_{c}") for c in added}).drop(*(f"_{c}" for c in added))


def labels_back(df: DataFrame, labels: DataFrame, key: str, label: str, default: int | None = -1) -> DataFrame:
    """``df`` with each key's label, ``default`` where it has none."""
    return df.drop(label).join(labels.select(key, label), key, "left").withColumn(label, F.coalesce(label, F.lit(default)))


def attribute_map(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """(key, attributes): a map of the columns that aren't null, as text."""
    pairs = F.array(*(F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in names))
    return df.select(key, F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("attributes"))


def zipped(units: DataFrame, times: str, captions: str) -> DataFrame:
    """A row for each of a unit's times and captions in turn; an error where their numbers differ."""
    same = F.when(F.size(times) == F.size(captions), F.arrays_zip(F.col(times).alias("time"), F.col(captions).alias("text"))).otherwise(F.raise_error(F.lit("as many captions as times are needed")))
    rest = [c for c in units.columns if c not in (times, captions)]
    return units.select(*rest, F.posexplode(same).alias("at", "_z")).select(*rest, "at", F.col("_z.time").alias("time"), F.col("_z.text").alias("text"))


def assigned(tracks: DataFrame, labels: DataFrame, registry: DataFrame, unit: str = "unit_id") -> tuple[DataFrame, DataFrame]:
    """(tracks, registry): ``person_NN`` by each unit's cluster, null without one, and the registry with new persons, who have not consented."""
    named = tracks.drop("person_id").join(labels.select(unit, "cluster"), unit, "left")
    named = named.withColumn("person_id", F.when(F.col("cluster").isNotNull(), F.format_string("person_%02d", "cluster"))).drop("cluster")
    new = named.filter("person_id IS NOT NULL").select("person_id").distinct().join(registry.select("person_id"), "person_id", "left_anti")
    fresh = new.withColumns({"display_name": F.col("person_id"), "granted": F.lit(False), "scope": F.lit("all")})
    return named, registry.unionByName(fresh, allowMissingColumns=True)


# --- captions and motion ---------------------------------------------------------------------


def motion_sources(videos: DataFrame, tracks: DataFrame, registry: DataFrame, files: DataFrame) -> DataFrame:
    """(video_id, person_id, track_id, file, outcome): what motion goes with a video's captions.

    A video with tracks gives one source for each track of a consenting person whose file is
    there; one without gives its own file. Outcomes are source, no_consent and no_file; a
    video none of whose rows is a source has no motion.
    """
    granted = registry.filter("granted").select("person_id").distinct().withColumn("_yes", F.lit(True))
    there = files.select(F.col("rel_path").alias("file")).distinct().withColumn("_file", F.lit(True))
    of_tracks = tracks.select("video_id", "person_id", "track_id", F.col("pose_rel").alias("file")).join(granted, "person_id", "left")
    single = videos.join(tracks.select("video_id").distinct(), "video_id", "left_anti").select("video_id", F.concat(F.col("video_id").cast("string"), F.lit(".npz")).alias("file"), F.lit(True).alias("_yes"))
    both = of_tracks.join(videos.select("video_id"), "video_id", "left_semi").unionByName(single, allowMissingColumns=True).join(there, "file", "left")
    outcome = F.when(F.col("_yes").isNull(), "no_consent").when(F.col("_file").isNull(), "no_file").otherwise("source")
    return both.select("video_id", "person_id", "track_id", "file", outcome.alias("outcome"))


def captioned_segments(rows: DataFrame, sources: DataFrame, motions: DataFrame, min_frames: int = 30) -> DataFrame:
    """(clip_id, video_id, person_id, n_frames, fps, caption, start, end, file, first, outcome) of every caption row and source.

    ``motions`` has (file, frames, fps, frame). Outcomes are segment, too_short and not_global.
    """
    used = sources.filter("outcome = 'source'").join(motions, "file")
    first = F.greatest(F.lit(0), F.bround(F.col("start") * F.col("fps"))).cast("long")
    last = F.least(F.col("frames"), F.bround(F.col("end") * F.col("fps"))).cast("long")
    cut = rows.join(used, "video_id").withColumn("first", first).withColumn("n_frames", last - first)
    outcome = F.when((F.col("n_frames") < 2) | (F.col("n_frames") < min_frames), "too_short").when(F.col("frame") != "global", "not_global").otherwise("segment")
    track = F.when(F.col("track_id").isNotNull(), F.concat(F.lit("__"), F.col("track_id"))).otherwise("")
    clip = F.concat(F.col("video_id").cast("string"), F.format_string("_seg%04d", "seg_index"), track)
    return cut.select(clip.alias("clip_id"), "video_id", "person_id", "n_frames", "fps", F.col("description").alias("caption"), "start", "end", "file", "first", outcome.alias("outcome"))


def build_counters(rows: DataFrame, sources: DataFrame, segments: DataFrame) -> DataFrame:
    """One row: videos with and without motion, tracks without consent, segments built, too short, and not in world coordinates."""
    captioned = rows.select("video_id").distinct()
    by_video = sources.join(captioned, "video_id", "left_semi").groupBy("video_id").agg(F.count_if(F.col("outcome") == "source").alias("s"), F.count_if(F.col("outcome") == "no_consent").alias("c"))
    v = by_video.agg(F.count_if(F.col("s") > 0).alias("with_motion"), F.count_if(F.col("s") == 0).alias("missing_motion"), F.coalesce(F.sum("c"), F.lit(0)).alias("consent_skipped"))
    s = segments.agg(*(F.count_if(F.col("outcome") == k).alias(n) for k, n in (("segment", "segments"), ("too_short", "too_short"), ("not_global", "incam_skipped"))))
    return v.join(s)  # a row each


# --- index entries -----------------------------------------------------------------------------


def index_entries(frames: DataFrame, unit: str, min_frames: int = 30) -> DataFrame:
    """(clip_id, n_frames, fps) of units with at least ``min_frames`` frames."""
    n = frames.groupBy(F.col(unit).alias("clip_id")).agg(F.count("*").alias("n_frames"), F.max("fps").alias("fps"))
    return n.filter(F.col("n_frames") >= min_frames)


def export_frames(frames: DataFrame) -> DataFrame:
    """Frames in the exchange form: 156 numbers and no shape; a frame that isn't in world coordinates is an error."""
    world = F.when(F.col("frame") == "global", F.lit(True)).otherwise(F.raise_error(F.lit("only motion in world coordinates is exported")).cast("boolean"))
    keep = [c for c in frames.columns if c not in ("pose", "left_hand", "right_hand", "frame", "betas")]
    return frames.filter(world).select(*keep, export_pose(F.col("pose"), F.col("left_hand"), F.col("right_hand")).alias("poses"))


def with_split(entries: DataFrame, by: str = "clip_id", fraction: float = 0.05, seed: str = "0") -> DataFrame:
    """Entries with a split by whole keys ``by``: clips, or the videos they come from."""
    return entries.drop("split").join(exact_split(entries, by, fraction, seed), by)


def with_own_split(entries: DataFrame, person: str = "person_id", fraction: float = 0.05, seed: str = "0") -> DataFrame:
    """Entries of known persons, each person's clips split by themselves: ``max(1, int(n * fraction))`` of the smallest hashes are
    validation. A person's clips are ranked by ranges, so one with very many is work for many tasks.
    """
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.col("clip_id").cast("string")))
    known = entries.filter(F.col(person).isNotNull() & (F.col(person).cast("string") != "")).withColumn("_h", place)
    n = known.groupBy(F.col(person).alias("_p")).agg(F.greatest(F.lit(1), F.floor(F.count("*") * F.lit(fraction))).alias("_m"))
    ranked = numbered(known, [person], ["_h", "clip_id"], "_at").join(n, F.col(person) == F.col("_p"))
    return ranked.withColumn("split", F.when(F.col("_at") < F.col("_m"), "val").otherwise("train")).select(*dict.fromkeys([*entries.columns, "split"]))


# --- hand-off to training -------------------------------------------------------------------------


def split_lists(entries: DataFrame) -> DataFrame:
    """(list, clip_id): train, val, and test, which holds the same as val; entries without a split are in none."""
    lists = F.when(F.col("split") == "train", F.array(F.lit("train"))).when(F.col("split") == "val", F.array(F.lit("val"), F.lit("test")))
    return entries.select(F.explode(lists).alias("list"), "clip_id")


def missing_captions(entries: DataFrame, existing: DataFrame, conditioning: str) -> DataFrame:
    """(clip_id, line) for clips that have no caption file yet."""
    have = lambda n: F.col(n) if n in entries.columns else F.lit(None)
    line = clip_caption(conditioning, have("action_cluster"), have("caption").cast("string"), have("person_id").cast("string"))
    return entries.join(existing.select("clip_id"), "clip_id", "left_anti").select("clip_id", line.alias("line"))


def listed(files: DataFrame, entries: DataFrame, key: str = "clip_id") -> DataFrame:
    """Files of the clips that are listed; a listed clip without a file is passed over."""
    return files.join(entries.select(key), key, "left_semi")


def stride_warning(fps: Column) -> Column:
    """A warning where a rate isn't a multiple of 20, so that every int(fps / 20)th frame has another speed; else null."""
    return F.when(fps % 20 != 0, F.concat(F.lit("fps "), fps.cast("string"), F.lit(" is not a multiple of 20: clips would train at the wrong speed")))
