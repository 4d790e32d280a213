"""People, their recorded consent, and what may be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def motion_units(clips: DataFrame, tracks: str = "tracks") -> DataFrame:
    """(unit_id, clip_id, track_id, person_id): each track of a clip, or the clip itself if it has none."""
    t = F.col("t")
    return clips.select("clip_id", F.explode_outer(tracks).alias("t")).select(
        F.concat_ws("__", "clip_id", t["track_id"]).alias("unit_id"), "clip_id", t["track_id"].alias("track_id"), t["person_id"].alias("person_id")
    )


def consent_gate(units: DataFrame, registry: DataFrame, unassigned: str = "exclude", person: str = "person_id", granted: str = "granted") -> DataFrame:
    """Units of people whose consent is granted; those without a person only if ``unassigned`` is ``include``.

    Whoever isn't in the registry has not consented.
    """
    yes = registry.filter(F.col(granted)).select(F.col(person).alias("_p")).distinct()
    allowed = units.join(yes, F.col(person) == F.col("_p"), "left_semi")
    return allowed.unionByName(units.filter(F.col(person).isNull())) if unassigned == "include" else allowed


def consent_flag(units: DataFrame, registry: DataFrame, unassigned: str = "exclude", person: str = "person_id", granted: str = "granted") -> DataFrame:
    """Every unit with ``allowed``, for counting what a gate drops."""
    yes = registry.groupBy(F.col(person).alias("_p")).agg(F.bool_or(F.coalesce(F.col(granted), F.lit(False))).alias("_g"))
    flag = F.when(F.col(person).isNull(), F.lit(unassigned == "include")).otherwise(F.coalesce("_g", F.lit(False)))
    return units.join(yes, F.col(person) == F.col("_p"), "left").withColumn("allowed", flag).drop("_p", "_g")


def decide(registry: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(registry, audit) after grants and revocations (person_id, granted, scope, method, at); the latest of a person stands."""
    latest = decisions.groupBy("person_id").agg(F.max_by(F.struct("granted", "scope", "method", "at"), F.struct("at", "granted")).alias("d"))
    new = latest.select("person_id", "d.granted", "d.scope", F.when(F.col("d.granted"), F.col("d.at")).alias("granted_on"), "d.method")
    kept = registry.join(new, "person_id", "left_anti").unionByName(new, allowMissingColumns=True)
    names = registry.select(F.col("person_id").alias("_p"), F.col("display_name").alias("_d")) if "display_name" in registry.columns else None
    if names is not None:
        kept = kept.join(names, F.col("person_id") == F.col("_p"), "left").withColumn("display_name", F.coalesce("display_name", "_d")).drop("_p", "_d")
    audit = decisions.select("at", F.when(F.col("granted"), "grant").otherwise("revoke").alias("event"), "person_id", "granted", "scope")
    return kept, audit


def people_counts(units: DataFrame, person: str = "person_id") -> DataFrame:
    return units.groupBy(F.coalesce(person, F.lit("(unassigned)")).alias("person")).agg(F.count("*").alias("units"))


def anonymize(motion: DataFrame, zero_position: bool = False) -> DataFrame:
    """Motion without shape, and with the position at the origin if asked."""
    out = motion.drop("betas")
    return out.withColumn("trans", F.transform("trans", lambda v: v * 0)) if zero_position else out


def static_hint(camera: Column, static_cameras: list[str], camera_motion: Column) -> Column:
    return camera.isin(static_cameras) | F.coalesce(camera_motion == "static", F.lit(False))
