"""Made-up motion and captions, the same in every run: each number comes from a hash of what it belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of made-up captions.
SUBJECTS = ("a person", "two people", "a dog", "a room", "a street", "a kitchen", "a garden")
ACTIONS = ("walking", "sitting", "cooking", "talking", "reading", "standing", "playing")
DETAILS = ("indoors", "outdoors", "in daylight", "at night", "near a window", "by a table")


def uniform(key: Column) -> Column:
    """A number of [0, 1) by a text's md5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / float(1 << 32)


def synthetic_motion(clips: DataFrame, clip: str, people: int = 1, channels: int = 3, fps: float = 20.0, least: int = 35, scale: float = 0.002) -> DataFrame:
    """(clip, person, channel, frame_idx, value): 4 to 11 seconds of each person, small random accelerations added up twice, about a mean of 0."""
    name = F.col(clip).cast("string")
    n = F.greatest(F.lit(least), F.floor((4 + F.floor(8 * uniform(F.concat(F.lit("n:"), name)))) * fps)).cast("int")
    each = clips.select(clip, n.alias("_n")).withColumn("person", F.explode(F.sequence(F.lit(0), F.lit(people - 1)))).withColumn("channel", F.explode(F.sequence(F.lit(0), F.lit(channels - 1))))
    frames = each.withColumn("frame_idx", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    push = (uniform(F.concat_ws(":", name, "person", "channel", "frame_idx")) - 0.5) * scale
    along = Window.partitionBy(clip, "person", "channel")
    so_far = along.orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, 0)
    path = frames.withColumn("_a", push).withColumn("_v", F.sum("_a").over(so_far)).withColumn("_p", F.sum("_v").over(so_far))
    return path.select(clip, "person", "channel", "frame_idx", (F.col("_p") - F.avg("_p").over(along)).alias("value"))


def synthetic_shape(person: Column, size: int = 10) -> Column:
    """A person's shape, the same in every clip: ``size`` numbers of [-1, 1)."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: 2 * uniform(F.concat_ws(":", F.lit("shape"), person.cast("string"), k.cast("string"))) - 1)


def pick(key: Column, options: tuple[str, ...]) -> Column:
    """The option at a text's sha1, a number of 160 bits, modulo their number: folded digit by digit."""
    digits = F.split(F.sha1(key), "")
    place = F.aggregate(digits, F.lit(0).cast("long"), lambda s, h: F.when(h == "", s).otherwise((s * 16 + F.conv(h, 16, 10).cast("long")) % len(options)))
    return F.get(F.array(*map(F.lit, options)), place.cast("int"))


def synthetic_caption(video: Column, time: Column) -> Column:
    """A frame's caption by its video's name and its time in seconds."""
    key = F.concat(video, F.format_string(":%.3f", time))
    return F.concat(pick(F.concat(key, F.lit("s")), SUBJECTS), F.lit(" "), pick(F.concat(key, F.lit("a")), ACTIONS), F.lit(" "), pick(F.concat(key, F.lit("d")), DETAILS), F.lit("."))
