"""Splits, totals, export rows and training plans of a dataset index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Limits of the risk score.
EXPOSURES, MINUTES, PERSONS = (60, 150), (15, 60), (5, 20)
FEW_MINUTES = 3.0
#: Limits of the training plan.
TINY_MINUTES, FINETUNE_MINUTES, DIVERSE, PASSES, STEPS = 30, 3000, 20, 40, (20_000, 500_000)


def hash_split(key: Column, fraction: float, seed: str = "0") -> Column:
    """``val`` or ``train`` by a hash of the key alone, so rows split alike wherever they are."""
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return F.when(place < fraction, "val").otherwise("train")


def exact_split(keys: DataFrame, key: str, fraction: float, seed: str = "0") -> DataFrame:
    """(key, split) with exactly ``max(1, int(n * fraction))`` validation keys, those of the smallest hashes; none for a fraction of 0.

    The last chosen hash is found by selection: keys are counted by the hash's first four digits, then
    those of the bucket it falls in by the next four, and so on; what is below it is a filter. A null key isn't split.
    """
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    distinct = keys.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_h", place)
    n = distinct.count()
    rest = max(1, int(n * fraction)) if n and fraction > 0 else 0
    upto = ""
    while rest and len(upto) < 32:
        digits = F.substring("_h", len(upto) + 1, 4)
        counts = distinct.filter(F.col("_h").startswith(upto)).groupBy(digits.alias("d")).count().collect()  # 65,536 rows at most
        for d, count in sorted(map(tuple, counts)):
            if rest <= count:
                break
            rest -= count
        upto += d
        if rest == count:
            break
    chosen = F.substring("_h", 1, len(upto)) <= upto if upto else F.lit(False)
    return distinct.select(key, F.when(chosen, "val").otherwise("train").alias("split"))


def is_train(split: Column) -> Column:
    return ~F.coalesce(split, F.lit("")).isin("val", "test")


def dataset_stats(index: DataFrame, order: str, frames: str = "n_frames", fps: str = "fps") -> DataFrame:
    """One row: clips, frames, seconds by the last clip's rate as consumers expect, and by each clip's own."""
    total = F.coalesce(F.sum(frames), F.lit(0))
    last = F.max_by(fps, order)
    return index.agg(
        F.count("*").alias("n_clips"), total.alias("n_frames"), F.bround(total / last, 1).alias("total_seconds"),
        F.bround(total / last / 3600, 3).alias("total_hours"), F.round(F.sum(F.col(frames) / F.col(fps)), 6).alias("seconds_by_clip"), last.alias("fps"),
    )


def person_coverage(index: DataFrame, person: str, frames: str, default_fps: float = 20.0) -> DataFrame:
    """(person, clips, frames, minutes), fewest minutes first; minutes by the default rate."""
    who = F.coalesce(F.nullif(F.col(person).cast("string"), F.lit("")), F.lit("(unlabeled)"))
    return (
        index.groupBy(who.alias("person")).agg(F.count("*").alias("clips"), F.sum(frames).alias("frames"))
        .withColumn("minutes", F.col("frames") / default_fps / 60).orderBy("minutes", "person")
    )


def corpus_stats(index: DataFrame, person: str, frames: str, fps: str, split: str) -> DataFrame:
    """One row: clips, frames and minutes by each clip's rate, those of training, and persons."""
    f, m = F.col(frames), F.coalesce(F.try_divide(F.col(frames), F.col(fps)), F.lit(0.0)) / 60
    train = is_train(F.col(split))
    zero = lambda c: F.coalesce(c, F.lit(0))
    who = F.coalesce(F.nullif(F.col(person).cast("string"), F.lit("")), F.lit("(unlabeled)"))
    return index.agg(
        F.count("*").alias("n_clips"), zero(F.sum(f)).alias("frames"), zero(F.sum(m)).alias("minutes"), zero(F.sum(F.when(train, f))).alias("train_frames"),
        zero(F.sum(F.when(train, m))).alias("train_minutes"), F.count_distinct(who).alias("n_persons"),
    )


def risk_score(stats: DataFrame, num_steps: int, batch_size: int, resumed: bool = False, low_rank: bool = False) -> DataFrame:
    """``corpus_stats`` with exposures, score and level of the risk to memorise."""
    e = F.lit(num_steps * batch_size) / F.greatest(F.lit(1), "train_frames")
    minutes, persons = F.col("train_minutes"), F.col("n_persons")
    score = (
        F.when(e > EXPOSURES[1], 2).when(e > EXPOSURES[0], 1).otherwise(0)
        + F.when(minutes < MINUTES[0], 2).when(minutes < MINUTES[1], 1).otherwise(0)
        + F.lit(0 if resumed else 1) - F.lit(1 if low_rank else 0)
        - F.when(persons >= PERSONS[1], 2).when(persons >= PERSONS[0], 1).otherwise(0)
    )
    level = F.when(F.col("score") >= 3, "high").when(F.col("score") >= 1, "medium").otherwise("low")
    return stats.withColumns({"exposures": e, "score": score, "resumed": F.lit(resumed), "low_rank": F.lit(low_rank)}).withColumn("level", level)


def risk_reasons(scored: DataFrame) -> DataFrame:
    """``risk_score``'s row with what stands behind it: reasons, an array of text."""
    e, minutes, persons = F.col("exposures"), F.col("train_minutes"), F.col("n_persons")
    rules = (
        F.when(e > EXPOSURES[0], F.concat(F.lit("each training frame is seen about "), F.format_string("%.0f", e), F.lit(" times"))),
        F.when(minutes < MINUTES[1], F.concat(F.lit("only "), F.format_string("%.1f", minutes), F.lit(" minutes of training motion"))),
        F.when(F.col("resumed") == False, F.lit("training starts from nothing")),  # noqa: E712
        F.when(F.col("low_rank"), F.lit("a low-rank adaptation resists overfitting")),
        F.when(persons >= PERSONS[0], F.concat(persons.cast("string"), F.lit(" persons add variety"))),
    )
    return scored.withColumn("reasons", F.filter(F.array(*rules), lambda r: r.isNotNull()))


#: Generators by name, all of them large; other methods run no such risk.
GENERATORS = ("momask", "mdm", "closd")


def risk_advice(scored: DataFrame, method: str, num_steps: int, conditioning: str = "none") -> DataFrame:
    """``risk_score``'s row with applicable and recommendations, an array of text; a method that is no generator has
    neither level nor recommendations.
    """
    known = F.lit(method.lower() in GENERATORS)
    minutes, persons = F.col("train_minutes"), F.col("n_persons")
    rules = (
        F.when(~F.col("resumed") & (persons < PERSONS[0]), F.lit("start from a trained checkpoint: a large model learns little from so few persons")),
        F.when(~F.col("low_rank") & (minutes < MINUTES[0]) & F.lit(method.lower() == "mdm"), F.lit("adapt at low rank: it keeps what the model knows")),
        F.when(minutes < MINUTES[1], F.lit(f"take fewer steps than {num_steps} or more footage, and watch the validation curve")),
        F.when((persons > 1) & F.lit(conditioning != "person"), F.concat(F.lit("condition on the person: "), persons.cast("string"), F.lit(" persons would average into one"))),
    )
    advice = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return scored.withColumns({"applicable": known, "recommendations": F.when(known, advice).otherwise(F.array().cast("array<string>")), "level": F.when(known, F.col("level"))})


def underrepresented(coverage: DataFrame) -> DataFrame:
    """Persons of a corpus of several who have too few minutes to matter."""
    n = coverage.agg(F.count("*").alias("_persons"))  # one row
    return coverage.join(F.broadcast(n)).filter((F.col("_persons") > 1) & (F.col("minutes") < FEW_MINUTES)).drop("_persons")


def training_plan(stats: DataFrame, batch_size: int) -> DataFrame:
    """``corpus_stats`` with num_steps, regime, method, personalization, warm_start and conditioning."""
    frames, minutes, n = F.greatest(F.lit(1), F.col("train_frames")), F.col("train_minutes"), F.col("n_persons")
    steps = F.least(F.lit(STEPS[1]), F.greatest(F.lit(STEPS[0]), F.floor(F.lit(PASSES) * frames / max(1, batch_size)))).cast("long")
    regime = F.when((minutes < TINY_MINUTES) & (n <= 2), "personalize-tiny").when(minutes < FINETUNE_MINUTES, "finetune").otherwise("large-corpus")
    out = stats.withColumns({"num_steps": steps, "regime": regime})
    tiny, large = F.col("regime") == "personalize-tiny", F.col("regime") == "large-corpus"
    return out.withColumns({
        "method": F.when(tiny, "mdm").otherwise("momask"), "personalization": F.when(tiny, "lora").otherwise("full"),
        "warm_start": ~large | (n < DIVERSE), "conditioning": F.when(n > 1, "person").otherwise("none"),
    })


def curve_verdict(curve: DataFrame, run: str, step: str, loss: str, patience: int = 5) -> DataFrame:
    """(run, best_step, best_loss, overfit, onset_step, worse_after, evals): the first minimum and the worse evaluations after it.

    Fewer than two evaluations give no best step.
    """
    best = curve.groupBy(run).agg(F.count("*").alias("evals"), F.min(F.struct(loss, step)).alias("_b"), F.max(step).alias("_last"))
    later = curve.join(best, run).groupBy(run, "evals", "_b", "_last").agg(F.count_if((F.col(step) > F.col(f"_b.{step}")) & (F.col(loss) > F.col(f"_b.{loss}"))).alias("worse_after"))
    few = F.col("evals") < 2
    over = ~few & (F.col(f"_b.{step}") != F.col("_last")) & (F.col("worse_after") >= patience)
    at = F.col(f"_b.{step}")
    return later.select(run, F.when(~few, at).alias("best_step"), F.when(~few, F.col(f"_b.{loss}")).alias("best_loss"), over.alias("overfit"), F.when(over, at).alias("onset_step"), "worse_after", "evals")


def best_of(candidates: DataFrame, key: str, attempt: str, score: str, enough: float) -> DataFrame:
    """(key, attempt, score): the first attempt that is good enough, else the best; of equals the earlier."""
    w = Window.partitionBy(key).orderBy(attempt).rowsBetween(Window.unboundedPreceding, -1)
    tried = candidates.withColumn("_done", F.coalesce(F.max(score).over(w) >= enough, F.lit(False))).filter("NOT _done")
    best = tried.groupBy(key).agg(F.min(F.struct((-F.col(score)).alias("s"), F.col(attempt).alias("a"))).alias("b"))
    return best.select(key, F.col("b.a").alias(attempt), (-F.col("b.s")).alias(score))
