"""Queries of what goes on by itself, by name or by ranges: attempts, estimators, aggregators, scans, trees."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import estimators
from ..functions import rotations as rot
from ..functions.text import STOP_WORDS
from ..operators import aggregators, dataset, estimates, intervals, matching, motion, publish, ranges, series, skeleton, vectors
from ..operators.attempts import AttemptLog, attempt
from ..sources import archives
from ..sources.folders import work_dir
from ..streaming import jobs, ordered
from .media import table
from .motion import _CS, _SC, _SP, ORDER, _events, _index, _scores, _spans
from .motion import SQL as _MOTION_SQL
from .registry import registry

QUERIES, SQL, query = registry()


# --- attempts ----------------------------------------------------------------------------------

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT"


def counted(every: int):
    """A function that counts a document's words and raises for those whose id ``every`` divides."""

    def count(doc_id: int, text: str | None) -> dict:
        if doc_id % every == 0:
            raise ValueError(f"document {doc_id} can't be read")
        return {"n_words": len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))}

    return count


@query(f"""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'failed' ELSE 'done' END AS status, CASE WHEN doc_id % 7 = 0 THEN 'ValueError: document ' || doc_id || ' can''t be read' END AS error,
CASE WHEN doc_id % 7 <> 0 THEN {_WORDS} END AS n_words FROM documents""")
def isolated_items(spark, d):
    """Every seventh document fails by itself."""
    return attempt(table(spark, d, "documents"), ["doc_id"], ["doc_id", "text"], counted(7), "n_words long")


@query(f"""SELECT doc_id, CASE WHEN doc_id % 49 = 0 THEN 'failed' ELSE 'done' END AS status, CASE WHEN doc_id % 49 = 0 THEN 'ValueError: document ' || doc_id || ' can''t be read' END AS error,
CASE WHEN doc_id % 49 <> 0 THEN {_WORDS} END AS n_words, CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END::INT AS run, CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END::BIGINT AS tries FROM documents""")
def resumed_items(spark, d):
    """A second run takes the failed documents only, most of which can be read by then."""
    log = AttemptLog(spark, work_dir(spark, "attempts"), ["doc_id"])
    for every in (7, 49):
        log.run(table(spark, d, "documents"), ["doc_id", "text"], counted(every), "n_words long")
    return log.latest().withColumn("run", F.col("run").cast("int"))


# --- estimators as table functions ---------------------------------------------------------------

_DET = """t AS (SELECT user_id AS unit, epoch_us(ts) / 1000000.0::DOUBLE AS "at", CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"""


def _detections(spark, d):
    e = _events(spark, d)
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    return e.select(F.col("user_id").alias("unit"), at.alias("at"), F.when(F.col("event_type") != "error", F.col("value")).alias("value"))


@query(f"""WITH {_DET} SELECT unit, row_number() OVER w - 1 AS frame, "at", last_value(CASE WHEN value >= 5 THEN value END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS value, coalesce(value >= 5, false) AS valid
FROM t WINDOW w AS (PARTITION BY unit ORDER BY "at", value NULLS FIRST)""")
def estimated_motion(spark, d):
    """An estimator by an alias of its name, from a DataFrame: missing and weak detections hold the last valid one."""
    return estimators.estimate(_detections(spark, d), "carry", least=5)


@query(f"""WITH {_DET}, p AS (SELECT unit, "at", min(value) AS lo, max(value) AS hi FROM t WHERE value IS NOT NULL GROUP BY 1, 2), u AS (SELECT unit, min("at") AS a, max("at") AS b FROM p GROUP BY 1),
g AS (SELECT unit, k AS frame, a + k / 0.00048828125::DOUBLE AS now FROM (SELECT *, unnest(range(floor((b - a) * 0.00048828125)::BIGINT + 1)) AS k FROM u)),
x AS (SELECT g.*, p."at" AS ax, p.hi AS x FROM g ASOF JOIN p ON g.unit = p.unit AND g.now >= p."at"), y AS (SELECT x.*, p."at" AS ay, p.lo AS y FROM x ASOF LEFT JOIN p ON x.unit = p.unit AND x.now < p."at")
SELECT unit, frame::BIGINT AS frame, now AS "at", CASE WHEN ay IS NULL THEN x ELSE x + (y - x) * (now - ax) / (ay - ax) END AS value FROM y""")
def resampled_motion(spark, d):
    """Another estimator by SQL, with another schema; its rate is an option."""
    estimators.register(spark)
    _detections(spark, d).createOrReplaceTempView("detections_of_units")
    return spark.sql("""SELECT * FROM estimate_motion(TABLE(detections_of_units), 'linear', '{"fps": 0.00048828125}')""")


@query("""WITH t AS (SELECT user_id AS unit, floor(epoch(ts) / 7200)::DOUBLE AS "at", event_type IN ('click', 'purchase') AS r, value FROM events), h AS (SELECT unit, "at", max(value) FILTER (WHERE NOT r) AS l, max(value) FILTER (WHERE r) AS r FROM t GROUP BY 1, 2)
SELECT unit, row_number() OVER w - 1 AS frame, "at", last_value(l IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS "left", last_value(r IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS "right", l IS NOT NULL AS left_valid, r IS NOT NULL AS right_valid
FROM h WINDOW w AS (PARTITION BY unit ORDER BY "at")""")
def estimated_hands(spark, d):
    """Detections of two hands as frames, laterally joined in SQL."""
    estimators.register(spark)
    e = _events(spark, d)
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 7_200_000_000).cast("double")
    e.select(F.col("user_id").alias("unit"), at.alias("at"), F.col("event_type").isin("click", "purchase").alias("right"), "value").createOrReplaceTempView("detections_of_hands")
    return spark.sql("SELECT h.* FROM (SELECT 'sides' AS method) m, LATERAL (SELECT * FROM estimate_hands(TABLE(detections_of_hands), 'sides')) h")


# --- captioners and aggregators ---------------------------------------------------------------------


@query(r"""WITH c AS (SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations)
SELECT conv_id, turn, CASE WHEN regexp_matches(t, '[.!?]\s') THEN regexp_extract(t, '^(.*?[.!?])\s', 1, 's') ELSE t END AS caption FROM c""")
def caption_by_name(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", aggregators.captioned(F.col("text"), "first_sentence").alias("caption"))


@query("""SELECT conv_id, 'Scene: ' || coalesce(arg_min(text, struct_pack(turn, text)), 'empty') || ' (' || count(text) || ' frames observed.)' AS description FROM conversations GROUP BY 1""")
def aggregated_summary(spark, d):
    return aggregators.aggregated(table(spark, d, "conversations"), ["conv_id"], "turn", "text", "summary")


_STOP = ", ".join(f"'{w}'" for w in sorted(STOP_WORDS))


@query(f"""WITH w AS (SELECT role, conv_id * 1000 + turn AS "at", unnest(ws) AS w, generate_subscripts(ws, 1) AS place FROM (SELECT *, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM conversations)),
c AS (SELECT role, w, count(*) AS n, min(struct_pack("at", place)) AS first FROM w WHERE len(w) > 2 AND w NOT IN ({_STOP}) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY n DESC, first) AS k FROM c)
SELECT role, list(w ORDER BY k) FILTER (WHERE k <= 8) AS tags FROM r GROUP BY 1""")
def aggregated_tags(spark, d):
    """Groups that hold a third or more of all rows each: states are merged, rows never meet."""
    rows = table(spark, d, "conversations").withColumn("at", F.col("conv_id") * 1000 + F.col("turn"))
    return aggregators.aggregated(rows, ["role"], "at", "text", "tags", n=8)


# --- one unit that holds all rows ---------------------------------------------------------------------

_ONE = "e AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS i FROM events)"


def _one(spark, d):
    return _events(spark, d).withColumn("unit", F.lit(0))


@query(f"""WITH {_ONE} SELECT e.event_id, round(sum(x.value * pow(0.6::DOUBLE, e.i - x.i) * CASE WHEN x.i = 0 THEN 1 ELSE 0.4::DOUBLE END), 6)::DOUBLE AS ema FROM e JOIN e x ON x.i BETWEEN e.i - 90 AND e.i GROUP BY 1""")
def spread_mean(spark, d):
    return series.ema(_one(spark, d), "unit", ORDER, "value", spread=True).select("event_id", F.round("ema", 6).alias("ema"))


@query("""SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), value) AS filled FROM events""")
def spread_fill(spark, d):
    return series.carry_forward(_one(spark, d), "unit", ORDER, "value", F.col("event_type") == "purchase", spread=True).select("event_id", "filled")


@query("SELECT event_id, round(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2)::DOUBLE AS path FROM events")
def spread_path(spark, d):
    return series.integrate(_one(spark, d), "unit", ORDER, "value", spread=True).select("event_id", F.round("path", 2).alias("path"))


@query(f"""WITH RECURSIVE {_SP}, o AS (SELECT *, row_number() OVER (ORDER BY a, b, event_id) AS i FROM sp), n AS (SELECT o.i, min(x.i) AS j FROM o LEFT JOIN o x ON x.i > o.i AND x.a BETWEEN o.a AND o.a + 7300 AND x.b - o.a > 7200 GROUP BY 1),
f AS (SELECT i, coalesce(j, (SELECT min(y.i) FROM o y WHERE y.a > (SELECT a FROM o z WHERE z.i = n.i) + 7300)) AS j FROM n), w AS (SELECT 1::BIGINT AS i, 0::BIGINT AS k UNION ALL SELECT f.j, w.k + 1 FROM w JOIN f USING (i) WHERE f.j IS NOT NULL)
SELECT o.event_id, w.k AS "window" FROM o ASOF JOIN w ON o.i >= w.i""")
def spread_windows(spark, d):
    """Greedy windows over all events as one unit."""
    spans = _spans(spark, d).withColumn("unit", F.lit(0))
    return intervals.greedy_windows(spans, "unit", 7200.0, spread=True).select("event_id", "window")


@query(f"""WITH {_SC}, g AS (SELECT *, median(score) OVER () AS med, count(*) OVER () AS n FROM sco)
SELECT user_id, CASE WHEN n < 3 THEN false ELSE sign(score) = CASE WHEN med >= 0 THEN -1 ELSE 1 END AND abs(score) >= 0.15 END AS mirrored FROM g""")
def spread_mirror_flags(spark, d):
    return motion.mirror_flags(_scores(spark, d), [], spread=["user_id"]).select("user_id", "mirrored")


@query(_MOTION_SQL["anti_drift"])
def spread_anti_drift(spark, d):
    return series.anti_drift(_events(spark, d), "user_id", ORDER, ["value"], 1.0, speed_limit=15, spread=True).select("event_id", F.round("value_held", 6).alias("value_held"))


@query("""WITH k AS (SELECT o_orderpriority AS person_id, o_orderkey AS clip_id, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('0:' || o_orderkey), o_orderkey) AS r, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT person_id, clip_id, CASE WHEN r <= greatest(1, floor(n * 0.05)) THEN 'val' ELSE 'train' END AS split FROM k""")
def spread_split(spark, d):
    """Five persons with all clips between them, each split by itself."""
    clips = table(spark, d, "orders").select(F.col("o_orderpriority").alias("person_id"), F.col("o_orderkey").alias("clip_id"))
    return publish.with_own_split(clips)


# --- clusters ---------------------------------------------------------------------------------------


@query()
def vector_tree(spark, d):
    """Single-linkage clusters of all vectors."""
    return vectors.spanning_tree_labels(table(spark, d, "embeddings"), "vec_id", "embedding")


@query()
def identity_clusters(spark, d):
    """Persons named by clusters that are found here, from vectors to tracks and registry."""
    e = table(spark, d, "embeddings")
    registry = spark.createDataFrame([("person_00", "Zero", True, "all")], "person_id string, display_name string, granted boolean, scope string")
    labels = vectors.cluster_labels(e, "vec_id", "embedding", 10).withColumnRenamed("vec_id", "unit_id")
    tracks, people = publish.assigned(e.select(F.col("vec_id").alias("unit_id")), labels, registry)
    return tracks.join(people, "person_id", "left").select("unit_id", "person_id", "granted")


# --- search expressions -------------------------------------------------------------------------------

def _expression(spark, d, expression, k=None):
    base = work_dir(spark, "index")
    docs = table(spark, d, "documents").select("doc_id", "text", F.concat(F.lit("from "), "lang", F.lit(" press "), F.regexp_replace("source", "[0-9]+", "")).alias("place"))
    matching.write_postings(docs, "doc_id", ["text", "place"], base)
    read = spark.read.parquet
    return matching.found(read(f"{base}/postings"), read(f"{base}/lengths"), "doc_id", ["text", "place"], expression, k)


_TP = "d AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '[a-z]+'), []) AS t, coalesce(regexp_extract_all('from ' || lang || ' press ' || regexp_replace(source, '[0-9]+', '', 'g'), '[a-z]+'), []) AS p FROM documents)"


@query(f"""WITH {_TP}, c AS (SELECT *, (len(t) + len(p))::DOUBLE AS l, len(list_filter(list_concat(t, p), lambda x: x = 'license')) AS a, len(list_filter(list_concat(t, p), lambda x: starts_with(x, 'reserv'))) AS b FROM d),
s AS (SELECT count(*) AS n, avg(l) AS m, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c),
r AS (SELECT doc_id, ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * l / m)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * l / m)) AS score FROM c, s WHERE a > 0 OR b > 0)
SELECT doc_id, round(score, 6)::DOUBLE AS score FROM r""")
def search_any(spark, d):
    """Either of a word and a prefix, ranked."""
    return _expression(spark, d, matching.Any(matching.Word("license"), matching.Word("reserv*"))).withColumn("score", F.round("score", 6))


@query(f"""WITH {_TP} SELECT doc_id FROM d WHERE list_contains(list_concat(t, p), 'the') AND NOT list_contains(list_concat(t, p), 'that') AND NOT len(list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND t[i + 1] = 'the')) > 0""")
def search_not(spark, d):
    m = matching
    return _expression(spark, d, m.All(m.Word("the"), m.Not(m.Word("that")), m.Not(m.Phrase("of the")))).select("doc_id")


@query(f"""WITH {_TP} SELECT doc_id FROM d WHERE len(list_filter(range(1, len(t) + 1), lambda i: t[i] = 'licensed' AND (list_contains(t[greatest(i - 4, 1):greatest(i - 1, 0)], 'license') OR list_contains(t[i + 1:i + 4], 'license')))) > 0""")
def search_near(spark, d):
    """Two words with at most three between them, in any order."""
    return _expression(spark, d, matching.Near("licensed", "license", 3)).select("doc_id")


@query(f"""WITH {_TP} SELECT doc_id FROM d WHERE list_contains(p, 'en') AND (list_contains(t, 'rights') OR list_contains(t, 'en'))""")
def search_column(spark, d):
    """Words of one column, beside words of the other."""
    m = matching
    return _expression(spark, d, m.All(m.In("place", m.Phrase("from en")), m.In("text", m.Any(m.Word("rights"), m.Word("en"))))).select("doc_id")


# --- streams in any order -------------------------------------------------------------------------------


def _shuffled(spark, d, columns):
    """Events as seven files in which each user's events are out of order."""
    base = work_dir(spark, "shuffled")
    _events(spark, d).select(*columns).repartition(7, F.xxhash64("event_id")).write.parquet(base)
    return base


@query("""SELECT event_id, coalesce(last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), value) AS filled FROM events""")
def stream_fill(spark, d):
    """Carry-forward over a stream whose files come in any order."""
    path = _shuffled(spark, d, ["event_id", "ts", "user_id", "event_type", "value"])
    prepare = lambda s: s.withColumn("id", F.col("event_id")).withColumn("valid", F.col("event_type") != "error")
    out = ordered.folded(spark, path, "user_id", "ts", "event_id", ["id", "value", "valid"], ordered.CarryForward(), "400 days", files=4, prepare=prepare)
    return out.select(F.col("id").alias("event_id"), "filled")


@query("""WITH e AS (SELECT user_id, epoch_us(ts) AS us, event_id, CASE event_type WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'in_progress' END AS status FROM events),
n AS (SELECT *, lead(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS after FROM e)
SELECT user_id AS clip_id, status, us AS at_us, false AS released FROM n UNION ALL SELECT user_id, 'pending', us + 7200000000, true FROM n WHERE status = 'in_progress' AND (after IS NULL OR after > us + 7200000000)""")
def stream_leases(spark, d):
    """Claims that no heartbeat follows within two hours come back as pending, whatever order the files come in."""
    path = _shuffled(spark, d, ["event_id", "ts", "user_id", "event_type"])
    status = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "failed").otherwise("in_progress")
    out = ordered.folded(spark, path, "user_id", "ts", "event_id", ["status"], ordered.Leases(7200), "400 days", files=4, prepare=lambda s: s.withColumn("status", status))
    return out.withColumnRenamed("user_id", "clip_id")


# --- advice -------------------------------------------------------------------------------------------


@query(f"""WITH {_CS} SELECT true AS applicable, array_to_string(list_filter([CASE WHEN n_persons < 5 THEN 'start from a trained checkpoint: a large model learns little from so few persons' END, CASE WHEN train_minutes < 15 THEN 'adapt at low rank: it keeps what the model knows' END,
CASE WHEN train_minutes < 60 THEN 'take fewer steps than 600000 or more footage, and watch the validation curve' END, CASE WHEN n_persons > 1 THEN 'condition on the person: ' || n_persons || ' persons would average into one' END], lambda x: x IS NOT NULL), '; ') AS recommendations FROM cs
UNION ALL SELECT false, ''""")
def risk_advice(spark, d):
    """What would lower the risk, for a generator and for a method that is none."""
    scored = dataset.risk_score(dataset.corpus_stats(_index(spark, d), "person_id", "n_frames", "fps", "split"), 600_000, 64)
    rows = dataset.risk_advice(scored, "MDM", 600_000).unionByName(dataset.risk_advice(scored, "tracker", 600_000))
    return rows.select("applicable", F.array_join("recommendations", "; ").alias("recommendations"))


# --- archives -----------------------------------------------------------------------------------------


@query("SELECT 'label' || label AS unit, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INT AS frame, vec_id::BIGINT AS place, embedding[1:3] AS trans FROM embeddings")
def archives_back(spark, d):
    """Vectors as archives of a label each, and two of their four members read back."""
    e = table(spark, d, "embeddings").withColumn("unit", F.concat(F.lit("label"), "label"))
    rows = ranges.numbered(e, ["unit"], ["vec_id"], "frame").withColumn("frame", F.col("frame").cast("int"))
    base = work_dir(spark, "archives")
    archives.write_archives(rows.select("unit", "frame", F.col("vec_id").alias("place"), F.slice("embedding", 1, 3).alias("trans"), F.col("embedding").alias("pose"), F.lit(30.0).alias("fps")), base)
    return archives.read_archives(spark, base, "unit string, frame int, place long, trans array<float>")


# --- motion capture text, new files -------------------------------------------------------------------


@query("""WITH p AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding::DOUBLE[] AS e FROM embeddings)
SELECT label, 'frame' AS kind, count(*)::BIGINT AS lines, round(sum(round(e[1] * 100, 6)), 3)::DOUBLE AS x, 75::BIGINT AS numbers FROM p GROUP BY 1
UNION ALL SELECT label, 'Frames: ' || count(*), 1, 0, 0 FROM p GROUP BY 1 UNION ALL SELECT DISTINCT label, 'Frame Time: 0.03333333', 1, 0.0, 0 FROM p UNION ALL SELECT DISTINCT label, 'MOTION', 1, 0.0, 0 FROM p""")
def motion_text(spark, d):
    """Motion capture text written by label and read back, line by line."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, d, "embeddings").select("label", "vec_id", F.slice(e, 1, 3).alias("trans"), F.concat(e, F.slice(e, 1, 8)).alias("pose"))
    frames = ranges.numbered(rows, ["label"], ["vec_id"], "frame")
    base = work_dir(spark, "bvh")
    skeleton.write_bvh(skeleton.bvh_lines(frames, "label", "frame", "pose", "trans", {n: [0.0, 0.1, 0.0] for n in skeleton.JOINTS}, 30.0), "label", base)
    lines = spark.read.schema("value string, label int").text(base)
    is_frame = F.col("value").rlike("^-?[0-9]+[.]")
    told = lines.filter(is_frame | F.col("value").rlike("^(Frame|MOTION)"))
    numbers = F.split("value", " ")
    kind = F.when(is_frame, "frame").otherwise(F.col("value"))
    x, size = F.when(is_frame, F.get(numbers, F.lit(0)).cast("double")).otherwise(0.0), F.when(is_frame, F.size(numbers)).otherwise(0)
    return told.groupBy("label", kind.alias("kind")).agg(F.count("*").alias("lines"), F.round(F.sum(x), 3).alias("x"), F.max(size).cast("long").alias("numbers"))


@query("SELECT event_type AS folder, 1::BIGINT AS files, true AS sized FROM events GROUP BY 1")
def stream_files(spark, d):
    """A stream of files as they appear, by path and size, their content not read."""
    base = work_dir(spark, "files")
    _events(spark, d).select("event_type", "value").repartition(1, "event_type").write.partitionBy("event_type").parquet(f"{base}/in")
    out = jobs.new_files(spark, f"{base}/in").writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").option("path", f"{base}/out").trigger(availableNow=True).start()
    out.awaitTermination()
    seen = spark.read.parquet(f"{base}/out").filter(F.col("path").endswith(".parquet"))
    return seen.groupBy(F.regexp_extract("path", "event_type=([^/]*)/", 1).alias("folder")).agg(F.count("*").alias("files"), F.bool_and(F.col("length") > 0).alias("sized"))


# --- estimators' own forms ----------------------------------------------------------------------------


@query("""WITH e AS (SELECT label, vec_id, vec_id % 3 AS track, list_concat(embedding::DOUBLE[], embedding[1:8]::DOUBLE[]) AS pose, embedding[2:4]::DOUBLE[] AS trans FROM embeddings),
c AS (SELECT label, track, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, track) AS r FROM e GROUP BY 1, 2)
SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_idx, list_transform(pose, lambda v: round(v, 5)) AS pose, list_transform(trans, lambda v: round(v, 5)) AS trans FROM e JOIN c USING (label, track) WHERE r = 1""")
def estimator_forms(spark, d):
    """Tracks in one estimator's form: the longest one's world pose and place."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, d, "embeddings").select("label", "vec_id", (F.col("vec_id") % 3).alias("track"), F.concat(e, F.slice(e, 1, 8)).alias("pose_world"), F.array_repeat(F.lit(0.0), 72).alias("pose"), F.slice(e, 2, 3).alias("trans_world"), F.slice(e, 1, 3).alias("trans"))
    rounded = lambda c: F.transform(c, lambda v: rot.rounded(v, 5)).alias(c)
    return estimates.motion_of("wham", rows, "label", "vec_id", "track").select("label", "frame_idx", rounded("pose"), rounded("trans"))
