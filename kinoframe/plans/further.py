"""Queries of poses, tracks, pictures, people's motion and streams, with the same rows as SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import rotations as rot
from ..functions import text as tx
from ..operators import captions, consent, dataset, estimates, inventory, motion, search, series, skeleton, state, vectors
from ..sources import readers
from ..sources.folders import work_dir
from ..streaming import jobs
from .media import table
from .motion import _CS, _E, _FIT, _SIX, _SWAP, ORDER, _events, _frames, _index, _pose
from .registry import registry

QUERIES, SQL, query = registry()


# --- poses ----------------------------------------------------------------------------------

_P = "p AS (SELECT vec_id, list_concat(embedding::DOUBLE[], embedding[1:8]::DOUBLE[]) AS pose, embedding::DOUBLE[] AS e FROM embeddings)"


@query(f"""WITH {_P} SELECT vec_id, list_transform(range(72), lambda k: pose[3 * {_SWAP}[k // 3 + 1] + k % 3 + 1] * CASE WHEN k % 3 = 0 THEN 1 ELSE -1 END) AS pose, [-e[1], e[2], e[3]] AS trans,
CASE WHEN vec_id % 2 = 0 THEN list_transform(range(45), lambda k: e[k + 2] * CASE WHEN k % 3 = 0 THEN 1 ELSE -1 END) END AS left_hand, list_transform(range(45), lambda k: e[k + 1] * CASE WHEN k % 3 = 0 THEN 1 ELSE -1 END) AS right_hand FROM p""")
def mirrored_motion(spark, d):
    """Whole motion in a mirror: a mirrored left hand is a right one."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    m = table(spark, d, "embeddings").select("vec_id", F.concat(e, F.slice(e, 1, 8)).alias("pose"), F.slice(e, 1, 3).alias("trans"), F.slice(e, 1, 45).alias("left_hand"), F.when(F.col("vec_id") % 2 == 0, F.slice(e, 2, 45)).alias("right_hand"))
    return motion.mirrored(m)


@query(f"""WITH {_SIX} SELECT vec_id, round(degrees(acos(greatest(-1, least(1, (x[1] + y[2] + z[3] - 1) / 2)))), 3)::DOUBLE AS angle FROM m WHERE x[1] + y[2] + z[3] > -0.9""")
def six_to_axis_angle(spark, d):
    """The angle of a rotation in the 6-d form; near half a turn, where the axis' sign is open, rows are left out."""
    m = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 6), lambda v: v.cast("double")).alias("v"))
    m = m.select("vec_id", rot.matrix_of_six(F.col("v")).alias("m"), rot.axis_angle_of_six(F.col("v")).alias("r"))
    m = m.filter(F.get("m", F.lit(0)) + F.get("m", F.lit(4)) + F.get("m", F.lit(8)) > -0.9)
    return m.select("vec_id", F.round(F.degrees(rot.norm(rot.parts(F.col("r"), 3))), 3).alias("angle"))


@query("""SELECT vec_id, list_transform(list_concat(embedding[1:3], embedding[1:63], CASE WHEN vec_id % 2 = 0 THEN embedding[1:6] ELSE [0,0,0,0,0,0]::FLOAT[] END), lambda v: round(v::DOUBLE, 5)) AS pose FROM embeddings""")
def assembled_pose(spark, d):
    """A body of 21 or 23 joints, every third given as matrices, as its 72 numbers."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, d, "embeddings").select("vec_id", F.slice(e, 1, 3).alias("orient"), F.when(F.col("vec_id") % 2 == 0, F.concat(F.slice(e, 1, 63), F.slice(e, 1, 6))).otherwise(F.slice(e, 1, 63)).alias("body"))
    as_matrices = F.flatten(F.transform(F.sequence(F.lit(0), (F.size("body") / 3 - 1).cast("int")), lambda j: rot.matrix_of_axis_angle(F.slice("body", 3 * j + 1, 3))))
    rows = rows.withColumn("body", F.when(F.col("vec_id") % 3 == 0, as_matrices).otherwise(F.col("body")))
    return rows.select("vec_id", F.transform(rot.body_pose(F.col("orient"), F.col("body")), lambda v: rot.rounded(v, 5)).alias("pose"))


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 5) AS x, round(embedding[2]::DOUBLE, 5) AS y, round(embedding[3]::DOUBLE, 5) AS z FROM embeddings")
def wrist_round_trip(spark, d):
    """A wrist's own rotation, brought to the world down the arm, and back into the forearm's frame."""
    poses = _pose(spark, d).withColumn("pose", F.concat(F.slice("pose", 1, 60), F.slice("pose", 1, 12)))
    world = skeleton.global_rotations(poses, "pose")
    own = rot.wrist_in_body(F.col("global_rotation"), 20, rot.axis_angle_of_matrix(F.slice("global_rotation", 9 * 20 + 1, 9)))
    return world.select("vec_id", own.alias("r")).select("vec_id", *(rot.rounded(F.get("r", F.lit(i)), 5).alias(n) for i, n in enumerate("xyz")))


@query("""SELECT vec_id, round(v[1] * (1 - 2 * (q[3] * q[3] + q[4] * q[4])) + v[2] * 2 * (q[2] * q[3] - q[1] * q[4]) + v[3] * 2 * (q[2] * q[4] + q[1] * q[3]), 6)::DOUBLE AS x FROM
(SELECT vec_id, list_transform(embedding[1:4]::DOUBLE[], lambda c: c / sqrt(list_sum(list_transform(embedding[1:4]::DOUBLE[], lambda a: a * a)))) AS q, embedding[5:7]::DOUBLE[] AS v FROM embeddings)""")
def quaternion_rotate(spark, d):
    e = F.transform("embedding", lambda v: v.cast("double"))
    size = rot.norm(rot.parts(e, 4))
    rows = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice(e, 1, 4), lambda c: c / size).alias("q"), F.slice(e, 5, 3).alias("v"))
    return rows.select("vec_id", F.round(F.get(rot.rotate(F.col("q"), F.col("v")), F.lit(0)), 6).alias("x"))


@query("""SELECT j::INT AS joint, round(sum(w * x), 5)::DOUBLE AS x, round(sum(w * y), 5)::DOUBLE AS y FROM (SELECT p_partkey % 24 AS j, 1.0 / p_size AS w, p_retailprice AS x, p_size::DOUBLE AS y FROM part) GROUP BY 1""")
def rest_joints(spark, d):
    part = table(spark, d, "part")
    weights = part.select((F.col("p_partkey") % 24).cast("int").alias("joint"), F.col("p_partkey").alias("vid"), (1.0 / F.col("p_size")).alias("w"))
    vertices = part.select(F.col("p_partkey").alias("vid"), F.col("p_retailprice").alias("x"), F.col("p_size").cast("double").alias("y"), F.lit(0.0).alias("z"))
    return skeleton.rest_joints(weights, vertices).select("joint", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query(f"""WITH {_E}, a AS (SELECT user_id, i, value, coalesce(sum(value / 1000) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS t, lag(value / 100) OVER (PARTITION BY user_id ORDER BY i) AS v FROM e),
s AS (SELECT *, coalesce(v, 0) * cos(2 * t) AS dx, coalesce(v, 0) * sin(2 * t) AS dz FROM a)
SELECT user_id, i::INT AS frame_idx, round(sum(dx) OVER (PARTITION BY user_id ORDER BY i), 4)::DOUBLE AS x, round(value / 50, 4)::DOUBLE AS y, round(sum(dz) OVER (PARTITION BY user_id ORDER BY i), 4)::DOUBLE AS z FROM s""")
def feature_root(spark, d):
    """The root's path out of its turning speed and its velocity across the floor."""
    f = _frames(spark, d).withColumn("v", F.concat(F.array(F.col("value") / 1000, F.col("value") / 100, F.lit(0.0), F.col("value") / 50), F.array_repeat(F.lit(0.0), 63)))
    out = skeleton.feature_root(f.select("user_id", "frame_idx", "v"), "user_id", "frame_idx", "v")
    return out.select("user_id", "frame_idx", *(F.round(c, 4).alias(c) for c in "xyz"))


# --- tracks and pictures ---------------------------------------------------------------------------

_SUBJECT = f"""WITH {_E}, c AS (SELECT user_id, event_type, count(*) AS c, min(i) AS f FROM e GROUP BY 1, 2), t AS (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, f) AS r FROM c) WHERE r = 1),
s AS (SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY e.i) - 1 AS place FROM e JOIN t USING (user_id, event_type))"""


@query(f"{_SUBJECT} SELECT user_id, event_id, place::INT AS place FROM s")
def subject_frames(spark, d):
    """Each unit's frames of the track seen most, in order."""
    return motion.subject_frames(table(spark, d, "events"), "user_id", "event_type", ORDER).select("user_id", "event_id", "place")


@query("SELECT user_id, list(round(value, 3) ORDER BY ts, event_id) AS frames FROM events GROUP BY 1")
def stacked_frames(spark, d):
    e = table(spark, d, "events").withColumn("value", F.round("value", 3))
    return motion.stacked(e, "user_id", ORDER, "value")


@query("SELECT doc_id, coalesce(quality, toxic, doc_id % 5)::BIGINT AS value FROM documents LEFT JOIN labels USING (doc_id)")
def first_value(spark, d):
    """The first of several columns that is there and holds a value."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").withColumn("rest", F.col("doc_id") % 5)
    return rows.select("doc_id", readers.first_value(rows, "no_such", "quality", "toxic", "rest").cast("long").alias("value"))


@query("""WITH f AS (SELECT label, vec_id, embedding::DOUBLE[] AS e, lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings)
SELECT label, round(coalesce(avg(list_sum(list_transform(range(1, 65), lambda k: abs(e[k] - b[k]))) / 64) / 255, 0), 8)::DOUBLE AS activity FROM f GROUP BY 1""")
def frame_activity(spark, d):
    rows = table(spark, d, "embeddings").select("label", "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    return motion.activity(rows, "label", "vec_id", "e").withColumn("activity", F.round("activity", 8))


@query("""SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 0.0 ELSE round(sqrt((vec_id % 3) * (vec_id % 3) + (vec_id % 2) * (vec_id % 2)), 6) END::DOUBLE AS shift FROM embeddings""")
def camera_shift(spark, d):
    """Each vector as a picture of 8 by 8, and the same moved round by some rows and columns."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    rows = table(spark, d, "embeddings").select("vec_id", e.alias("p"), (F.col("vec_id") % 3).cast("int").alias("dy"), (F.col("vec_id") % 2).cast("int").alias("dx"))
    moved = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.get("p", (F.pmod(F.floor(i / 8) - F.col("dy"), F.lit(8)) * 8 + F.pmod(i % 8 - F.col("dx"), F.lit(8))).cast("int")))
    both = rows.select("vec_id", F.lit(0).alias("frame"), F.col("p")).unionByName(rows.filter("vec_id % 4 <> 0").select("vec_id", F.lit(1).alias("frame"), moved.alias("p")))
    return motion.camera_shift(both, "vec_id", "frame", "p", 8).withColumn("shift", F.round("shift", 6))


@query("""SELECT o_orderkey, c_custkey AS hand, o_orderstatus FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0""")
def grafted_hands(spark, d):
    body = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("frame"), "o_orderstatus")
    hands = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("frame"), F.col("c_custkey").alias("hand"))
    return motion.graft(body, hands, ["frame"]).select("o_orderkey", "hand", "o_orderstatus")


@query("SELECT vec_id, list_transform(range(1, 65), lambda k: round(0.75 * embedding[k]::DOUBLE + 0.25 * k, 5)) AS v FROM embeddings")
def blended(spark, d):
    e = F.transform("embedding", lambda v: v.cast("double"))
    k = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: i.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", F.transform(series.blend(e, k, 0.25), lambda v: F.round(v, 5)).alias("v"))


_WEEKS = "FROM (SELECT * REPLACE (user_id * 1000 + (epoch(ts)::BIGINT - 1704067200) // 172800 AS user_id) FROM events)"


@query(f"WITH {_FIT} SELECT event_id, round(0.5 * value + 0.5 * coalesce(fit, value), 5)::DOUBLE AS refined FROM e LEFT JOIN f USING (user_id, i)".replace("FROM events", _WEEKS).replace("epoch(ts)::BIGINT", "floor(epoch(ts))::BIGINT"))
def refined_short(spark, d):
    """A refiner by its name over units of two days; those no longer than its window stay as they are."""
    second = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    units = _events(spark, d).withColumn("user_id", F.col("user_id") * 1000 + F.floor((second - 1704067200) / 172800))
    return series.refine(units, "savgol", "user_id", ORDER, "value", 0.5).select("event_id", F.round("refined", 5).alias("refined"))


@query("SELECT vec_id, [0.0, 0.0, 0.0]::DOUBLE[] AS trans FROM embeddings")
def anonymized(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda v: v.cast("double")).alias("trans"), F.col("embedding").alias("betas"))
    out = consent.anonymize(rows, zero_position=True)
    return out.select("vec_id", F.transform("trans", lambda v: F.abs(v)).alias("trans"))


@query("SELECT c_custkey, c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_acctbal < 0 AS static FROM customer")
def static_hint(spark, d):
    motion_ = F.when(F.col("c_acctbal") < 0, "static")
    return table(spark, d, "customer").select("c_custkey", consent.static_hint(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"], motion_).alias("static"))


@query("SELECT c_custkey, c_name FROM customer")
def unique_keys(spark, d):
    return inventory.checked_unique(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'failed' WHEN page_id % 4 = 1 THEN 'done' WHEN page_id % 4 = 2 THEN 'excluded' ELSE 'pending' END AS status, url AS source FROM pages""")
def imported_inventory(spark, d):
    word = F.get(F.array(*map(F.lit, ("POSE_FAILED", "pose_done", "excluded", "new"))), F.col("page_id") % 4)
    clips = table(spark, d, "pages").select(F.col("page_id").alias("clip_id"), word.alias("status"), F.col("url").alias("rel_path"))
    return state.import_inventory(clips).withColumnRenamed("clip_id", "page_id")


@query("""SELECT doc_id, trim(left(text, 20)) AS description, 'a|b' AS tags FROM documents WHERE NOT contains(left(text, 20), chr(10)) AND text <> ''""")
def reply_label(spark, d):
    """A label out of a model's reply: the JSON object in prose, its tags trimmed."""
    docs = table(spark, d, "documents").filter(~F.contains(F.substring("text", 1, 20), F.lit("\n")) & (F.col("text") != ""))
    reply = F.concat(F.lit("Sure!\n"), F.to_json(F.struct(F.substring("text", 1, 20).alias("description"), F.array(F.lit(" a "), F.lit(" "), F.lit("b")).alias("tags"))), F.lit("\nDone."))
    description, tags = tx.reply_label(reply)
    return docs.select("doc_id", description.alias("description"), F.array_join(tags, "|").alias("tags"))


@query("""SELECT doc_id, CASE WHEN t = '' THEN 'a person moves#a/DET person/NOUN moves/VERB#0.0#0.0' || chr(10) ELSE t || '#' || t || '/OTHER#0.0#0.0' || chr(10) END AS line FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS t FROM documents)""")
def text_caption(spark, d):
    said = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang"))
    return table(spark, d, "documents").select("doc_id", tx.clip_caption("text", F.lit(None), said, F.lit(None)).alias("line"))


@query("""WITH w AS (SELECT conv_id, turn, text, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS tag, unnest(range(len(regexp_extract_all(lower(text), '[a-z]+')))) AS pos FROM conversations),
c AS (SELECT conv_id, tag, count(*) AS n, min(row(turn, text, pos)) AS f FROM w WHERE length(tag) > 2 AND tag NOT IN ('a','an','the','in','on','by','at','near','of','and','to','is','are') GROUP BY 1, 2),
b AS (SELECT conv_id, string_agg(tag, ' ' ORDER BY n DESC, f) AS tags FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, f) AS r FROM c) WHERE r <= 3 GROUP BY 1)
SELECT conv_id, count(*)::BIGINT AS n, coalesce(any_value(tags), '') AS tags FROM conversations LEFT JOIN b USING (conv_id) GROUP BY 1""")
def segment_tags(spark, d):
    label = search.segment_label(table(spark, d, "conversations"), ["conv_id"], "turn", "text", tags=3)
    return label.select("conv_id", "n", F.array_join("tags", " ").alias("tags"))


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents), c AS (SELECT doc_id, len(t) AS l, len(list_filter(t, lambda x: starts_with(x, 'licens'))) AS b FROM w),
s AS (SELECT count(*) AS n, avg(l) AS m, count(*) FILTER (WHERE b > 0) AS db FROM c)
SELECT doc_id, round(ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * l / m)), 6)::DOUBLE AS score FROM c, s WHERE b > 0 ORDER BY ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * l / m)) DESC, doc_id LIMIT 10""")
def index_search(spark, d):
    """A ranked search that reads its terms' postings from a written index."""
    base, docs = work_dir(spark, "index"), table(spark, d, "documents")
    search.postings(docs, "doc_id", "text").write.parquet(f"{base}/postings")
    docs.select("doc_id", F.size(tx.terms(F.col("text"))).alias("length")).write.parquet(f"{base}/lengths")
    found = search.bm25_of_index(spark.read.parquet(f"{base}/postings"), spark.read.parquet(f"{base}/lengths"), "doc_id", "licens*", 10)
    return found.withColumn("score", F.round("score", 6))


# --- captions and state -----------------------------------------------------------------------------


@query("SELECT s.conv_id AS video_id, s.turn::INT AS seg_index, s.role, s.text AS description FROM conversations s WHERE s.turn % 2 = 1")
def labelled_segments(spark, d):
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").cast("int").alias("seg_index"), "role", "text")
    labels = turns.filter("seg_index % 2 = 1").select("video_id", "seg_index", F.col("text").alias("description"))
    return captions.labelled(turns.drop("text"), labels)


@query("SELECT conv_id AS video_id, turn::INT AS seg_index FROM conversations WHERE turn % 2 = 0")
def unlabelled_segments(spark, d):
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").cast("int").alias("seg_index"))
    return captions.unlabelled(turns, turns.filter("seg_index % 2 = 1"))


@query("SELECT count(DISTINCT conv_id)::BIGINT AS videos, count(DISTINCT role)::BIGINT AS roles FROM conversations")
def distinct_videos(spark, d):
    return captions.distinct_counts(table(spark, d, "conversations"), videos=F.col("conv_id"), roles=F.col("role"))


@query("""SELECT doc_id, i::BIGINT AS frame FROM (SELECT doc_id, CASE WHEN n_chars = 0 THEN []::BIGINT[] WHEN least(16, n_chars) = 1 THEN [0::BIGINT] ELSE list_transform(range(least(16, n_chars)), lambda k: floor(k * (n_chars - 1) / (least(16, n_chars) - 1))::BIGINT) END AS f FROM documents WHERE n_chars IS NOT NULL), unnest(f) x(i)""")
def sampled_frames(spark, d):
    """Sixteen evenly spaced frames of each clip; a document's characters stand for its frames."""
    docs = table(spark, d, "documents").filter("n_chars IS NOT NULL")
    return docs.select("doc_id", F.explode(captions.evenly_spaced(F.col("n_chars"), 16)).alias("frame"))


@query("""SELECT count(*) FILTER (WHERE event_type = 'signup')::BIGINT AS in_progress, count(*) FILTER (WHERE event_type = 'signup' AND epoch(ts) < 1704585600 - 3600)::BIGINT AS released FROM events""")
def stale_counts(spark, d):
    store = table(spark, d, "events").select(F.when(F.col("event_type") == "signup", "in_progress").otherwise("done").alias("status"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("updated"))
    return state.stale_counts(store, 1704585600.0, 3600.0)


@query("""SELECT c_custkey AS camera, CASE WHEN c_nationkey % 2 = 0 AND c_acctbal > 0 THEN [1,2,4,5,7,8,10,11,12,15] WHEN c_nationkey % 2 = 0 THEN [12,15] WHEN c_acctbal > 0 THEN [1,2,4,5,7,8,10,11] ELSE [] END AS joints FROM customer""")
def partial_cameras(spark, d):
    """Hidden regions, and the legs where a camera sees a part of the body only."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("camera"), F.when(F.col("c_nationkey") % 2 == 0, " Head").alias("region"), (F.col("c_acctbal") > 0).alias("partial"))
    return inventory.occluded_joints(rows, partial="partial")


@query(f"""{_SUBJECT} SELECT user_id, place::INT AS frame_idx, round(value / 100, 5)::DOUBLE AS turn, round(value / 50, 5)::DOUBLE AS height FROM s""")
def estimator_tracks(spark, d):
    """Detections under an estimator's own names as the motion of the person seen most."""
    f = _frames(spark, d)
    rows = f.select("user_id", F.col("event_type").alias("subject_ids"), F.col("frame_idx").alias("frame_ids"), F.concat(F.array(F.col("value") / 100, F.lit(0.0), F.lit(0.0)), F.array_repeat(F.lit(0.1), 69)).alias("poses"), F.array(F.lit(0.0), F.col("value") / 50, F.lit(0.0)).alias("cam_trans"))
    out = estimates.subject_motion(rows, "user_id")
    return out.select("user_id", "frame_idx", F.round(F.get("pose", F.lit(0)), 5).alias("turn"), F.round(F.get("trans", F.lit(1)), 5).alias("height"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM c) WHERE r = 1)
SELECT event_id FROM events JOIN t USING (user_id, event_type)""")
def longest_tracks(spark, d):
    return estimates.longest_track_motion(table(spark, d, "events"), "user_id", "event_type", "ts").select("event_id")


@query(f"""WITH {_P} SELECT vec_id, list_transform(range(24), lambda j: {_SWAP}[j + 1] % 3 = vec_id % 3) AS valid, list_transform(e[1:45], lambda v: round(v, 5)) AS hand FROM p""")
def hands_and_masks(spark, d):
    """A mask of joints in a mirror, and a hand given as matrices."""
    e = F.transform("embedding", lambda v: v.cast("double"))
    valid = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda j: j % 3 == F.col("vec_id") % 3)
    rows = table(spark, d, "embeddings").select("vec_id", F.slice(e, 1, 45).alias("h"), valid.alias("v"))
    matrices = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(14)), lambda j: rot.matrix_of_axis_angle(F.slice("h", 3 * j + 1, 3))))
    return rows.select("vec_id", rot.mirror_mask(F.col("v")).alias("valid"), F.transform(rot.hand_pose(matrices), lambda v: rot.rounded(v, 5)).alias("hand"))


# --- datasets ---------------------------------------------------------------------------------------


@query(f"""WITH {_CS}, s AS (SELECT *, 600000 * 64 / greatest(1, train_frames) AS e FROM cs)
SELECT array_to_string(list_filter([CASE WHEN e > 60 THEN 'each training frame is seen about ' || printf('%.0f', e) || ' times' END, CASE WHEN train_minutes < 60 THEN 'only ' || printf('%.1f', train_minutes) || ' minutes of training motion' END, 'training starts from nothing',
CASE WHEN n_persons >= 5 THEN n_persons || ' persons add variety' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM s""")
def risk_reasons(spark, d):
    stats = dataset.corpus_stats(_index(spark, d), "person_id", "n_frames", "fps", "split")
    return dataset.risk_reasons(dataset.risk_score(stats, 600_000, 64)).select(F.array_join("reasons", "; ").alias("reasons"))


@query("SELECT doc_id::VARCHAR AS person, sum(len(text))::BIGINT AS frames FROM documents GROUP BY 1 HAVING sum(len(text)) / 20.0 / 60 < 3")
def underrepresented(spark, d):
    """Each document as a person's clip."""
    docs = table(spark, d, "documents").withColumn("frames", F.length("text").cast("long"))
    return dataset.underrepresented(dataset.person_coverage(docs, "doc_id", "frames")).select("person", "frames")


_NEAR = """WITH v AS (SELECT p_brand AS asset, p_partkey AS vid, p_size::DOUBLE AS x, p_retailprice AS y, (p_partkey % 97)::DOUBLE AS z FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY vid) - 1 AS i FROM v),
m AS (SELECT asset, count(*) AS n, median(x) AS cx, median(y) AS cy, median(z) AS cz, max(x) - min(x) AS ex, max(y) - min(y) AS ey, max(z) - min(z) AS ez FROM v GROUP BY 1),
a AS (SELECT *, list_sort([{'e': -ex, 'k': 0}, {'e': -ey, 'k': -1}, {'e': -ez, 'k': -2}])[2].k * -1 AS axis FROM m),
c AS (SELECT DISTINCT asset, CASE WHEN least(800, n) > 1 THEN floor(k * (n - 1) / (least(800, n) - 1)) ELSE 0 END::BIGINT AS i FROM (SELECT asset, n, unnest(range(least(800, n))) AS k FROM m)),
p AS (SELECT n.asset, n.i, x, y, z, CASE axis WHEN 0 THEN 2 * cx - x ELSE x END AS mx, CASE axis WHEN 1 THEN 2 * cy - y ELSE y END AS my, CASE axis WHEN 2 THEN 2 * cz - z ELSE z END AS mz FROM n JOIN c USING (asset, i) JOIN a USING (asset)),
d AS (SELECT p.asset, p.i, min(sqrt((p.x - q.mx) * (p.x - q.mx) + (p.y - q.my) * (p.y - q.my) + (p.z - q.mz) * (p.z - q.mz))) AS d FROM p JOIN p q ON p.asset = q.asset GROUP BY 1, 2)"""


@query(_NEAR + """ SELECT asset, round(greatest(0, least(1, 1 - avg(d) / (0.1 * CASE WHEN sqrt(ex * ex + ey * ey + ez * ez) > 0 THEN sqrt(ex * ex + ey * ey + ez * ez) ELSE 1 END))), 6)::DOUBLE AS symmetry FROM d JOIN a USING (asset) GROUP BY asset, ex, ey, ez""")
def symmetry_scores(spark, d):
    from .motion import _vertices

    return vectors.symmetry_scores(_vertices(spark, d), "asset", "vid").withColumn("symmetry", F.round("symmetry", 6))


# --- streams ------------------------------------------------------------------------------------------


@query("SELECT event_type, (floor(epoch(ts))::BIGINT // 10800) * 10800 - k * 10800 AS start_s, count(*)::BIGINT AS n, round(sum(value), 4)::DOUBLE AS total FROM events, (VALUES (0), (1)) x(k) GROUP BY 1, 2")
def sliding_extension(spark, d):
    """Windows of six hours, one every three, of a stream drained to its end."""
    out = jobs.drained(spark, f"{d}/events.parquet", jobs.sliding, key="event_type", value="value", width="6 hours", slide="3 hours")
    return out.select("event_type", F.unix_seconds("start").alias("start_s"), "n", F.round("total", 4).alias("total"))


@query("SELECT user_id, event_type, count(DISTINCT event_id)::BIGINT AS n FROM events GROUP BY 1, 2")
def stream_distinct(spark, d):
    """Events of a stream in which each comes twice, without the repeats."""
    base = work_dir(spark, "twice")
    e = table(spark, d, "events")
    e.unionByName(e).write.parquet(base)
    return jobs.first_events(spark, base, ["event_id"], "400 days").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'before' ELSE event_type END AS label FROM events")
def stream_resume(spark, d):
    """A third of the segments are labelled already; the stream labels the rest."""
    labels = work_dir(spark, "labels")
    table(spark, d, "events").filter("event_id % 3 = 0").select("event_id", F.lit("before").alias("label")).write.parquet(labels)
    return jobs.label_rest(spark, f"{d}/events.parquet", ["event_id"], labels, lambda b: b.select("event_id", F.col("event_type").alias("label")))


@query("""WITH RECURSIVE o AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), w AS (SELECT user_id, event_id, i, value AS y FROM o WHERE i = 1 UNION ALL
SELECT o.user_id, o.event_id, o.i, 0.4 * o.value + 0.6 * w.y FROM w JOIN o ON o.user_id = w.user_id AND o.i = w.i + 1) SELECT event_id, round(y, 6)::DOUBLE AS mean FROM w""")
def stream_mean(spark, d):
    out = jobs.streamed_mean(spark, f"{d}/events.parquet", "user_id", ORDER, "value", 0.4)
    return out.select("event_id", F.round("mean", 6).alias("mean"))
