"""Queries that write datasets, indexes and logs and read them again, with the same rows as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import consent, intervals, publish, search, state
from ..sources import readers, synthetic, writers
from ..sources.folders import work_dir
from .media import table
from .registry import registry

QUERIES, SQL, query = registry()


# --- inventories and registries ---------------------------------------------------------


@query("SELECT 'region=' || n_regionkey AS camera, count(*)::BIGINT AS files FROM nation GROUP BY 1")
def file_scan(spark, d):
    """A folder of text files for each region, a file for each nation."""
    base = work_dir(spark, "files")
    names = table(spark, d, "nation").select(F.col("n_name").alias("value"), F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("nation"))
    names.repartition("nation").write.partitionBy("region", "nation").text(base)
    return readers.scan_files(spark, base, [".TXT"], 1).groupBy("camera").agg(F.count("*").alias("files"))


@query("""SELECT c_custkey::VARCHAR AS clip_id, CASE WHEN c_acctbal < 0 THEN 'failed' ELSE 'pose_done' END AS status, (c_custkey % 500)::INT AS n_frames,
CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 0 END::INT AS tracks, CASE WHEN c_custkey % 3 = 0 THEN 'person_' || (c_custkey % 7) END AS first_person FROM customer""")
def manifest_read(spark, d):
    """A manifest of each nation's customers written as JSON, nested tracks and all, and read again."""
    base = work_dir(spark, "manifest")
    track = lambda k, who: F.struct(F.lit(k).alias("track_id"), who.alias("person_id"))
    tracks = F.when(F.col("c_custkey") % 3 == 0, F.array(track("t0", F.concat(F.lit("person_"), F.col("c_custkey") % 7)), track("t1", F.lit(None).cast("string"))))
    clip = F.struct(F.col("c_custkey").cast("string").alias("clip_id"), F.when(F.col("c_acctbal") < 0, "failed").otherwise("pose_done").alias("status"), (F.col("c_custkey") % 500).alias("n_frames"), tracks.alias("tracks"))
    manifests = table(spark, d, "customer").groupBy(F.col("c_nationkey")).agg(F.collect_list(clip).alias("clips")).select(F.lit("/footage").alias("footage_root"), "clips")
    writers.write_json_rows(manifests, base)
    clips = readers.read_manifest(spark, base, lines=True)
    return clips.select("clip_id", "status", "n_frames", F.size("tracks").alias("tracks"), F.get("tracks", F.lit(0))["person_id"].alias("first_person"))


@query("SELECT s_suppkey::VARCHAR AS person_id, s_name AS display_name, s_acctbal > 0 AS granted FROM supplier")
def registry_read(spark, d):
    """A registry of people written as JSON and read again."""
    base = work_dir(spark, "registry")
    writers.write_registry(table(spark, d, "supplier").select(F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("display_name"), (F.col("s_acctbal") > 0).alias("granted")), base)
    return readers.read_registry(spark, base).select("person_id", "display_name", "granted")


@query("SELECT vec_id::VARCHAR AS unit_id, vec_id % 2 = 0 AS has_left, embedding[1:3] AS trans FROM embeddings")
def motion_store(spark, d):
    """Stored motion: a hand that was never estimated is null, before and after."""
    base = work_dir(spark, "motion")
    frames = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("unit_id"), F.lit(0).alias("frame_idx"), F.slice("embedding", 1, 3).alias("trans"), F.when(F.col("vec_id") % 2 == 0, F.slice("embedding", 1, 45)).alias("left_hand"))
    writers.write_motion(frames, base)
    return spark.read.parquet(base).select("unit_id", F.col("left_hand").isNotNull().alias("has_left"), "trans")


@query("SELECT p_brand AS asset_id, p_partkey::INT AS vid, p_size::DOUBLE AS x, p_retailprice AS y, 0.5::DOUBLE AS z FROM part")
def vertices_read(spark, d):
    base = work_dir(spark, "mesh")
    table(spark, d, "part").select(F.col("p_brand").alias("asset_id"), F.col("p_partkey").cast("int").alias("vid"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"), F.lit(0.5).alias("z")).write.parquet(base)
    return readers.read_vertices(spark, base)


@query("SELECT 'customer=' || (c_custkey % 50) AS camera, count(*)::BIGINT AS n FROM (SELECT DISTINCT c_custkey % 50 AS c_custkey FROM customer) GROUP BY 1")
def video_scan(spark, d):
    """A file of video for each of fifty folders; the scan keeps no camera, only the path."""
    base = work_dir(spark, "videos")
    rows = table(spark, d, "customer").select((F.col("c_custkey") % 50).alias("customer")).distinct().withColumn("value", F.lit("x"))
    rows.repartition("customer").write.partitionBy("customer").text(base)
    found = readers.scan_videos(spark, base, [".txt"])
    return found.groupBy(F.element_at(F.split("rel_path", "/"), 1).alias("camera")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 7")
def point_lookup(spark, d):
    return readers.lookup(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", 7)


# --- labels and captions -----------------------------------------------------------------


@query("SELECT conv_id::VARCHAR AS video_id, turn::INT AS seg_index, text AS description, role AS tag FROM conversations WHERE conv_id % 10 = 0")
def labels_read(spark, d):
    """A JSON file of labels for each video, keyed by the segment's number."""
    base = work_dir(spark, "labels")
    rows = table(spark, d, "conversations").filter("conv_id % 10 = 0")
    label = F.struct(F.col("text").alias("description"), F.array("role").alias("tags"))
    files = rows.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("turn").cast("string"), label))).alias("m"))
    files.select("conv_id", F.to_json("m").alias("value")).repartition("conv_id").write.partitionBy("conv_id").text(base)
    whole = spark.read.text(base, wholetext=True, recursiveFileLookup=True).select(F.regexp_extract(F.input_file_name(), r"conv_id=(\d+)", 1).alias("video_id"), readers.label_map(F.col("value")).alias("m"))
    return whole.select("video_id", F.explode("m").alias("seg_index", "l")).select("video_id", "seg_index", "l.description", F.get("l.tags", F.lit(0)).alias("tag"))


@query("""SELECT conv_id, turn, text FROM conversations WHERE turn > 0 UNION ALL SELECT conv_id, turn, 'new: ' || text FROM conversations WHERE turn = 0""")
def label_upsert(spark, d):
    store = table(spark, d, "conversations").select("conv_id", "turn", "text")
    return state.upsert_labels(store, store.filter("turn = 0").withColumn("text", F.concat(F.lit("new: "), "text")), ["conv_id", "turn"])


def _captions(spark, d):
    e = table(spark, d, "events")
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double")
    return e.select(F.col("user_id").alias("video_id"), "event_id", start.alias("start"), (start + F.col("event_id") % 7 + 1).alias("end"), F.col("event_type").alias("description"), F.array("event_type", F.lit("event")).alias("tags"))


_CAP = "c AS (SELECT user_id AS video_id, event_id, floor(epoch(ts))::DOUBLE AS s, floor(epoch(ts))::DOUBLE + event_id % 7 + 1 AS e, event_type AS t FROM events)"
_WIN = f"""WITH RECURSIVE {_CAP}, o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, e, event_id) AS i FROM c),
w AS (SELECT video_id, event_id, i, s AS ws, 0::BIGINT AS k FROM o WHERE i = 1 UNION ALL
SELECT o.video_id, o.event_id, o.i, CASE WHEN o.e - w.ws <= 86400 THEN w.ws ELSE o.s END, CASE WHEN o.e - w.ws <= 86400 THEN w.k ELSE w.k + 1 END FROM w JOIN o ON o.video_id = w.video_id AND o.i = w.i + 1)"""


@query(f"""{_WIN} SELECT video_id, k AS "window", min(s)::DOUBLE AS start, max(e)::DOUBLE AS "end", count(*)::BIGINT AS labels, min(t) AS first_tag FROM w JOIN c USING (video_id, event_id) GROUP BY 1, 2""")
def windows_json(spark, d):
    """Windows of captions as JSON lines, read again."""
    base = work_dir(spark, "windows")
    writers.write_json_rows(intervals.windows(_captions(spark, d), "video_id", 86400.0, ["description", "tags"]), base)
    rows = spark.read.schema("video_id long, window long, start double, end double, entries array<struct<start: double, end: double, description: string, tags: array<string>>>").json(base)
    return rows.select("video_id", "window", "start", "end", F.size("entries").cast("long").alias("labels"), F.array_min(F.transform("entries", lambda x: x["description"])).alias("first_tag"))


@query(f"""{_WIN}, x AS (SELECT video_id, k, min(s) AS a, max(e) AS b, list({{'s': s, 'e': e, 't': t}} ORDER BY s, e, t) AS r FROM w JOIN c USING (video_id, event_id) GROUP BY 1, 2)
SELECT video_id AS video, a AS start, b AS "end", 'Describe.' AS question, len(r)::BIGINT AS labels, round_even(r[len(r)].e - a, 2)::DOUBLE AS last_end, r[1].t AS first_description FROM x""")
def finetune_lines(spark, d):
    """Lines of conversations about windows, times from each window's start, read again."""
    base = work_dir(spark, "finetune")
    packed = intervals.windows(_captions(spark, d), "video_id", 86400.0, ["description", "tags"])
    writers.write_lines(intervals.finetune_payload(packed, "video_id", "Describe."), base, "payload")
    rows = spark.read.schema("video long, window array<double>, messages array<struct<role: string, content: string>>").json(base)
    answer = F.from_json(F.get("messages", F.lit(1))["content"], "array<struct<start: double, end: double, description: string, tags: array<string>>>")
    rows = rows.withColumn("r", answer)
    return rows.select("video", F.get("window", F.lit(0)).alias("start"), F.get("window", F.lit(1)).alias("end"), F.get("messages", F.lit(0))["content"].alias("question"), F.size("r").cast("long").alias("labels"),
                       F.element_at("r", -1)["end"].alias("last_end"), F.get("r", F.lit(0))["description"].alias("first_description"))


@query("SELECT user_id AS video_id, event_id, event_type || ' event' AS tags FROM events WHERE contains(event_type, 'sign')")
def search_index(spark, d):
    """Captions and postings written, and read by the term's own files."""
    base = work_dir(spark, "search")
    rows = _captions(spark, d)
    writers.write_search_index(rows, search.postings(rows, "event_id", "description"), base)
    wanted = F.pmod(F.xxhash64(F.lit("signup")), F.lit(64))
    hits = spark.read.parquet(f"{base}/postings").filter((F.col("bucket") == wanted) & (F.col("term") == "signup")).select("event_id")
    return spark.read.parquet(f"{base}/captions").join(hits, "event_id").select("video_id", "event_id", "tags")


@query("SELECT video_id, event_id, t AS description, t || ' event' AS tags FROM (SELECT user_id AS video_id, event_id, event_type AS t FROM events)")
def caption_index_json(spark, d):
    base = work_dir(spark, "captions")
    writers.write_json_rows(_captions(spark, d).select("video_id", "event_id", "description", "tags"), base)
    rows = spark.read.schema("video_id long, event_id long, description string, tags array<string>").json(base)
    return rows.withColumn("tags", F.array_join("tags", " "))


@query(f"""SELECT 'a' AS part, video_id, count(*)::BIGINT AS n FROM (WITH {_CAP} SELECT * FROM c) WHERE video_id % 2 = 0 GROUP BY 2 UNION ALL SELECT 'b', video_id, count(*)::BIGINT FROM (WITH {_CAP} SELECT * FROM c) WHERE video_id % 2 = 1 GROUP BY 2""")
def window_union(spark, d):
    """Windows of two parts of an archive in one list: each holds all captions of its part."""
    packed = [intervals.windows(_captions(spark, d).filter(f"video_id % 2 = {k}"), "video_id", 3600.0, ["description"]).withColumn("part", F.lit(p)) for k, p in ((0, "a"), (1, "b"))]
    return packed[0].unionByName(packed[1]).groupBy("part", "video_id").agg(F.sum(F.size("entries")).alias("n"))


@query("""SELECT conv_id, count(*)::BIGINT AS n, arg_min(text, turn) AS first_text, string_agg(role, ' ' ORDER BY turn) AS roles FROM conversations GROUP BY 1""")
def positional_zip(spark, d):
    """Turns as two lists, and zipped again by place."""
    lists = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("r"))
    lists = lists.select("conv_id", F.transform("r", lambda s: s["role"]).alias("times"), F.transform("r", lambda s: s["text"]).alias("captions"))
    rows = publish.zipped(lists, "times", "captions")
    packed = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.min_by("text", "at").alias("first_text"), F.array_sort(F.collect_list(F.struct("at", "time"))).alias("r"))
    return packed.select("conv_id", "n", "first_text", F.array_join(F.transform("r", lambda s: s["time"]), " ").alias("roles"))


# --- consent -------------------------------------------------------------------------------


@query("""SELECT 'audit' AS kind, event_type AS what, count(*)::BIGINT AS n FROM (SELECT CASE WHEN event_type = 'purchase' THEN 'grant' ELSE 'revoke' END AS event_type FROM events) GROUP BY 2
UNION ALL SELECT 'registry', CASE WHEN g THEN 'granted' ELSE 'not granted' END, count(*)::BIGINT FROM (SELECT c_custkey, coalesce(arg_max(event_type = 'purchase', row(event_id, event_type = 'purchase')), false) AS g FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1) GROUP BY 2""")
def consent_decisions(spark, d):
    """Grants and revocations: the registry after them, and the log of all, appended in two parts and read again."""
    base = work_dir(spark, "audit")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("display_name"), F.lit(False).alias("granted"), F.lit("all").alias("scope"), F.lit(None).cast("string").alias("granted_on"), F.lit(None).cast("string").alias("method"))
    decisions = table(spark, d, "events").join(customers.select(F.col("person_id").alias("user_id")), "user_id", "left_semi").select(F.col("user_id").alias("person_id"), (F.col("event_type") == "purchase").alias("granted"), F.lit("all").alias("scope"), F.lit("cli").alias("method"), F.format_string("%012d", "event_id").alias("at"))
    registry, audit = consent.decide(customers, decisions)
    others = table(spark, d, "events").join(customers.select(F.col("person_id").alias("user_id")), "user_id", "left_anti").select(F.when(F.col("event_type") == "purchase", "grant").otherwise("revoke").alias("event"))
    writers.append_events(audit.select("event", "person_id", "at"), base)
    writers.append_events(others, base)
    log = spark.read.schema("event string, at string").json(base).groupBy(F.lit("audit").alias("kind"), F.col("event").alias("what")).agg(F.count(F.col("at")).alias("n"))
    return log.unionByName(registry.groupBy(F.lit("registry").alias("kind"), F.when(F.col("granted"), "granted").otherwise("not granted").alias("what")).agg(F.count("*").alias("n")))


@query("SELECT o_orderkey AS unit_id FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer)")
def existing_units(spark, d):
    units = table(spark, d, "orders").select(F.col("o_orderkey").alias("unit_id"), F.concat("o_orderkey", F.lit(".npz")).alias("pose_rel"))
    files = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").filter("o_orderkey % 3 <> 0").select(F.concat("o_orderkey", F.lit(".npz")).alias("rel_path"))
    return publish.existing_units(units, files).select("unit_id")


@query("""SELECT 'track' AS kind, CASE WHEN vec_id % 5 <> 0 THEN printf('person_%02d', label) END AS person_id, count(*)::BIGINT AS n FROM embeddings GROUP BY 2
UNION ALL SELECT 'registry', p, 1 FROM (SELECT DISTINCT printf('person_%02d', label) AS p FROM embeddings WHERE vec_id % 5 <> 0 UNION SELECT 'person_00')""")
def identity_assignment(spark, d):
    e = table(spark, d, "embeddings")
    registry = spark.createDataFrame([("person_00", "Zero", True, "all")], "person_id string, display_name string, granted boolean, scope string")
    labels = e.filter("vec_id % 5 <> 0").select(F.col("vec_id").alias("unit_id"), F.col("label").alias("cluster"))
    tracks, people = publish.assigned(e.select(F.col("vec_id").alias("unit_id")), labels, registry)
    n = tracks.groupBy(F.lit("track").alias("kind"), "person_id").agg(F.count("*").alias("n"))
    return n.unionByName(people.select(F.lit("registry").alias("kind"), "person_id", F.lit(1).cast("long").alias("n")))


@query("SELECT doc_id, coalesce(quality, -1)::INT AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def labels_back(spark, d):
    return publish.labels_back(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", "quality")


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN '' ELSE 'quality=' || quality || ',toxic=' || toxic END || CASE WHEN source IS NULL THEN '' WHEN quality IS NULL THEN 'source=' || source ELSE ',source=' || source END AS attributes FROM documents LEFT JOIN labels USING (doc_id)""")
def attribute_map(spark, d):
    docs = publish.with_attributes(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")
    maps = publish.attribute_map(docs, "doc_id", ["quality", "toxic", "source"])
    return maps.select("doc_id", F.array_join(F.transform(F.map_entries("attributes"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("attributes"))


# --- datasets ---------------------------------------------------------------------------------


def _video_tables(spark, d):
    """Customers as videos, orders as captions, suppliers as people; two tracks for every third video."""
    videos = table(spark, d, "customer").select(F.col("c_custkey").alias("video_id"))
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("video_id"), (F.col("o_orderkey") % 10000).cast("int").alias("seg_index"), (F.col("o_orderkey") % 7).cast("double").alias("start"), (F.col("o_orderkey") % 7 + F.col("o_orderkey") % 5 * 0.75).alias("end"), F.col("o_orderstatus").alias("description"))
    v = F.col("video_id")
    tracks = videos.filter("video_id % 3 = 0").select("video_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select("video_id", F.concat(F.lit("t"), F.col("k")).alias("track_id"), ((v + F.col("k")) % 10 + 1).alias("person_id"), F.concat_ws("__", v.cast("string"), F.concat(F.lit("t"), F.col("k"))).alias("pose_rel"))
    registry = table(spark, d, "supplier").select(F.col("s_suppkey").alias("person_id"), (F.col("s_acctbal") > 0).alias("granted"))
    singles = videos.filter("video_id % 5 <> 0").select(F.concat(v.cast("string"), F.lit(".npz")).alias("rel_path"))
    files = singles.unionByName(tracks.filter("video_id % 4 <> 0").select(F.col("pose_rel").alias("rel_path")))
    number = F.regexp_extract("rel_path", r"^(\d+)", 1).cast("long")
    motions = files.select(F.col("rel_path").alias("file"), (60 + number % 200).alias("frames"), F.when(number % 2 == 0, 20.0).otherwise(30.0).alias("fps"), F.when(number % 11 == 0, "incam").otherwise("global").alias("frame"))
    return videos, rows, tracks, registry, files, motions


_VT = """v AS (SELECT c_custkey AS video_id FROM customer), r AS (SELECT o_custkey AS video_id, (o_orderkey % 10000)::INT AS seg, (o_orderkey % 7)::DOUBLE AS s, o_orderkey % 7 + o_orderkey % 5 * 0.75::DOUBLE AS e, o_orderstatus AS t FROM orders),
tr AS (SELECT video_id, k, (video_id + k) % 10 + 1 AS person_id FROM v, (VALUES (0), (1)) x(k) WHERE video_id % 3 = 0),
so AS (SELECT video_id, person_id, '__t' || k AS suffix, CASE WHEN NOT coalesce(s_acctbal > 0, false) THEN 'no_consent' WHEN video_id % 4 = 0 THEN 'no_file' ELSE 'source' END AS outcome FROM tr LEFT JOIN supplier ON s_suppkey = person_id
UNION ALL SELECT video_id, NULL, '', CASE WHEN video_id % 5 = 0 THEN 'no_file' ELSE 'source' END FROM v WHERE video_id % 3 <> 0),
sg0 AS (SELECT video_id, person_id, video_id || '_seg' || printf('%04d', seg) || suffix AS clip_id, t, CASE WHEN video_id % 2 = 0 THEN 20.0 ELSE 30.0 END::DOUBLE AS fps, s, e, 60 + video_id % 200 AS frames FROM r JOIN so USING (video_id) WHERE outcome = 'source'),
sg1 AS (SELECT *, (least(frames, round_even(e * fps, 0)) - greatest(0, round_even(s * fps, 0)))::BIGINT AS n FROM sg0),
sg AS (SELECT *, CASE WHEN n < 30 THEN 'too_short' WHEN video_id % 11 = 0 THEN 'not_global' ELSE 'segment' END AS outcome FROM sg1)"""


@query(f"""WITH {_VT}, bv AS (SELECT video_id, count(*) FILTER (WHERE outcome = 'source') AS s, count(*) FILTER (WHERE outcome = 'no_consent') AS c FROM so WHERE video_id IN (SELECT video_id FROM r) GROUP BY 1)
SELECT (SELECT count(*) FROM bv WHERE s > 0)::BIGINT AS with_motion, (SELECT count(*) FROM bv WHERE s = 0)::BIGINT AS missing_motion, (SELECT coalesce(sum(c), 0) FROM bv)::BIGINT AS consent_skipped,
(SELECT count(*) FROM sg WHERE outcome = 'segment')::BIGINT AS segments, (SELECT count(*) FROM sg WHERE outcome = 'too_short')::BIGINT AS too_short, (SELECT count(*) FROM sg WHERE outcome = 'not_global')::BIGINT AS incam_skipped""")
def captioned_counters(spark, d):
    videos, rows, tracks, registry, files, motions = _video_tables(spark, d)
    sources = publish.motion_sources(videos, tracks, registry, files)
    return publish.build_counters(rows, sources, publish.captioned_segments(rows, sources, motions))


@query(f"WITH {_VT} SELECT video_id, outcome, count(*)::BIGINT AS n FROM so GROUP BY 1, 2")
def motion_sources(spark, d):
    videos, _, tracks, registry, files, _ = _video_tables(spark, d)
    return publish.motion_sources(videos, tracks, registry, files).groupBy("video_id", "outcome").agg(F.count("*").alias("n"))


@query(f"""WITH {_VT}, k AS (SELECT DISTINCT video_id FROM sg WHERE outcome = 'segment'), o AS (SELECT video_id, row_number() OVER (ORDER BY md5('0:' || video_id), video_id) AS i, count(*) OVER () AS m FROM k)
SELECT clip_id, person_id, n AS n_frames, fps, t AS caption, CASE WHEN i <= greatest(1, floor(m * 0.05)) THEN 'val' ELSE 'train' END AS split FROM sg JOIN o USING (video_id) WHERE outcome = 'segment'""")
def captioned_dataset(spark, d):
    """Segments with captions, split by whole videos, written as a dataset and read again."""
    base = work_dir(spark, "captioned")
    videos, rows, tracks, registry, files, motions = _video_tables(spark, d)
    sources = publish.motion_sources(videos, tracks, registry, files)
    entries = publish.captioned_segments(rows, sources, motions).filter("outcome = 'segment'").drop("outcome")
    writers.write_dataset(publish.with_split(entries, "video_id"), None, base)
    return readers.read_index(spark, base).select("clip_id", "person_id", "n_frames", "fps", "caption", "split")


def _unit_frames(spark, d):
    e = table(spark, d, "events")
    return e.select(F.col("user_id").alias("unit_id"), F.col("event_id").alias("frame_idx"), F.when(F.col("user_id") % 2 == 0, 20.0).otherwise(30.0).alias("fps"), "value")


_EN = "en AS (SELECT user_id AS clip_id, count(*)::BIGINT AS n_frames, CASE WHEN user_id % 2 = 0 THEN 20.0 ELSE 30.0 END::DOUBLE AS fps FROM events GROUP BY 1 HAVING count(*) >= 5), sp AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || clip_id), clip_id) AS i, count(*) OVER () AS m FROM en)"


@query(f"""WITH {_EN} SELECT 'index' AS kind, clip_id, n_frames, fps, CASE WHEN c_custkey IS NOT NULL THEN c_nationkey % 4 END::INT AS action_cluster, CASE WHEN i <= greatest(1, floor(m * 0.05)) THEN 'val' ELSE 'train' END AS split FROM sp LEFT JOIN customer ON c_custkey = clip_id
UNION ALL SELECT 'motion', user_id, count(*)::BIGINT, NULL, NULL, NULL FROM events WHERE user_id IN (SELECT clip_id FROM en) GROUP BY 2
UNION ALL SELECT 'stats', count(*)::BIGINT, sum(n_frames)::BIGINT, round_even(sum(n_frames) / arg_max(fps, clip_id), 1)::DOUBLE, NULL, NULL FROM en""")
def published_dataset(spark, d):
    """A dataset's folder with further attributes, its totals and its frames, all read again."""
    base = work_dir(spark, "dataset")
    frames = _unit_frames(spark, d)
    entries = publish.index_entries(frames, "unit_id", 5)
    extra = table(spark, d, "customer").select(F.col("c_custkey").alias("clip_id"), (F.col("c_nationkey") % 4).cast("int").alias("action_cluster"))
    entries = publish.with_split(publish.with_attributes(entries, extra), "clip_id")
    writers.write_dataset(entries, frames.withColumnRenamed("unit_id", "clip_id"), base)
    index = readers.read_index(spark, base).select(F.lit("index").alias("kind"), "clip_id", "n_frames", "fps", "action_cluster", "split")
    none = lambda t: F.lit(None).cast(t)
    motion = spark.read.parquet(f"{base}/motion").groupBy("clip_id").agg(F.count("*").alias("n_frames")).select(F.lit("motion").alias("kind"), "clip_id", "n_frames", none("double").alias("fps"), none("int").alias("action_cluster"), none("string").alias("split"))
    stats = spark.read.json(f"{base}/stats").select(F.lit("stats").alias("kind"), F.col("n_clips").alias("clip_id"), "n_frames", F.col("total_seconds").alias("fps"), none("int").alias("action_cluster"), none("string").alias("split"))
    return index.unionByName(motion).unionByName(stats)


@query(f"""WITH {_EN}, p AS (SELECT *, (clip_id % 7) AS person_id, row_number() OVER (PARTITION BY clip_id % 7 ORDER BY md5('0:' || clip_id), clip_id) AS j, count(*) OVER (PARTITION BY clip_id % 7) AS c FROM en)
SELECT person_id::INT AS person_id, CASE WHEN j <= greatest(1, floor(c * 0.05)) THEN 'val' ELSE 'train' END AS split, count(*)::BIGINT AS clips, sum(n_frames)::BIGINT AS frames FROM p GROUP BY 1, 2""")
def person_datasets(spark, d):
    """A dataset for each person, split by itself."""
    base = work_dir(spark, "people")
    entries = publish.index_entries(_unit_frames(spark, d), "unit_id", 5).withColumn("person_id", (F.col("clip_id") % 7).cast("int"))
    writers.write_person_datasets(publish.with_own_split(entries), base)
    return spark.read.parquet(base).groupBy("person_id", "split").agg(F.count("*").alias("clips"), F.sum("n_frames").alias("frames"))


# --- hand-off ------------------------------------------------------------------------------------


_LN = "ln AS (SELECT doc_id AS clip_id, CASE WHEN doc_id % 10 = 0 THEN 'val' WHEN doc_id % 10 < 9 THEN 'train' END AS split, text, quality FROM documents LEFT JOIN labels USING (doc_id))"


def _entries(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    m = F.col("doc_id") % 10
    return docs.select(F.col("doc_id").alias("clip_id"), F.when(m == 0, "val").when(m < 9, "train").alias("split"), F.col("quality").alias("action_cluster"))


@query(f"WITH {_LN} SELECT split AS list, clip_id::VARCHAR AS clip_id FROM ln WHERE split IS NOT NULL UNION ALL SELECT 'test', clip_id::VARCHAR FROM ln WHERE split = 'val'")
def split_lists(spark, d):
    base = work_dir(spark, "lists")
    writers.write_split_lists(_entries(spark, d), base)
    return spark.read.text(base).select("list", F.col("value").alias("clip_id"))


@query(f"""WITH {_LN} SELECT clip_id, CASE WHEN clip_id % 2 = 0 THEN 'kept' WHEN quality IS NULL THEN 'a person moves#a/DET person/NOUN moves/VERB#0.0#0.0' || chr(10) ELSE 'action ' || quality || '#action/NOUN ' || quality || '/NUM#0.0#0.0' || chr(10) END AS line FROM ln""")
def caption_files(spark, d):
    """Captions of half the clips are there and stay; the others' are added."""
    base = work_dir(spark, "texts")
    entries = _entries(spark, d)
    entries.filter("clip_id % 2 = 0").select("clip_id", F.lit("kept").alias("line")).write.parquet(base)
    there = spark.read.parquet(base)
    writers.append_captions(publish.missing_captions(entries, there, "action"), base)
    return spark.read.parquet(base)


@query(f"WITH {_LN} SELECT clip_id FROM ln WHERE clip_id % 3 = 0 AND split = 'train'")
def listed_files(spark, d):
    entries = _entries(spark, d)
    return publish.listed(entries.filter("clip_id % 3 = 0").select("clip_id"), entries.filter("split = 'train'"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity::BIGINT % 20 <> 0 THEN 'fps ' || l_quantity::BIGINT || ' is not a multiple of 20: clips would train at the wrong speed' END AS warning FROM lineitem")
def stride_warning(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", publish.stride_warning(F.col("l_quantity").cast("long")).alias("warning"))


# --- curves -----------------------------------------------------------------------------------------


_CURVE = "SELECT event_id::BIGINT AS step, round(value, 3)::DOUBLE AS val_loss, CASE WHEN event_id % 3 = 0 THEN round(value / 2, 3) END::DOUBLE AS train_loss FROM events WHERE event_id % 4 = 0"


def _curve(spark, d):
    v = F.round("value", 3)
    return table(spark, d, "events").select(F.format_string("%d.0", "event_id").alias("step"), F.when(F.col("event_id") % 3 == 0, F.round(F.col("value") / 2, 3)).alias("train_loss"), F.when(F.col("event_id") % 4 == 0, v).alias("val_loss"))


@query(f"SELECT 'csv' AS form, * FROM ({_CURVE}) UNION ALL SELECT 'json', * FROM ({_CURVE})")
def curve_read(spark, d):
    """A curve as CSV and as JSON lines, each read by its first character."""
    out = []
    for form in ("csv", "json"):
        base = work_dir(spark, "curve")
        rows = _curve(spark, d)
        rows.coalesce(1).write.option("header", "true").csv(base) if form == "csv" else rows.write.json(base)
        out.append(readers.read_curve(spark, base).select(F.lit(form).alias("form"), "step", "val_loss", "train_loss"))
    return out[0].unionByName(out[1])


@query(_CURVE)
def progress_read(spark, d):
    """A logger's CSV with columns of other names, found by its method."""
    base = work_dir(spark, "run")
    rows = _curve(spark, d).select(F.col("step").alias("samples"), F.col("train_loss").alias("loss_q0"), F.col("val_loss").alias("fid"), F.lit(1).alias("eval_matching_score"))
    rows.coalesce(1).write.option("header", "true").csv(f"{base}/progress.csv")
    return readers.read_metrics(spark, "MDM", base).select("step", "val_loss", "train_loss")


# --- made-up sources -----------------------------------------------------------------------------------


_U = "('0x' || substr(md5({}), 1, 8))::BIGINT / 4294967296.0"


@query(f"""WITH n AS (SELECT n_name AS clip, greatest(35, floor((4 + floor(8 * {_U.format("'n:' || n_name")})) * 20))::INT AS n FROM nation),
f AS (SELECT clip, n, p, c, i, ({_U.format("clip || ':' || p || ':' || c || ':' || i")} - 0.5) * 0.002 AS a FROM (SELECT clip, n, p, c, unnest(range(n)) AS i FROM n, range(2) x(p), range(2) y(c))),
v AS (SELECT *, sum(a) OVER w AS v FROM f WINDOW w AS (PARTITION BY clip, p, c ORDER BY i)), q AS (SELECT *, sum(v) OVER (PARTITION BY clip, p, c ORDER BY i) AS x FROM v)
SELECT clip AS n_name, p::INT AS person, c::INT AS channel, i::INT AS frame_idx, round(x - avg(x) OVER (PARTITION BY clip, p, c), 6)::DOUBLE AS value FROM q""")
def synthetic_motion(spark, d):
    out = synthetic.synthetic_motion(table(spark, d, "nation").select("n_name"), "n_name", people=2, channels=2)
    return out.withColumn("value", F.round("value", 6))


_PICK = "{}[1 + list_reduce(list_prepend(0::BIGINT, list_transform(string_split(sha1({}), ''), lambda h: ('0x' || h)::BIGINT)), lambda s, h: (s * 16 + h) % {})]"


def _picked(words: tuple[str, ...], end: str) -> str:
    return _PICK.format("[" + ", ".join(f"'{w}'" for w in words) + "]", f"k || '{end}'", len(words))


@query(f"""SELECT page_id, t::DOUBLE AS time, {_picked(synthetic.SUBJECTS, 's')} || ' ' || {_picked(synthetic.ACTIONS, 'a')} || ' ' || {_picked(synthetic.DETAILS, 'd')} || '.' AS caption
FROM (SELECT page_id, t, url || printf(':%.3f', t) AS k FROM (SELECT page_id, url, unnest([0.5, 1.5]) AS t FROM pages))""")
def synthetic_captions(spark, d):
    times = table(spark, d, "pages").select("page_id", "url", F.explode(F.array(F.lit(0.5), F.lit(1.5))).alias("time"))
    return times.select("page_id", "time", synthetic.synthetic_caption(F.col("url"), F.col("time")).alias("caption"))
