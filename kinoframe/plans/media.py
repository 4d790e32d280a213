"""Queries over inventories, consent, state and text, with the same rows as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import consent, inventory, search, state
from .registry import registry


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES, SQL, query = registry()


# --- inventory ------------------------------------------------------------------------


@query("SELECT o_orderstatus AS status, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def status_counts(spark, d):
    return inventory.status_counts(table(spark, d, "orders"), "o_orderstatus")


@query("""SELECT l_linestatus AS status, count(*)::BIGINT AS n, sum(l_quantity::BIGINT)::BIGINT AS frames, round(sum(l_quantity::BIGINT) / 20.0 / 3600, 6)::DOUBLE AS hours,
count(*) FILTER (WHERE l_returnflag = 'R')::BIGINT AS low_quality, count(*) FILTER (WHERE l_discount > 0.05)::BIGINT AS mirrored FROM lineitem GROUP BY 1""")
def status_totals(spark, d):
    lines = table(spark, d, "lineitem").withColumn("frames", F.col("l_quantity").cast("long"))
    return inventory.status_totals(lines, "l_linestatus", "frames", 20.0, {"low_quality": F.col("l_returnflag") == "R", "mirrored": F.col("l_discount") > 0.05})


_STEM = r"regexp_replace(regexp_extract(url, '([^/]*)$', 1), '^(.+)\.[^.]*$', '\1')"


@query(f"SELECT page_id, regexp_replace({_STEM}, '[^\\p{{L}}\\p{{N}}_-]', '_', 'g') || '_' || substr(sha1(url), 1, 8) AS clip_id FROM pages")
def stable_ids(spark, d):
    return table(spark, d, "pages").select("page_id", tx.stable_id(F.col("url")).alias("clip_id"))


@query("""SELECT page_id, CASE WHEN len(string_split(url, '/')) <= 1 THEN 'cam' ELSE array_to_string(string_split(url, '/')[1:least(3, len(string_split(url, '/')) - 1)], '/') END AS camera FROM pages""")
def camera_prefix(spark, d):
    return table(spark, d, "pages").select("page_id", tx.camera_of(F.col("url"), 3).alias("camera"))


@query("SELECT count(DISTINCT string_split(url, '/')[3])::BIGINT AS cameras, count(DISTINCT url)::BIGINT AS files FROM pages")
def distinct_cameras(spark, d):
    return table(spark, d, "pages").agg(F.count_distinct(F.get(F.split("url", "/"), F.lit(2))).alias("cameras"), F.count_distinct("url").alias("files"))


@query("""SELECT CASE WHEN regexp_matches(url, '^.*/en/[0-9].*$') OR regexp_matches(url, '^http://blog[.].*$') THEN 'excluded' ELSE 'pending' END AS status,
CASE WHEN regexp_matches(url, '^.*/en/[0-9].*$') OR regexp_matches(url, '^http://blog[.].*$') THEN 'by pattern' END AS note, count(*)::BIGINT AS n FROM pages GROUP BY 1, 2""")
def glob_exclude(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("clip_id"), F.col("url").alias("rel_path"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("note"))
    return inventory.exclude(pages, patterns=["*/en/[0-9]*", "http://blog.*"], note="by pattern").groupBy("status", "note").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN regexp_matches(url, '^.*[.]html$') THEN 'pending' ELSE 'excluded' END AS status, count(*)::BIGINT AS n FROM pages GROUP BY 1""")
def glob_include(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("clip_id"), F.col("url").alias("rel_path"), F.lit("excluded").alias("status"), F.lit("x").alias("note"))
    return inventory.status_counts(inventory.include(pages, patterns=["*.html"]))


@query("""SELECT c_custkey AS clip_id, c_mktsegment AS camera, coalesce(status, 'pending') AS status, n_frames FROM customer LEFT JOIN
(SELECT o_custkey, max(o_orderstatus) AS status, count(*)::BIGINT AS n_frames FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def rescan_merge(spark, d):
    fresh = table(spark, d, "customer").select(F.col("c_custkey").alias("clip_id"), F.col("c_mktsegment").alias("camera"))
    known = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("clip_id")).agg(F.max("o_orderstatus").alias("status"), F.count("*").alias("n_frames"))
    return inventory.rescan(fresh, known)


@query("""SELECT n_name AS camera, list_sort(list_distinct(list(j))) AS joints FROM (SELECT n_name, unnest(CASE n_regionkey WHEN 0 THEN [1,2,4,5,7,8,10,11] WHEN 1 THEN [12,15]
WHEN 2 THEN [22,23] WHEN 3 THEN [13,16,18,20,22] ELSE [10,11] END) AS j FROM nation UNION ALL SELECT n_name, unnest([22,23]) FROM nation) GROUP BY 1""")
def occlusion_lookup(spark, d):
    nations = table(spark, d, "nation")
    regions = F.get(F.array(*map(F.lit, ("legs", "head", "hands", "left_arm", "feet"))), F.col("n_regionkey"))
    hidden = nations.select(F.col("n_name").alias("camera"), F.explode(F.array(regions, F.lit("hands"))).alias("region"))
    return inventory.occluded_joints(hidden)


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'excluded' ELSE 'pending' END AS status, CASE WHEN c_acctbal >= 0 THEN CASE WHEN c_nationkey < 12 THEN 'static' ELSE 'moving' END END AS camera_motion FROM customer""")
def activity_gate(spark, d):
    clips = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.lit("pending").alias("status"))
    return inventory.gate_videos(clips, "c_acctbal", "c_nationkey", 0.0, 12).select("c_custkey", "status", "camera_motion")


@query("""SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN NULL ELSE list_transform(range(0, 24), lambda j: j <> n_nationkey AND j <> n_regionkey) END AS mask FROM nation""")
def joint_mask(spark, d):
    key, region = F.col("n_nationkey").cast("int"), F.col("n_regionkey").cast("int")
    one = lambda c: F.when(region != 0, F.array(c))
    return table(spark, d, "nation").select("n_nationkey", inventory.joint_mask(one(key), one(region)).alias("mask"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 20")
def todo_first(spark, d):
    orders = table(spark, d, "orders").withColumnsRenamed({"o_orderkey": "rel_path", "o_orderstatus": "status"})
    return inventory.todo(orders, ["P"], 20).select(F.col("rel_path").alias("o_orderkey"), "o_totalprice")


# --- joins and consent ------------------------------------------------------------------


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def resume_antijoin(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""SELECT s.conv_id, s.turn AS seg_index, l.text AS description FROM conversations s JOIN conversations l ON s.conv_id = l.conv_id AND s.turn + 1 = l.turn AND l.role = 'assistant'""")
def segment_rows(spark, d):
    turns = table(spark, d, "conversations")
    labels = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("seg_index"), F.col("text").alias("description"))
    return turns.select("conv_id", F.col("turn").alias("seg_index")).join(labels, ["conv_id", "seg_index"])


@query("SELECT o_orderkey AS unit_id, o_custkey AS person_id FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def consent_gate(spark, d):
    units = table(spark, d, "orders").select(F.col("o_orderkey").alias("unit_id"), F.col("o_custkey").alias("person_id"))
    registry = table(spark, d, "customer").select(F.col("c_custkey").alias("person_id"), (F.col("c_acctbal") > 0).alias("granted"))
    return consent.consent_gate(units, registry)


@query("""SELECT allowed, count(*)::BIGINT AS units FROM (SELECT coalesce(c_acctbal > 0, CASE WHEN p IS NULL THEN true ELSE false END) AS allowed FROM
(SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS p FROM orders) LEFT JOIN customer ON c_custkey = p) GROUP BY 1""")
def consent_counts(spark, d):
    units = table(spark, d, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("person_id"))
    registry = table(spark, d, "customer").select(F.col("c_custkey").alias("person_id"), (F.col("c_acctbal") > 0).alias("granted"))
    return consent.consent_flag(units, registry, "include").groupBy("allowed").agg(F.count("*").alias("units"))


@query("""WITH t AS (SELECT l_orderkey, list({'t': l_linenumber, 'p': l_suppkey} ORDER BY l_linenumber) FILTER (WHERE l_returnflag = 'R') AS tracks FROM lineitem GROUP BY 1)
SELECT l_orderkey::VARCHAR || '__' || x.t AS unit_id, l_orderkey::VARCHAR AS clip_id, x.p AS person_id FROM (SELECT l_orderkey, unnest(tracks) AS x FROM t WHERE tracks IS NOT NULL)
UNION ALL SELECT l_orderkey::VARCHAR, l_orderkey::VARCHAR, NULL FROM t WHERE tracks IS NULL""")
def motion_units(spark, d):
    track = F.when(F.col("l_returnflag") == "R", F.struct(F.col("l_linenumber").cast("string").alias("track_id"), F.col("l_suppkey").alias("person_id")))
    clips = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("clip_id")).agg(F.collect_list(track).alias("tracks"))
    return consent.motion_units(clips).select("unit_id", "clip_id", "person_id")


@query("SELECT coalesce(source, '(unassigned)') AS person, count(*)::BIGINT AS units FROM documents GROUP BY 1")
def people_counts(spark, d):
    return consent.people_counts(table(spark, d, "documents"), "source")


# --- state ------------------------------------------------------------------------------


@query("""SELECT c_custkey AS clip_id, 'done' AS status FROM customer WHERE c_acctbal > 0 UNION ALL
SELECT DISTINCT o_custkey, 'pending' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def insert_if_absent(spark, d):
    store = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("clip_id"), F.lit("done").alias("status"))
    return state.insert_new(store, table(spark, d, "orders").select(F.col("o_custkey").alias("clip_id"), F.lit("pending").alias("status")))


@query("""SELECT CASE WHEN event_type = 'signup' AND epoch(ts) < 1704585600 - 3600 THEN 'pending' WHEN event_type = 'signup' THEN 'in_progress' ELSE 'done' END AS status,
count(*)::BIGINT AS n, count(CASE WHEN NOT (event_type = 'signup' AND epoch(ts) < 1704585600 - 3600) THEN 1 END)::BIGINT AS held FROM events GROUP BY 1""")
def release_stale(spark, d):
    store = table(spark, d, "events").select(
        F.when(F.col("event_type") == "signup", "in_progress").otherwise("done").alias("status"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("updated"), F.col("user_id").cast("string").alias("worker"),
    )
    out = state.release_stale(store, 1704585600.0, 3600.0)
    return out.groupBy("status").agg(F.count("*").alias("n"), F.count("worker").alias("held"))


@query("SELECT min(o_orderkey) AS clip_id FROM orders WHERE o_orderstatus = 'O'")
def next_pending(spark, d):
    store = table(spark, d, "orders").select(F.col("o_orderkey").alias("clip_id"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise("done").alias("status"))
    return state.next_pending(store)


@query("""WITH u AS (SELECT user_id, arg_max(event_type, event_id) AS status, arg_max(event_id, event_id) AS updated, arg_max(props, event_id) AS props FROM events GROUP BY 1)
SELECT c_custkey AS clip_id, coalesce(u.status, 'pending') AS status, CASE WHEN u.status IS NULL THEN '{"a":1,"k":0}' ELSE '{"a":1,"k":' || json_extract_string(props, '$.k') || '}' END AS data
FROM customer LEFT JOIN u ON user_id = c_custkey""")
def state_updates(spark, d):
    store = table(spark, d, "customer").select(F.col("c_custkey").alias("clip_id"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("worker"), F.lit(-1).cast("long").alias("updated"), F.lit('{"a":1,"k":0}').alias("data"))
    updates = table(spark, d, "events").select(F.col("user_id").alias("clip_id"), F.col("event_type").alias("status"), F.lit("w").alias("worker"), F.col("event_id").alias("updated"), F.col("props").alias("data"))
    return state.apply_updates(store, updates).select("clip_id", "status", "data")


@query("""SELECT o_orderkey, CASE WHEN contains(lower(o_orderpriority), 'urgent') THEN 'failed' WHEN contains(lower(o_orderpriority), 'high') THEN 'done' ELSE 'pending' END AS status FROM orders""")
def import_status(spark, d):
    word = F.when(F.col("o_orderpriority").contains("URGENT"), "FAIL_now").when(F.col("o_orderpriority").contains("HIGH"), "pose_DONE").otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", tx.import_status(word).alias("status"))


# --- text -------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN t = '' THEN 'a person moves#a/DET person/NOUN moves/VERB#0.0#0.0' || chr(10)
ELSE t || '#' || array_to_string(list_transform(string_split(t, ' '), lambda w: lower(w) || '/OTHER'), ' ') || '#0.0#0.0' || chr(10) END AS line
FROM (SELECT doc_id, trim(regexp_replace(replace(text, '#', ' '), '\\s+', ' ', 'g')) AS t FROM documents)""".replace("\\\\", "\\"))
def caption_line(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.caption_line(F.col("text")).alias("line"))


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN 'a person moves#a/DET person/NOUN moves/VERB#0.0#0.0' || chr(10) ELSE 'action ' || quality || '#action/NOUN ' || quality || '/NUM#0.0#0.0' || chr(10) END AS line
FROM documents LEFT JOIN labels USING (doc_id)""")
def action_caption(spark, d):
    clips = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return clips.select("doc_id", tx.clip_caption("action", F.col("quality"), F.col("text"), F.col("source")).alias("line"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_extract(spark, d):
    found = tx.first_json_object(F.concat(F.lit("Sure: "), F.col("props"), F.lit("\nDone.")))
    return table(spark, d, "events").select("event_id", F.get_json_object(found, "$.k").cast("long").alias("k"))


@query("""SELECT event_id, '{"a":1,"k":' || json_extract_string(props, '$.k') || ',"n":{"x":[1,"2",null]}}' AS data FROM events""")
def json_merge(spark, d):
    return table(spark, d, "events").select("event_id", state.merge_json(F.lit('{"n":{"x":[1,"2",null]},"a":1,"k":"0"}'), F.col("props")).alias("data"))


_TAGS = """SELECT doc_id, tag, count(*) AS n, min(pos) AS f FROM (SELECT doc_id, unnest(w) AS tag, unnest(range(len(w))) AS pos FROM
(SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents)) WHERE length(tag) > 2 AND tag NOT IN ('a','an','the','in','on','by','at','near','of','and','to','is','are') GROUP BY 1, 2"""


@query(f"SELECT doc_id, rank::INT AS rank, tag, n::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank FROM ({_TAGS})) WHERE rank <= 5")
def keyword_tags(spark, d):
    return search.keyword_tags(table(spark, d, "documents"), "doc_id", "text", 5)


@query("SELECT doc_id FROM documents WHERE text ILIKE '%LICENSED under%' OR source ILIKE '%licensed under%'")
def search_like(spark, d):
    return table(spark, d, "documents").filter(tx.contains_query("licensed under", F.col("text"), F.col("source"))).select("doc_id")


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents), c AS (SELECT doc_id, len(t) AS l, len(list_filter(t, lambda x: x = 'license')) AS a, len(list_filter(t, lambda x: starts_with(x, 'licens'))) AS b FROM w),
s AS (SELECT count(*) AS n, avg(l) AS m, count(*) FILTER (WHERE a > 0) AS da, count(*) FILTER (WHERE b > 0) AS db FROM c)
SELECT doc_id, round(ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * l / m)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * l / m)), 6)::DOUBLE AS score
FROM c, s WHERE a > 0 AND b > 0 ORDER BY ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * l / m)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * l / m)) DESC, doc_id LIMIT 20""")
def search_bm25(spark, d):
    return search.bm25(table(spark, d, "documents"), "doc_id", "text", "license licens*").withColumn("score", F.round("score", 6))


@query("""SELECT doc_id, n FROM (SELECT doc_id, len(list_filter(range(1, len(t)), lambda i: t[i] = 'rights' AND t[i + 1] = 'reserved'))::INT AS n FROM
(SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents)) WHERE n > 0""")
def phrase_search(spark, d):
    return search.phrase_search(search.postings(table(spark, d, "documents"), "doc_id", "text"), "doc_id", "rights reserved")


@query("SELECT conv_id, count(*)::BIGINT AS n, arg_min(text, turn) AS first_text FROM conversations GROUP BY 1")
def segment_label(spark, d):
    return search.segment_label(table(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query("SELECT conv_id, string_agg('- t=' || turn || '.0s: ' || text, chr(10) ORDER BY turn, text) AS prompt FROM conversations GROUP BY 1")
def caption_prompt(spark, d):
    turns = table(spark, d, "conversations").withColumn("time", F.col("turn").cast("double"))
    return search.caption_prompt(turns, ["conv_id"], "time", "text")


@query("SELECT page_id, regexp_extract(url, '[0-9]+')::BIGINT AS number FROM pages WHERE regexp_matches(url, '[0-9]')")
def first_integer(spark, d):
    return table(spark, d, "pages").select("page_id", tx.first_integer(F.col("url")).alias("number")).filter("number IS NOT NULL")


@query("""SELECT user_id, count(*)::BIGINT AS units, (row_number() OVER (ORDER BY count(*) DESC, user_id))::INT AS place FROM events GROUP BY 1 ORDER BY units DESC, user_id LIMIT 10""")
def busiest_units(spark, d):
    top = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("units")).orderBy(F.desc("units"), "user_id").limit(10)
    return top.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("units"), "user_id")))
