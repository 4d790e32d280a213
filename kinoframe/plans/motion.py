"""Queries over time series, intervals, vectors, rotations and datasets, with the same rows as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rotations as rot
from ..functions.text import clip_caption
from ..operators import dataset, intervals, motion, series, skeleton, vectors
from .media import table
from .registry import registry

QUERIES, SQL, query = registry()
ORDER = ["ts", "event_id"]


def _events(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _frames(spark, d) -> DataFrame:
    """Events as frames: user_id, frame_idx from 0, value, event_type."""
    w = Window.partitionBy("user_id").orderBy(*ORDER)
    return _events(spark, d).withColumn("frame_idx", F.row_number().over(w) - 1)


_E = "e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)"
_W = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"


# --- series ---------------------------------------------------------------------------


@query(f"WITH {_E}, s AS (SELECT *, abs(value - lag(value) {_W}) * 30 AS v FROM e) SELECT event_id, round(coalesce(v, lead(v) {_W}), 6)::DOUBLE AS speed FROM s")
def first_diff_speed(spark, d):
    return series.speed(_events(spark, d), "user_id", ORDER, ["value"], 30.0).select("event_id", F.round("speed", 6).alias("speed"))


@query(f"WITH s AS (SELECT *, lag(value) {_W} - 2 * value + lead(value) {_W} AS m FROM events) SELECT event_id, round(coalesce(m, lead(m) {_W}, lag(m) {_W}), 6)::DOUBLE AS accel FROM s")
def second_diff(spark, d):
    return series.second_difference(_events(spark, d), "user_id", ORDER, "value").select("event_id", F.round("accel", 6).alias("accel"))


@query(f"SELECT user_id, round(coalesce(var_pop(m), 0), 4)::DOUBLE AS jitter FROM (SELECT user_id, lag(value) {_W} - 2 * value + lead(value) {_W} AS m FROM events) GROUP BY 1")
def jitter(spark, d):
    return series.jitter(_events(spark, d), "user_id", ORDER, ["value"]).withColumn("jitter", F.round("jitter", 4))


_KERNEL = "(VALUES (-4, -21), (-3, 14), (-2, 39), (-1, 54), (0, 59), (1, 54), (2, 39), (3, 14), (4, -21)) k(o, c)"
_FIT = f"""{_E}, r AS (SELECT user_id, i, n, c, CASE WHEN abs(i + o) > n - 1 THEN 2 * (n - 1) - abs(i + o) ELSE abs(i + o) END AS j FROM e, {_KERNEL} WHERE n > 9),
f AS (SELECT r.user_id, r.i, sum(c * x.value) / 231.0 AS fit FROM r JOIN e x ON x.user_id = r.user_id AND x.i = r.j GROUP BY 1, 2)"""


@query(f"WITH {_FIT} SELECT event_id, round(coalesce(fit, value), 6)::DOUBLE AS smooth FROM e LEFT JOIN f USING (user_id, i)")
def savgol_smooth(spark, d):
    return series.savgol(_events(spark, d), "user_id", ORDER, "value").select("event_id", F.round("smooth", 6).alias("smooth"))


@query(f"""WITH {_FIT}, s AS (SELECT *, lag(value) {_W} - 2 * value + lead(value) {_W} AS m FROM e), a AS (SELECT *, abs(coalesce(m, lead(m) {_W}, lag(m) {_W}, 0)) AS acc FROM s)
SELECT event_id, round((1 - acc / (acc + 0.02)) * value + acc / (acc + 0.02) * coalesce(fit, value), 6)::DOUBLE AS smooth FROM a LEFT JOIN f USING (user_id, i)""")
def confidence_smooth(spark, d):
    return series.confidence_smooth(_events(spark, d), "user_id", ORDER, "value").select("event_id", F.round("smooth", 6).alias("smooth"))


@query(f"""WITH RECURSIVE {_E}, y AS (SELECT user_id, i, event_id, value::DOUBLE AS y FROM e WHERE i = 0 UNION ALL
SELECT e.user_id, e.i, e.event_id, 0.4::DOUBLE * e.value + 0.6::DOUBLE * y.y FROM y JOIN e ON e.user_id = y.user_id AND e.i = y.i + 1) SELECT event_id, round(y, 6)::DOUBLE AS ema FROM y""")
def ema_smooth(spark, d):
    return series.ema(_events(spark, d), "user_id", ORDER, "value").select("event_id", F.round("ema", 6).alias("ema"))


@query(f"""WITH RECURSIVE {_E}, y AS (SELECT user_id, i, event_id, value::DOUBLE AS y FROM e WHERE i = 0 UNION ALL
SELECT e.user_id, e.i, e.event_id, 0.01::DOUBLE * e.value + 0.99::DOUBLE * y.y FROM y JOIN e ON e.user_id = y.user_id AND e.i = y.i + 1) SELECT event_id, round(y, 6)::DOUBLE AS ema FROM y""")
def ema_slow(spark, d):
    return series.ema(_events(spark, d), "user_id", ORDER, "value", 0.01).select("event_id", F.round("ema", 6).alias("ema"))


@query("""SELECT event_id, coalesce(last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), value) AS filled FROM events""")
def locf_fill(spark, d):
    return series.carry_forward(_events(spark, d), "user_id", ORDER, "value", F.col("event_type") != "error").select("event_id", "filled")


_RUNS = f"""{_E}, m AS (SELECT *, value < 20 AS k FROM e), g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, k ORDER BY i) AS g FROM m),
u AS (SELECT user_id, min(i) AS a, max(i) + 1 AS b FROM g WHERE k GROUP BY user_id, g HAVING count(*) >= 3)"""


@query(f"WITH {_RUNS} SELECT user_id, a::BIGINT AS run_start, b::BIGINT AS run_end FROM u")
def stationary_runs(spark, d):
    return series.runs(_events(spark, d), "user_id", ORDER, F.col("value") < 20, 3)


@query(f"""WITH {_E}, s AS (SELECT *, abs(value - lag(value) {_W}) AS v FROM e), m AS (SELECT *, coalesce(v, lead(v) {_W}) < 15 AS k FROM s), g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, k ORDER BY i) AS g FROM m),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, k, g) AS len, median(value) OVER (PARTITION BY user_id, k, g) AS med FROM g)
SELECT event_id, round(CASE WHEN k AND len >= 2 THEN 0.3 * value + 0.7 * med ELSE value END, 6)::DOUBLE AS value_held FROM c""")
def anti_drift(spark, d):
    return series.anti_drift(_events(spark, d), "user_id", ORDER, ["value"], 1.0, speed_limit=15).select("event_id", F.round("value_held", 6).alias("value_held"))


@query(f"""WITH {_E}, u AS (SELECT user_id, max(n) AS n, greatest(2, round_even((max(n) - 1) / 30.0 * 20, 0) + 1)::BIGINT AS m FROM e GROUP BY 1),
t AS (SELECT user_id, n, m, unnest(range(m)) AS f FROM u), p AS (SELECT *, CASE WHEN n < 2 THEN 0.0 ELSE f * (n - 1) / (m - 1)::DOUBLE END AS pos FROM t), q AS (SELECT *, greatest(0, least(floor(pos), n - 2))::BIGINT AS i FROM p)
SELECT user_id, f::BIGINT AS frame_idx, round(a.value + (pos - q.i) * (coalesce(b.value, a.value) - a.value), 6)::DOUBLE AS value FROM q JOIN e a ON a.user_id = q.user_id AND a.i = q.i LEFT JOIN e b ON b.user_id = q.user_id AND b.i = q.i + 1""".replace("SELECT user_id, f", "SELECT q.user_id, f"))
def resample_linear(spark, d):
    return series.resample(_events(spark, d), "user_id", ORDER, ["value"], 30.0, 20.0).withColumn("value", F.round("value", 6))


@query("SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4)::DOUBLE AS path FROM events")
def cumulative_path(spark, d):
    return series.integrate(_events(spark, d), "user_id", ORDER, "value").select("event_id", F.round("path", 4).alias("path"))


@query()
def variational_smooth(spark, d):
    return series.variational_smooth(_events(spark, d).drop("ts").withColumn("ts", F.col("event_id")), "user_id", ["event_id"], "value", window=32).select("event_id", F.round("smooth", 6).alias("smooth"))


# --- verdicts ---------------------------------------------------------------------------


_STEPS = f"s AS (SELECT user_id, abs(value - lag(value) {_W}) AS d FROM events), q AS (SELECT user_id, max(d) * 1.0 AS v, max(d) AS m, avg(d) AS a FROM s GROUP BY 1)"
_ISSUES = "list_filter([CASE WHEN v > 200 THEN 'root_teleport' END, CASE WHEN m > 150 THEN 'pose_jump' END, CASE WHEN a < 28 THEN 'static_low_motion' END], lambda x: x IS NOT NULL)"


def _verdicts(spark, d):
    return motion.quality_verdict(_events(spark, d), "user_id", ORDER, "value", "value", 1.0, 200.0, 150.0, 28.0)


@query(f"WITH {_STEPS} SELECT user_id, {_ISSUES} AS issues FROM q")
def quality_verdict(spark, d):
    return _verdicts(spark, d)


@query(f"""WITH {_STEPS}, v AS (SELECT user_id % 25 AS clip, {_ISSUES} AS issues FROM q), u AS (SELECT clip, unnest(issues) AS x FROM v)
SELECT c.clip, coalesce((SELECT list(DISTINCT x ORDER BY x) FROM u WHERE u.clip = c.clip), []) AS issues, EXISTS (SELECT 1 FROM u WHERE u.clip = c.clip AND x IN ('root_teleport', 'pose_jump')) AS low_quality FROM (SELECT DISTINCT clip FROM v) c""")
def quality_union(spark, d):
    return motion.quality_union(_verdicts(spark, d).withColumn("clip", F.col("user_id") % 25), "clip")


_EN = """en AS (SELECT user_id, event_type, count(*) AS n, coalesce(sum(dd * dd), 0) AS energy FROM
(SELECT user_id, event_type, value - lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS dd FROM events) GROUP BY 1, 2)"""
_SC = f"{_EN}, sc AS (SELECT user_id, coalesce(sum(energy) FILTER (WHERE event_type IN ('click', 'purchase')), 0) AS r, coalesce(sum(energy) FILTER (WHERE event_type IN ('view', 'error')), 0) AS l FROM en GROUP BY 1), sco AS (SELECT user_id, CASE WHEN r + l = 0 THEN 0 ELSE (r - l) / (r + l) END AS score FROM sc)"


def _energies(spark, d):
    return motion.energy(_events(spark, d), "user_id", ORDER, "event_type", "value")


def _scores(spark, d):
    return motion.handedness(_energies(spark, d), "user_id", "event_type", ["view", "error"], ["click", "purchase"])


@query(f"WITH {_SC} SELECT user_id, round(score, 6)::DOUBLE AS score FROM sco")
def handedness(spark, d):
    return _scores(spark, d).withColumn("score", F.round("score", 6))


@query(f"""WITH {_SC}, g AS (SELECT *, median(score) OVER (PARTITION BY user_id % 7) AS med, count(*) OVER (PARTITION BY user_id % 7) AS n FROM sco)
SELECT user_id, CASE WHEN n < 3 THEN false ELSE sign(score) = CASE WHEN med >= 0 THEN -1 ELSE 1 END AND abs(score) >= 0.15 END AS mirrored FROM g""")
def mirror_flags(spark, d):
    return motion.mirror_flags(_scores(spark, d).withColumn("grp", F.col("user_id") % 7), ["grp"]).select("user_id", "mirrored")


@query(f"""WITH {_EN} SELECT user_id, CASE WHEN count(*) FILTER (WHERE energy >= 3000) >= 2 AND max(n) >= 3 THEN coalesce(list(event_type ORDER BY event_type) FILTER (WHERE energy < 3000), []) ELSE [] END AS channels FROM en GROUP BY 1""")
def frozen_channels(spark, d):
    return motion.frozen_channels(_energies(spark, d), "user_id", "event_type", 3000.0, 2)


@query("""SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS r FROM (SELECT user_id, event_type, count(*)::BIGINT AS n, min(row(ts, event_id)) AS f FROM events GROUP BY 1, 2)) WHERE r = 1""")
def dominant_track(spark, d):
    return motion.dominant_track(_events(spark, d), "user_id", "event_type", ORDER)


@query("""SELECT o_custkey, o_orderkey, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderkey) AS r FROM (SELECT o_custkey, o_orderkey, count(*)::BIGINT AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)) WHERE r = 1""")
def longest_track(spark, d):
    tracks = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n")).join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return motion.longest_track(tracks, "o_custkey", "o_orderkey", "n")


@query("""SELECT l_orderkey, l_linenumber, area FROM (SELECT l_orderkey, l_linenumber, (l_quantity - l_discount) * (l_quantity - l_tax) AS area, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_quantity - l_discount) * (l_quantity - l_tax) DESC, l_linenumber) AS r FROM lineitem) WHERE r = 1""")
def largest_box(spark, d):
    return motion.largest_box(table(spark, d, "lineitem"), ["l_orderkey"], ("l_discount", "l_tax", "l_quantity", "l_quantity"), "l_linenumber")


@query(f"""SELECT user_id, event_type, round(coalesce(avg(v), 0), 6)::DOUBLE AS mean_speed, round(coalesce(stddev_pop(v), 0), 6)::DOUBLE AS std_speed FROM
(SELECT user_id, event_type, abs(value - lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)) * 20 AS v FROM events) GROUP BY 1, 2""")
def clip_features(spark, d):
    out = motion.clip_features(_events(spark, d), "user_id", ORDER, "event_type", "value", 20.0)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_speed", "std_speed")})


@query("""SELECT l_orderkey, min(l_suppkey) FILTER (WHERE l_linestatus <> 'F') AS "left", min(l_suppkey) FILTER (WHERE l_linestatus = 'F') AS "right", count(*) FILTER (WHERE l_linestatus <> 'F') > 0 AS left_valid, count(*) FILTER (WHERE l_linestatus = 'F') > 0 AS right_valid FROM lineitem GROUP BY 1""")
def hands_by_side(spark, d):
    return motion.hands_by_side(table(spark, d, "lineitem").withColumn("is_right", F.col("l_linestatus") == "F"), ["l_orderkey"], "is_right", "l_suppkey")


# --- intervals --------------------------------------------------------------------------


def _spans(spark, d) -> DataFrame:
    """Each event as a scene of its user from its second for ``value`` seconds."""
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double") - 1704067200
    return _events(spark, d).select("user_id", "event_id", start.alias("start"), (start + F.ceil(F.col("value") * 4) / 4).alias("end"))


_SP = "sp AS (SELECT user_id, event_id, floor(epoch(ts))::DOUBLE - 1704067200 AS a, floor(epoch(ts))::DOUBLE - 1704067200 + ceil(value * 4) / 4 AS b FROM events)"


@query(f"""WITH RECURSIVE {_SP}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a, b) AS i FROM sp), w AS (SELECT user_id, event_id, i, a AS s, 0::BIGINT AS k FROM o WHERE i = 1 UNION ALL
SELECT o.user_id, o.event_id, o.i, CASE WHEN o.b - w.s <= 86400 THEN w.s ELSE o.a END, CASE WHEN o.b - w.s <= 86400 THEN w.k ELSE w.k + 1 END FROM w JOIN o ON o.user_id = w.user_id AND o.i = w.i + 1) SELECT event_id, k AS "window" FROM w""")
def greedy_windows(spark, d):
    return intervals.greedy_windows(_spans(spark, d), "user_id", 86400.0).select("event_id", "window")


_MERGE = f"""{_SP}, o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a, b) AS i FROM sp), k AS (SELECT *, sum(CASE WHEN b - a >= 20 OR i = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) AS k FROM o),
s AS (SELECT user_id, k, min(a) AS a, arg_max(b, i) AS b FROM k GROUP BY 1, 2), n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, lag(a) OVER w AS pa, lag(b) OVER w AS pb FROM s WINDOW w AS (PARTITION BY user_id ORDER BY k)),
mg AS (SELECT user_id, CASE WHEN k = 2 AND pb - pa < 20 THEN pa ELSE a END AS a, b FROM n WHERE NOT (k = 1 AND b - a < 20 AND n > 1))"""


@query(f'WITH {_MERGE} SELECT user_id, a AS start, round(b, 6)::DOUBLE AS "end" FROM mg')
def merge_short(spark, d):
    return intervals.merge_short(_spans(spark, d), "user_id", 20.0).withColumn("end", F.round("end", 6))


_SPLIT = "SELECT user_id, event_id, greatest(1, ceil((b - a) / 30))::INT AS n, a, b FROM sp"


@query(f"""WITH {_SP}, p AS ({_SPLIT}) SELECT event_id, round(a + i * ((b - a) / n), 6)::DOUBLE AS start, round(CASE WHEN i < n - 1 THEN a + (i + 1) * ((b - a) / n) ELSE b END, 6)::DOUBLE AS "end" FROM (SELECT *, unnest(range(n)) AS i FROM p)""")
def even_split(spark, d):
    out = intervals.even_split(_spans(spark, d), 30.0)
    return out.select("event_id", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query(f"""WITH {_MERGE}, q AS (SELECT user_id, a, b, greatest(1, ceil((b - a) / 43200))::INT AS n FROM mg), r AS (SELECT user_id, a + i * ((b - a) / n) AS s, CASE WHEN i < n - 1 THEN a + (i + 1) * ((b - a) / n) ELSE b END AS e FROM (SELECT *, unnest(range(n)) AS i FROM q)
UNION ALL SELECT c_custkey, 0.0, 10.0 FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events))
SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY s, e) - 1)::INT AS seg_index, round_even(s, 3)::DOUBLE AS start, round_even(e, 3)::DOUBLE AS "end" FROM r""")
def plan_segments(spark, d):
    users = table(spark, d, "events").select("user_id").unionByName(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))).distinct().withColumn("duration", F.lit(10.0))
    return intervals.plan_segments(_spans(spark, d), users, "user_id", 43200.0, 20.0)


@query("""SELECT event_id, round_even((i + 0.5) * (value / n), 3)::DOUBLE AS t FROM (SELECT event_id, value, n, unnest(range(n)) AS i FROM (SELECT event_id, value, least(16, greatest(1, floor(value)))::INT AS n FROM (SELECT event_id, ceil(value * 4) / 4 AS value FROM events) WHERE value > 0)) UNION ALL SELECT event_id, 0.0 FROM events WHERE value <= 0""")
def frame_midpoints(spark, d):
    return _events(spark, d).select("event_id", F.explode(intervals.frame_times(F.lit(0.0), F.ceil(F.col("value") * 4) / 4, 1.0, 16)).alias("t"))


@query(f"""WITH {_E}, s AS (SELECT user_id, event_id, i / 20.0 AS a, i / 20.0 + 1.5 AS b, n FROM e WHERE event_type = 'purchase'), c AS (SELECT *, greatest(0, round_even(a * 20, 0)) AS i0, least(n, round_even(b * 20, 0)) AS i1 FROM s)
SELECT c.event_id AS span_id, count(*)::BIGINT AS frames, round(sum(e.value), 4)::DOUBLE AS total FROM c JOIN e ON e.user_id = c.user_id AND e.i >= i0 AND e.i < i1 WHERE i1 - i0 >= 2 GROUP BY 1""")
def interval_slice(spark, d):
    frames = _frames(spark, d)
    at = F.col("frame_idx") / 20.0
    spans = frames.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("span_id"), at.alias("start"), (at + 1.5).alias("end"))
    cut = intervals.slice_frames(frames.select("user_id", "frame_idx", "value"), spans, "user_id", bin_frames=32)
    return cut.groupBy("span_id").agg(F.count("*").alias("frames"), F.round(F.sum("value"), 4).alias("total"))


@query()
def finetune_payload(spark, d):
    rows = _spans(spark, d).join(_events(spark, d).select("event_id", F.col("event_type").alias("description"), F.array("event_type").alias("tags")), "event_id")
    packed = intervals.windows(rows, "user_id", 86400.0, ["description", "tags"])
    return intervals.finetune_payload(packed, "user_id", "Describe what happens in this part.")


# --- vectors ----------------------------------------------------------------------------


_CENTERS = [[(((i * 7 + k * 13) % 11) - 5) / 5.0 for k in range(64)] for i in range(10)]


@query("""WITH c AS (SELECT i, list_transform(range(64), lambda k: (((i * 7 + k * 13) % 11) - 5) / 5.0) AS c FROM range(10) r(i)),
s AS (SELECT vec_id, i, list_sum(list_transform(range(1, 65), lambda k: (embedding[k]::DOUBLE - c[k]) * (embedding[k]::DOUBLE - c[k]))) AS d2 FROM embeddings, c)
SELECT vec_id, arg_min(i, row(d2, i))::INT AS center, round(min(d2), 6)::DOUBLE AS distance FROM s GROUP BY 1""")
def nearest_center(spark, d):
    return vectors.nearest_center(table(spark, d, "embeddings"), "vec_id", "embedding", _CENTERS).withColumn("distance", F.round("distance", 6))


@query("""SELECT vec_id, neighbor, round(dist, 5)::DOUBLE AS distance FROM (SELECT a.vec_id, b.vec_id AS neighbor, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist,
row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), b.vec_id) AS r FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id) WHERE r = 1""")
def nearest_neighbor(spark, d):
    return vectors.nearest_neighbors(table(spark, d, "embeddings"), "vec_id", "embedding", "label").withColumn("distance", F.round("distance", 5))


@query("""SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / CASE WHEN stddev_pop(c_acctbal) OVER () < 1e-8 THEN 1 ELSE stddev_pop(c_acctbal) OVER () END, 6)::DOUBLE AS c_acctbal_z FROM customer""")
def zscore(spark, d):
    return vectors.zscore(table(spark, d, "customer"), ["c_acctbal"]).select("c_custkey", F.round("c_acctbal_z", 6).alias("c_acctbal_z"))


@query()
def kmeans_labels(spark, d):
    e = table(spark, d, "embeddings")
    return vectors.nearest_center(e, "vec_id", "embedding", vectors.kmeans(e, "vec_id", "embedding", 10)).select("vec_id", "center")


@query()
def minibatch_labels(spark, d):
    e = table(spark, d, "embeddings")
    return vectors.nearest_center(e, "vec_id", "embedding", vectors.minibatch_kmeans(e, "vec_id", "embedding", 10)).select("vec_id", "center")


@query()
def mst_people(spark, d):
    """Nations, a point each: mean balances of their customers and suppliers."""
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(F.avg("c_acctbal").alias("c"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("long").alias("nation")).agg(F.avg("s_acctbal").alias("s"))
    points = c.join(s, "nation").select("nation", F.array("c", "s").alias("v"))
    return vectors.spanning_tree_labels(points, "nation", "v")


def _vertices(spark, d) -> DataFrame:
    """Each part's brand is a mesh, each part a vertex."""
    return table(spark, d, "part").select(F.col("p_brand").alias("asset"), F.col("p_partkey").alias("vid"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"), (F.col("p_partkey") % 97).cast("double").alias("z"))


@query("""WITH m AS (SELECT p_brand AS asset, list_reverse_sort([(max(p_size) - min(p_size))::DOUBLE, max(p_retailprice) - min(p_retailprice), (max(p_partkey % 97) - min(p_partkey % 97))::DOUBLE]) AS e FROM part GROUP BY 1)
SELECT asset, round(e[1], 6)::DOUBLE AS up, round(e[2], 6)::DOUBLE AS width, round(e[3], 6)::DOUBLE AS depth, round(greatest(0, least(1, 1 - abs(e[1] / greatest(e[2], 1e-9) - 3.5) / 3.5)), 6)::DOUBLE AS proportion FROM m""")
def box_scores(spark, d):
    return vectors.box_scores(_vertices(spark, d), "asset").select("asset", *(F.round(c, 6).alias(c) for c in ("up", "width", "depth", "proportion")))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, max(l_discount) AS d FROM lineitem GROUP BY 1, 2), t AS (SELECT l_orderkey, l_linenumber, d * 10 AS s, coalesce(max(d * 10) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS was FROM x)
SELECT l_orderkey, l_linenumber, round(s, 6)::DOUBLE AS score FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY s DESC, l_linenumber) AS r FROM t WHERE was < 0.8) WHERE r = 1""")
def best_of_n(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg((F.max("l_discount") * 10).alias("score"))  # numbers repeat within an order
    return dataset.best_of(lines, "l_orderkey", "l_linenumber", "score", 0.8).withColumn("score", F.round("score", 6))


# --- rotations --------------------------------------------------------------------------


def _pose(spark, d) -> DataFrame:
    e = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", F.concat(e, F.slice(e, 1, 8)).alias("pose"))


_SWAP = "[0,2,1,3,5,4,6,8,7,9,11,10,12,14,13,15,17,16,19,18,21,20,23,22]"


@query(f"""SELECT vec_id, list_transform(range(72), lambda k: pose[3 * {_SWAP}[k // 3 + 1] + k % 3 + 1] * CASE WHEN k % 3 = 0 THEN 1 ELSE -1 END) AS pose FROM (SELECT vec_id, list_concat(embedding::DOUBLE[], embedding[1:8]::DOUBLE[]) AS pose FROM embeddings)""")
def mirror_array(spark, d):
    return _pose(spark, d).select("vec_id", rot.mirror_pose(F.col("pose")).alias("pose"))


@query("""SELECT vec_id, list_transform(list_concat(embedding[1:64], embedding[1:2], embedding[2:46], list_transform(range(45), lambda x: 0.0::FLOAT)), lambda v: v::DOUBLE) AS pose FROM embeddings""")
def export_pose(spark, d):
    p = _pose(spark, d)
    return p.select("vec_id", rot.export_pose(F.col("pose"), F.slice("pose", 2, 45), F.lit(None).cast("array<double>")).alias("pose"))


_SIX = """v AS (SELECT vec_id, embedding[1:6]::DOUBLE[] AS v FROM embeddings), a AS (SELECT vec_id, v, list_transform(v[1:3], lambda c: c / sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3])) AS x FROM v),
b AS (SELECT vec_id, x, v[4] - (x[1] * v[4] + x[2] * v[5] + x[3] * v[6]) * x[1] AS p, v[5] - (x[1] * v[4] + x[2] * v[5] + x[3] * v[6]) * x[2] AS q, v[6] - (x[1] * v[4] + x[2] * v[5] + x[3] * v[6]) * x[3] AS r FROM a),
c AS (SELECT vec_id, x, [p / sqrt(p * p + q * q + r * r), q / sqrt(p * p + q * q + r * r), r / sqrt(p * p + q * q + r * r)] AS y FROM b),
m AS (SELECT vec_id, x, y, [x[2] * y[3] - x[3] * y[2], x[3] * y[1] - x[1] * y[3], x[1] * y[2] - x[2] * y[1]] AS z FROM c)"""


@query(f"WITH {_SIX} SELECT vec_id, round(x[1], 6)::DOUBLE AS m00, round(y[2], 6)::DOUBLE AS m11, round(z[3], 6)::DOUBLE AS m22, round(z[1], 6)::DOUBLE AS m02 FROM m")
def rot6d(spark, d):
    m = table(spark, d, "embeddings").select("vec_id", rot.matrix_of_six(F.transform(F.slice("embedding", 1, 6), lambda v: v.cast("double"))).alias("m"))
    return m.select("vec_id", *(F.round(F.get("m", F.lit(i)), 6).alias(n) for n, i in (("m00", 0), ("m11", 4), ("m22", 8), ("m02", 2))))


@query(f"WITH {_SIX} SELECT vec_id, round(degrees(atan2(x[2], x[1])), 4)::DOUBLE AS z, round(degrees(atan2(-x[3], sqrt(x[1] * x[1] + x[2] * x[2]))), 4)::DOUBLE AS y, round(degrees(atan2(y[3], z[3])), 4)::DOUBLE AS x FROM m")
def euler_zyx(spark, d):
    m = table(spark, d, "embeddings").select("vec_id", rot.matrix_of_six(F.transform(F.slice("embedding", 1, 6), lambda v: v.cast("double"))).alias("m"))
    e = m.select("vec_id", rot.euler_zyx_degrees(F.col("m")).alias("e"))
    return e.select("vec_id", *(F.round(F.get("e", F.lit(i)), 4).alias(n) for i, n in enumerate("zyx")))


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 5) AS x, round(embedding[2]::DOUBLE, 5) AS y, round(embedding[3]::DOUBLE, 5) AS z FROM embeddings")
def rotation_round_trip(spark, d):
    """Axis-angle to matrix and back; the vectors are shorter than pi, so they return."""
    v = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda v: v.cast("double")).alias("r"))
    back = v.select("vec_id", rot.axis_angle_of_matrix(rot.matrix_of_axis_angle(F.col("r"))).alias("r"))
    return back.select("vec_id", *(F.round(F.get("r", F.lit(i)), 5).alias(n) for i, n in enumerate("xyz")))


@query("""WITH p AS (SELECT vec_id, list_concat(embedding::DOUBLE[], embedding[1:8]::DOUBLE[]) AS pose FROM embeddings),
j AS (SELECT vec_id, j, pose[3 * j + 1] AS x, pose[3 * j + 2] AS y, pose[3 * j + 3] AS z FROM p, (VALUES (0), (3), (6), (9), (12), (15)) t(j)), t AS (SELECT *, sqrt(x * x + y * y + z * z) AS th FROM j),
u AS (SELECT *, CASE WHEN th < 1e-8 THEN 1 ELSE sin(th) / th END AS a, CASE WHEN th < 1e-8 THEN 0.5 ELSE (1 - cos(th)) / (th * th) END AS b FROM t),
m AS (SELECT vec_id, list([1 - b * (y * y + z * z), b * x * y - a * z, b * x * z + a * y, b * x * y + a * z, 1 - b * (x * x + z * z), b * y * z - a * x, b * x * z - a * y, b * y * z + a * x, 1 - b * (x * x + y * y)] ORDER BY j) AS ms FROM u GROUP BY 1)
SELECT vec_id, round(list_reduce(ms, lambda s, r: list_transform(range(9), lambda k: s[3 * (k // 3) + 1] * r[k % 3 + 1] + s[3 * (k // 3) + 2] * r[k % 3 + 4] + s[3 * (k // 3) + 3] * r[k % 3 + 7]))[1], 6)::DOUBLE AS head00 FROM m""")
def global_rotations(spark, d):
    out = skeleton.global_rotations(_pose(spark, d), "pose")
    return out.select("vec_id", F.round(F.get("global_rotation", F.lit(9 * 15)), 6).alias("head00"))


def _rest(spark, d) -> DataFrame:
    return table(spark, d, "nation").filter("n_nationkey < 24").select(F.col("n_nationkey").cast("int").alias("joint"), (F.col("n_nationkey") * 0.5).alias("x"), (F.col("n_regionkey") * 0.25).cast("double").alias("y"), F.lit(1.0).alias("z"))


@query("""WITH j AS (SELECT n_nationkey AS j, n_nationkey * 0.5 AS x, n_regionkey * 0.25 AS y, [-1,0,0,0,1,2,3,4,5,6,7,8,9,9,9,12,13,14,16,17,18,19,20,21][n_nationkey + 1] AS p FROM nation WHERE n_nationkey < 24)
SELECT a.j::INT AS joint, round(coalesce(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 0), 6)::DOUBLE AS length FROM j a LEFT JOIN j b ON a.p = b.j""")
def joint_offsets(spark, d):
    return skeleton.rest_offsets(_rest(spark, d), skeleton.joint_table(spark)).select("joint", "length")


@query()
def retarget_config(spark, d):
    return skeleton.retarget_config(_rest(spark, d), "mixamo")


# --- datasets ---------------------------------------------------------------------------


def _index(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.concat_ws("_", F.format_string("%010d", F.col("l_orderkey")), F.col("l_linenumber").cast("string")).alias("clip_id"), F.col("l_suppkey").alias("person_id"), (F.col("l_quantity") * 40).cast("long").alias("n_frames"),
        F.when(F.col("l_linestatus") == "F", 20.0).otherwise(30.0).alias("fps"), F.when(F.col("l_returnflag") == "R", "val").when(F.col("l_returnflag") == "A", "test").alias("split"),
    )


_IX = "ix AS (SELECT printf('%010d', l_orderkey) || '_' || l_linenumber AS clip_id, l_suppkey AS person_id, (l_quantity * 40)::BIGINT AS n_frames, CASE WHEN l_linestatus = 'F' THEN 20.0 ELSE 30.0 END::DOUBLE AS fps, CASE l_returnflag WHEN 'R' THEN 'val' WHEN 'A' THEN 'test' END AS split FROM lineitem)"


@query(f"WITH {_IX} SELECT person_id::VARCHAR AS person, count(*)::BIGINT AS clips, sum(n_frames)::BIGINT AS frames, round(sum(n_frames) / 20.0 / 60, 6)::DOUBLE AS minutes FROM ix GROUP BY 1")
def train_stats_by_person(spark, d):
    return dataset.person_coverage(_index(spark, d), "person_id", "n_frames").withColumn("minutes", F.round("minutes", 6))


_CS = f"{_IX}, cs AS (SELECT count(*)::BIGINT AS n_clips, sum(n_frames)::BIGINT AS frames, sum(n_frames / fps / 60) AS minutes, sum(n_frames) FILTER (WHERE coalesce(split, '') NOT IN ('val', 'test'))::BIGINT AS train_frames, sum(n_frames / fps / 60) FILTER (WHERE coalesce(split, '') NOT IN ('val', 'test')) AS train_minutes, count(DISTINCT person_id)::BIGINT AS n_persons FROM ix)"


@query(f"WITH {_CS} SELECT n_clips, frames, round(minutes, 4)::DOUBLE AS minutes, train_frames, round(train_minutes, 4)::DOUBLE AS train_minutes, n_persons FROM cs")
def corpus_stats(spark, d):
    return dataset.corpus_stats(_index(spark, d), "person_id", "n_frames", "fps", "split").withColumns({c: F.round(c, 4) for c in ("minutes", "train_minutes")})


@query(f"""WITH {_CS}, s AS (SELECT *, 600000 * 64 / greatest(1, train_frames) AS e FROM cs), t AS (SELECT *, CASE WHEN e > 150 THEN 2 WHEN e > 60 THEN 1 ELSE 0 END + CASE WHEN train_minutes < 15 THEN 2 WHEN train_minutes < 60 THEN 1 ELSE 0 END + 1 - CASE WHEN n_persons >= 20 THEN 2 WHEN n_persons >= 5 THEN 1 ELSE 0 END AS score FROM s)
SELECT round(e, 6)::DOUBLE AS exposures, score::INT AS score, CASE WHEN score >= 3 THEN 'high' WHEN score >= 1 THEN 'medium' ELSE 'low' END AS level,
least(500000, greatest(20000, floor(40 * greatest(1, train_frames) / 64.0)))::BIGINT AS num_steps, CASE WHEN train_minutes < 30 AND n_persons <= 2 THEN 'personalize-tiny' WHEN train_minutes < 3000 THEN 'finetune' ELSE 'large-corpus' END AS regime FROM t""")
def risk_plan(spark, d):
    stats = dataset.corpus_stats(_index(spark, d), "person_id", "n_frames", "fps", "split")
    plan = dataset.training_plan(dataset.risk_score(stats, 600_000, 64), 64)
    return plan.select(F.round("exposures", 6).alias("exposures"), "score", "level", "num_steps", "regime")


@query(f"WITH {_IX} SELECT count(*)::BIGINT AS n_clips, sum(n_frames)::BIGINT AS n_frames, round_even(sum(n_frames) / arg_max(fps, clip_id), 1)::DOUBLE AS total_seconds, round_even(sum(n_frames) / arg_max(fps, clip_id) / 3600, 3)::DOUBLE AS total_hours, round(sum(n_frames / fps), 3)::DOUBLE AS seconds_by_clip, arg_max(fps, clip_id) AS fps FROM ix WHERE n_frames >= 200")
def dataset_stats(spark, d):
    out = dataset.dataset_stats(_index(spark, d).filter("n_frames >= 200"), "clip_id")
    return out.withColumn("seconds_by_clip", F.round("seconds_by_clip", 3))


@query("SELECT doc_id, CASE WHEN ('0x' || substr(md5('0:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.1 THEN 'val' ELSE 'train' END AS split FROM documents")
def hash_split(spark, d):
    return table(spark, d, "documents").select("doc_id", dataset.hash_split(F.col("doc_id"), 0.1).alias("split"))


@query("""WITH s AS (SELECT DISTINCT source FROM documents), o AS (SELECT source, row_number() OVER (ORDER BY md5('0:' || source), source) AS r, count(*) OVER () AS n FROM s)
SELECT doc_id, CASE WHEN r <= greatest(1, floor(n * 0.1)) THEN 'val' ELSE 'train' END AS split FROM documents JOIN o USING (source)""")
def source_split(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(dataset.exact_split(docs, "source", 0.1), "source").select("doc_id", "split")


@query(f"""WITH {_E}, b AS (SELECT user_id, count(*)::BIGINT AS evals, min(row(value, i)) AS m, max(i) AS last FROM e GROUP BY 1), v AS (SELECT e.user_id, b.evals, m[1] AS bl, m[2] AS bs, last, count(*) FILTER (WHERE e.i > m[2] AND e.value > m[1])::BIGINT AS w FROM e JOIN b USING (user_id) GROUP BY ALL)
SELECT user_id, CASE WHEN evals >= 2 THEN bs::INT END AS best_step, CASE WHEN evals >= 2 THEN bl END AS best_loss, evals >= 2 AND bs <> last AND w >= 5 AS overfit, CASE WHEN evals >= 2 AND bs <> last AND w >= 5 THEN bs::INT END AS onset_step, w AS worse_after, evals FROM v""")
def curve_verdict(spark, d):
    return dataset.curve_verdict(_frames(spark, d).select("user_id", "frame_idx", "value"), "user_id", "frame_idx", "value")


@query(f"""WITH {_STEPS} SELECT (user_id % 25)::BIGINT AS nation, count(*)::BIGINT AS units, round(sum(a), 4)::DOUBLE AS motion FROM q WHERE NOT (v > 200 OR m > 150) AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_acctbal > 0) GROUP BY 1""")
def published_units(spark, d):
    """Units of sound quality and granted consent, with their mean motion, by group: the flagship."""
    from ..operators.consent import consent_gate

    verdicts = motion.quality_verdict(_events(spark, d), "user_id", ORDER, "value", "value", 1.0, 200.0, 150.0, 28.0)
    sound = verdicts.filter(~motion.is_hard(F.col("issues"))).select(F.col("user_id").alias("person_id"))
    registry = table(spark, d, "customer").select(F.col("c_custkey").alias("person_id"), (F.col("c_acctbal") > 0).alias("granted"))
    steps = series.difference(_events(spark, d), "user_id", ORDER, "value").groupBy(F.col("user_id").alias("person_id")).agg(F.avg(F.abs("diff")).alias("m"))
    kept = consent_gate(sound, registry).join(steps, "person_id")
    return kept.groupBy((F.col("person_id") % 25).alias("nation")).agg(F.count("*").alias("units"), F.round(F.sum("m"), 4).alias("motion"))


@query("""SELECT doc_id, CASE WHEN source = 'src0' THEN 'a person moves#a/DET person/NOUN moves/VERB#0.0#0.0' || chr(10) ELSE source || '#' || source || '/OTHER#0.0#0.0' || chr(10) END AS line FROM documents""")
def person_caption(spark, d):
    who = F.when(F.col("source") != "src0", F.col("source"))
    return table(spark, d, "documents").select("doc_id", clip_caption("person", F.lit(None), F.col("text"), who).alias("line"))
