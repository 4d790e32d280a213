"""Queries beyond the domain's own: streams drained to the end, event-time windows, rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import jobs
from .media import table
from .registry import registry

QUERIES, SQL, query = registry()


@query("""SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n, sum(l_quantity)::DOUBLE AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_extension(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS o FROM events),
s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e) SELECT user_id, epoch_us(min(ts))::BIGINT AS start_us, count(*)::BIGINT AS n FROM s GROUP BY user_id, k""")
def session_extension(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.unix_micros(F.min("ts")).alias("start_us"), F.count("*").alias("n")).drop("w")


@query("SELECT event_type, (epoch(ts)::BIGINT // 21600) * 21600 AS start_s, count(*)::BIGINT AS n, round(sum(value), 4)::DOUBLE AS total FROM events GROUP BY 1, 2".replace("epoch(ts)::BIGINT", "floor(epoch(ts))::BIGINT"))
def tumbling_extension(spark, d):
    """Event-time windows of a stream, drained to its end."""
    return jobs.drained(spark, f"{d}/events.parquet", jobs.tumbling, key="event_type", value="value", width="6 hours").select(
        "event_type", F.unix_seconds("start").alias("start_s"), "n", F.round("total", 4).alias("total")
    )


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS status FROM events GROUP BY 1")
def stream_upsert(spark, d):
    """Latest state of each key out of a stream of changes."""
    return jobs.latest(spark, f"{d}/events.parquet", "user_id", "event_id", {"status": "event_type"})


@query("""SELECT event_id, k AS "window" FROM (WITH RECURSIVE o AS (SELECT *, floor(epoch(ts))::DOUBLE AS a, floor(epoch(ts))::DOUBLE + value AS b, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), floor(epoch(ts)) + value, event_id) AS i FROM events), w AS (SELECT user_id, event_id, i, a AS s, 0::BIGINT AS k FROM o WHERE i = 1 UNION ALL
SELECT o.user_id, o.event_id, o.i, CASE WHEN o.b - w.s <= 86400 THEN w.s ELSE o.a END, CASE WHEN o.b - w.s <= 86400 THEN w.k ELSE w.k + 1 END FROM w JOIN o ON o.user_id = w.user_id AND o.i = w.i + 1) SELECT * FROM w)""")
def stream_windows(spark, d):
    """Greedy windows of a stream, the open window of each user kept as state between batches."""
    return jobs.streamed_windows(spark, f"{d}/events.parquet", 86400.0)
