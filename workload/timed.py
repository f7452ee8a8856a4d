"""As-of and interval joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.operators.joins import asof_join, interval_join
from workload.registry import query, table


@query(
    "asof_latest_click",
    "SELECT p.event_id, p.user_id, p.ts, c.clicked, c.clicked_value FROM events p ASOF LEFT JOIN "
    "(SELECT user_id, ts AS clicked, max(value) AS clicked_value FROM events WHERE event_type = 'click' GROUP BY ALL) c "
    "ON p.user_id = c.user_id AND p.ts >= c.clicked",
)
def asof_latest_click(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("user_id", F.col("ts").alias("clicked"), F.col("value").alias("clicked_value"))
    return asof_join(events.select("event_id", "user_id", "ts"), clicks, ["user_id"], "ts", "clicked", ["clicked", "clicked_value"])


@query(
    "asof_one_hot_key",
    "SELECT e.event_id, c.event_id AS latest_click FROM (SELECT *, user_id % 10 >= 1 AS hot FROM events) e ASOF LEFT JOIN "
    "(SELECT user_id % 10 >= 1 AS hot, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY ALL) c "
    "ON e.hot = c.hot AND e.ts >= c.ts",
)
def asof_one_hot_key(spark, sf_dir):
    """Nine tenths of all events have one key."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", (F.col("user_id") % 10 >= 1).alias("hot"))
    clicks = events.where("event_type = 'click'").select("hot", F.col("ts").alias("at"), F.col("event_id").alias("latest_click"))
    return asof_join(events.drop("event_type"), clicks, ["hot"], "ts", "at", ["latest_click"]).select("event_id", "latest_click")


@query(
    "interval_join_mixed_lengths",
    "WITH s AS (SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate AS a, "
    "l_shipdate + to_seconds(CAST(l_quantity * l_quantity * 3600 AS BIGINT)) AS b FROM lineitem) "
    "SELECT x.l_orderkey, x.l_linenumber, count(*) AS overlapping, min(y.l_orderkey) AS first_order FROM s x JOIN s y "
    "ON x.l_partkey = y.l_partkey AND x.a <= y.b AND y.a <= x.b GROUP BY x.l_orderkey, x.l_linenumber",
)
def interval_join_mixed_lengths(spark, sf_dir):
    """Shipments of a part that overlap in time, each from one hour to a hundred days long."""
    start = F.col("l_shipdate").cast("timestamp_ntz")
    end = start + F.make_dt_interval(secs=(F.col("l_quantity") * F.col("l_quantity") * 3600).cast("decimal(18,6)"))
    spans = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", start.alias("a"), end.alias("b"))
    others = spans.select("l_partkey", F.col("l_orderkey").alias("other"), F.col("a").alias("other_a"), F.col("b").alias("other_b"))
    pairs = interval_join(spans, others, ("a", "b"), ("other_a", "other_b"), ["l_partkey"])
    return pairs.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("overlapping"), F.min("other").alias("first_order"))
