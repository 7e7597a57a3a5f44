"""Rows in an order: as-of joins, frames, dated versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.operators.history import dated_versions
from tierwise.operators.sequences import as_of_join, framed
from tierwise.registry.catalog import query, read, stamp
from tierwise.sources.shared_folder import cut_lineage


@query(
    """WITH e AS (SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS k, event_type, value FROM events),
views AS (SELECT k, ts, max(event_id) AS view_id FROM e WHERE event_type = 'view' GROUP BY ALL)
SELECT e.event_id, e.k, views.view_id, date_diff('second', views.ts, e.ts) AS seconds
FROM e ASOF LEFT JOIN views ON e.k = views.k AND e.ts > views.ts WHERE e.event_type <> 'view'"""
)
def events_after_last_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each other event with the newest view before it; one key holds a third of all events."""
    key = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    events = read(spark, sf_dir, "events").select("event_id", "ts", key.alias("k"), "event_type")
    views = events.where("event_type = 'view'")
    others = events.where("event_type <> 'view'").select("event_id", "ts", "k")
    met = as_of_join(others, views, {"k": "k"}, "ts", "ts", {"view_id": "event_id", "viewed": "ts"}, ["event_id"], strict=True)
    seconds = F.date_trunc("second", "ts").cast("long") - F.date_trunc("second", "viewed").cast("long")
    return met.select("event_id", "k", "view_id", seconds.alias("seconds"))


@query(
    """SELECT o_orderkey, sum(cents) OVER w6 AS week_cents, max(cents) OVER around AS around_cents, lead(o_orderkey) OVER o AS next_key,
       lag(o_orderkey, 3) OVER o AS third_before, first_value(o_orderkey) OVER w6 AS first_key, last_value(o_orderkey) OVER around AS last_key
FROM (SELECT o_orderkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
WINDOW o AS (ORDER BY o_orderdate, o_orderkey), w6 AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
around AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"""
)
def order_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving sums, neighbours and frame ends over all orders in one order without a partition."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", cents.alias("cents"))
    frames = {
        "week_cents": (F.sum("cents"), -6, 0), "around_cents": (F.max("cents"), -2, 2), "next_key": (F.first("o_orderkey"), 1, 1),
        "third_before": (F.first("o_orderkey"), -3, -3), "first_key": (F.first("o_orderkey"), -6, 0), "last_key": (F.last("o_orderkey"), -2, 2),
    }
    return framed(orders, ["o_orderkey"], ["o_orderdate"], frames).drop("o_orderdate", "cents")


@query(
    """SELECT event_id, avg_cents, previous_id FROM (SELECT event_id, user_id % 3 = 0 AS hot,
    sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id % 3 = 0 ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS avg_cents,
    lag(event_id) OVER (PARTITION BY user_id % 3 = 0 ORDER BY ts, event_id) AS previous_id FROM events)"""
)
def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames inside of two partitions, one with a third of the events."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = read(spark, sf_dir, "events").select("event_id", "ts", (F.col("user_id") % 3 == 0).alias("hot"), cents.alias("cents"))
    frames = {"avg_cents": (F.sum("cents"), -9, 0), "previous_id": (F.first("event_id"), -1, -1)}
    return framed(events, ["event_id"], ["ts"], frames, partition=["hot"]).select("event_id", *frames)


@query(
    f"""SELECT user_id, event_type, {stamp('ts')} AS valid_from, {stamp('lead(ts) OVER (PARTITION BY user_id ORDER BY ts)')} AS valid_to
FROM (SELECT user_id, date_trunc('hour', ts) AS ts, max(event_type) AS event_type FROM events GROUP BY ALL)"""
)
def late_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions per user that arrive in three batches in no order: every batch splits versions of the ones before."""
    events = read(spark, sf_dir, "events").select("user_id", F.date_trunc("hour", "ts").alias("ts"), "event_type", "event_id")
    history = None
    for batch in range(3):
        arrived = events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == batch).drop("event_id")
        history = cut_lineage(dated_versions(history, arrived, "user_id", "ts"))
    return history.select("user_id", "event_type", "valid_from", "valid_to")
