"""Event-time windows and distinct rows of the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.registry.catalog import query, read, stamp
from tierwise.sources.shared_folder import scratch_path
from tierwise.streaming.windows import EventWindow, distinct_stream, window_stream

_SUMS = "count(*) AS n_events, sum(CAST(round(value * 100) AS BIGINT)) AS cents"
_BOUNDS = f"{stamp('window_start')} AS window_start, {stamp('window_end')} AS window_end"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    # A pattern fits one file and a folder of part files alike.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _closed(spark: SparkSession, sf_dir: str, window: EventWindow, delay: str, keys: list[str]) -> DataFrame:
    path, values = scratch_path(spark, "windows"), {"n_events": F.count(F.lit(1)), "cents": F.sum(F.round(F.col("value") * 100).cast("bigint"))}
    window_stream(_events(spark, sf_dir), window, delay, keys, values, path, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(path)


@query(
    f"""SELECT event_type, {_BOUNDS}, n_events, cents FROM (
  SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, {_SUMS}
  FROM events GROUP BY ALL) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""
)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of six hours per event type, each given out once, when the watermark has passed it."""
    return _closed(spark, sf_dir, EventWindow("ts", "6 hours"), "1 hour", ["event_type"])


@query(
    f"""SELECT {_BOUNDS}, n_events, cents FROM (
  SELECT window_start, window_start + INTERVAL 3 HOUR AS window_end, {_SUMS}
  FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL (i) HOUR AS window_start FROM events, range(3) t(i)) GROUP BY ALL)
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE"""
)
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of three hours that start every hour."""
    return _closed(spark, sf_dir, EventWindow("ts", "3 hours", "1 hour"), "30 minutes", [])


@query(
    f"""SELECT user_id, {_BOUNDS}, n_events, cents FROM (
  SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 8 HOUR AS window_end, {_SUMS} FROM (
    SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM (
      SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS new FROM events))
  GROUP BY user_id, island) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"""
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user that end eight hours after their last event."""
    return _closed(spark, sf_dir, EventWindow("ts", "8 hours", session=True), "2 hours", ["user_id"])


@query("SELECT event_id, user_id, event_type FROM events")
def stream_distinct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which every third event comes again some minutes later."""
    events = _events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(7))).otherwise(F.array(F.lit(0)))
    again = events.withColumn("minutes", F.explode(copies)).withColumn("ts", F.col("ts") + F.make_dt_interval(mins="minutes")).drop("minutes")
    path = scratch_path(spark, "distinct")
    distinct_stream(again, ["event_id"], "ts", "1 hour", path, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "event_type")
