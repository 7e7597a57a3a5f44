"""Merges, version tables, purges and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.operators.history import as_of_rows, snapshot, version_status
from tierwise.operators.merge import (
    incremental, merge_upsert, purge_keys, replace_children, require_unique,
)
from tierwise.registry.catalog import query, read, scratch_store, stamp
from tierwise.sources.shared_folder import cut_lineage, scratch_path
from tierwise.streaming.upsert import upsert_stream

CUT = dt.datetime(2000, 1, 1)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CAST(o_orderdate AS DATE) AS order_date FROM orders"""
)
def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows up to 2000, merged with rows from 1999 on in a new state."""
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("order_date")
    )
    existing = orders.filter(F.col("order_date") < CUT.date())
    incoming = orders.filter(F.col("order_date") >= dt.date(1999, 1, 1)).withColumn("o_orderstatus", F.lit("X"))
    require_unique(incoming, ["o_orderkey"])
    return merge_upsert(existing, incoming, ["o_orderkey"])


@query("SELECT o_custkey, max(o_orderdate)::DATE AS last_order, count(*) AS n_orders FROM orders GROUP BY 1")
def incremental_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table built up to 2000, then brought up to date: customers in the window are rebuilt from all their orders."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")

    def build(rows: DataFrame) -> DataFrame:
        return rows.groupBy("o_custkey").agg(
            F.max("o_orderdate").alias("last_order"), F.count(F.lit(1)).alias("n_orders")
        )

    past = build(orders.filter(F.col("o_orderdate") < F.lit(CUT)))
    merged = incremental(build, orders, "o_orderdate", past, "last_order", ["o_custkey"], group_by=["o_custkey"])
    return merged.withColumn("last_order", F.col("last_order").cast("date"))


@query(
    """SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem
WHERE l_returnflag = 'R' OR l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
)
def replace_order_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a returned line keep the suppliers of returned lines only, none left behind."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    bridge = lines.select("l_orderkey", "l_suppkey").distinct()
    returned = lines.filter("l_returnflag = 'R'").select("l_orderkey", "l_suppkey").distinct()
    return replace_children(bridge, returned, ["l_orderkey"])


@query(
    """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
)
def purge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    doomed = read(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return purge_keys(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), doomed, ["o_custkey"])


MOMENTS = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]


def _customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 2: negative balances lose their segment and machinery customers are gone. Day 3: back."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    second = customers.filter("c_mktsegment <> 'MACHINERY'").withColumns(
        {
            "c_mktsegment": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
            "c_acctbal": F.col("c_acctbal") + 1,
        }
    )
    third = customers.withColumn(
        "c_mktsegment",
        F.when((F.col("c_acctbal") >= 0) | (F.col("c_mktsegment") == "MACHINERY"), F.col("c_mktsegment")),
    )
    history = None
    for current, moment in zip((customers, second, third), MOMENTS):
        history = cut_lineage(snapshot(history, current, "c_custkey", ["c_mktsegment"], F.lit(moment)))
    return history


_HISTORY_SQL = """WITH history AS (
  SELECT c_custkey, c_mktsegment, c_acctbal, '2024-01-01 00:00:00' AS valid_from,
    CASE WHEN c_acctbal < 0 OR c_mktsegment = 'MACHINERY' THEN '2024-01-02 00:00:00' END AS valid_to FROM customer
  UNION ALL
  SELECT c_custkey, NULL, c_acctbal + 1, '2024-01-02 00:00:00', NULL FROM customer
  WHERE c_acctbal < 0 AND c_mktsegment <> 'MACHINERY'
  UNION ALL
  SELECT c_custkey, c_mktsegment, c_acctbal, '2024-01-03 00:00:00', NULL FROM customer WHERE c_mktsegment = 'MACHINERY'
)"""


@query(
    f"""{_HISTORY_SQL} SELECT c_custkey, c_mktsegment, c_acctbal, valid_from, valid_to, valid_from AS updated_at,
       md5(c_custkey || '|' || valid_from) AS scd_id,
       CASE WHEN valid_to IS NULL THEN 'ACTIVE' ELSE 'EXPIRED' END AS version_status FROM history"""
)
def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes (also to NULL), hard deletes, returning keys, and an unchecked column that moves."""
    return version_status(_customer_history(spark, sf_dir))


@query(
    f"""{_HISTORY_SQL} SELECT c_custkey, c_mktsegment FROM history
WHERE valid_from <= '2024-01-02 12:00:00' AND (valid_to > '2024-01-02 12:00:00' OR valid_to IS NULL)"""
)
def customers_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.lit(dt.datetime(2024, 1, 2, 12)).cast("timestamp_ntz")
    return as_of_rows(_customer_history(spark, sf_dir), moment).select("c_custkey", "c_mktsegment")


@query(
    f"""SELECT event_id, {stamp('ts')} AS ts, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
)
def stream_latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event per user, kept in a stored table by a stream over the event files."""
    schema = read(spark, sf_dir, "events").schema
    # A pattern fits one file and a folder of part files alike.
    files = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    events = files.select("event_id", "ts", "user_id", "event_type")
    store = scratch_store(spark)
    stream = upsert_stream(
        events, store, "SILVER", "latest_event", ["user_id"], "ts",
        scratch_path(spark, "stream"), ties=["event_id"],
    )
    stream.awaitTermination()
    return store.read("SILVER", "latest_event")
