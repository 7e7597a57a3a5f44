"""Keep-one-row operators, ranks and lags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.functions.measures import decimal_sum, share_pct
from tierwise.operators.dedup import drop_null_keys, keep_latest, latest_row, lowest_child
from tierwise.operators.ranking import (
    Key, Rank, change_from_previous, global_ranks, window_ranks,
)
from tierwise.registry.catalog import half_up, query, read, stamp
from tierwise.sources.documents import distinct_listing


@query(
    f"""SELECT event_id, {stamp('ts')} AS ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
)
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").drop("props")
    return keep_latest(events, ["user_id"], "ts", ["event_id"])


@query(
    """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1"""
)
def first_listed_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids repeated later in a listing are dropped."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return distinct_listing(events, "user_id", ["event_id"])


@query("SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1")
def primary_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = drop_null_keys(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"), ["l_orderkey"])
    return lowest_child(lines, "l_orderkey", "l_suppkey")


@query(
    f"""SELECT event_id, {stamp('ts')} AS ts, event_type FROM events
WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)"""
)
def events_of_latest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that go with the newest row: its day as bounds that reach the scan."""
    events = read(spark, sf_dir, "events")
    newest = latest_row(events.select("ts", "event_id"), "ts", ["event_id"])
    bounds = newest.select(F.date_trunc("day", "ts").cast("string").alias("a"), (F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")).cast("string").alias("b")).first()
    ts, kind = F.col("ts"), events.schema["ts"].dataType
    if bounds is None:
        return events.select("event_id", "ts", "event_type")
    of_day = (ts >= F.lit(bounds["a"]).cast(kind)) & (ts < F.lit(bounds["b"]).cast(kind))
    return events.filter(of_day).select("event_id", "ts", "event_type")


_PRICE = (Key("o_totalprice", descending=True, nulls_last=True),)
ORDER_RANKS = (
    Rank("price_rank", "rank", _PRICE),
    Rank("price_dense", "dense_rank", _PRICE),
    Rank("price_in_status", "dense_rank", _PRICE, partition=("o_orderstatus",)),
    Rank(
        "customer_price", "dense_rank",
        (Key("o_custkey", descending=True), Key("o_totalprice", descending=True)),
    ),
    Rank("price_percentile", "percent_rank", (Key("known_price"),), places=4),
    Rank("price_decile", "ntile", (Key("known_price"),)),
    Rank("decile_in_status", "ntile", (Key("known_price"),), partition=("o_orderstatus",)),
    Rank("position", "row_number", _PRICE),
)


@query(
    """SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS price_rank,
  dense_rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS price_dense,
  dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC NULLS LAST) AS price_in_status,
  dense_rank() OVER (ORDER BY o_custkey DESC NULLS FIRST, o_totalprice DESC NULLS FIRST) AS customer_price,
  round(percent_rank() OVER (ORDER BY known_price NULLS FIRST), 4) AS price_percentile,
  ntile(10) OVER (ORDER BY known_price NULLS FIRST, o_orderkey) AS price_decile,
  ntile(10) OVER (PARTITION BY o_orderstatus ORDER BY known_price NULLS FIRST, o_orderkey) AS decile_in_status,
  row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS position
FROM (SELECT *, CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_totalprice END AS known_price
      FROM orders)"""
)
def order_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks over all orders without a global window; two fifths of the percentile keys are NULL."""
    known = F.when(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_totalprice"))
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", known.alias("known_price")
    )
    return global_ranks(orders, ["o_orderkey"], ORDER_RANKS)


@query(
    f"""WITH yearly AS (
  SELECT year(o_orderdate) AS order_year, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
         sum(CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS late
  FROM orders GROUP BY 1)
SELECT order_year, orders, customers, total,
  orders - lag(orders) OVER (ORDER BY order_year) AS orders_change,
  {half_up("100 * (orders - lag(orders) OVER (ORDER BY order_year))",
           "lag(orders) OVER (ORDER BY order_year)", 1)} AS orders_change_pct,
  rank() OVER (ORDER BY late DESC NULLS FIRST) AS late_rank,
  rank() OVER (ORDER BY late DESC NULLS LAST) AS late_rank_known_first
FROM yearly"""
)
def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-over-year change and ranks with both NULL orders; windows run on one row per year."""
    late = F.when(F.year("o_orderdate") >= 1997, F.col("o_totalprice"))
    yearly = read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct("o_custkey").alias("customers"),
        decimal_sum(F.col("o_totalprice"), "decimal(18,2)").alias("total"),
        decimal_sum(late, "decimal(18,2)").alias("late"),
    )
    changed = change_from_previous(yearly, "order_year", ["orders"])
    change = F.col("orders") - F.col("previous_orders")
    ranked = window_ranks(
        changed.withColumns(
            {"orders_change": change, "orders_change_pct": share_pct(change, F.col("previous_orders"))}
        ),
        ["order_year"],
        [
            Rank("late_rank", "rank", (Key("late", descending=True),)),
            Rank("late_rank_known_first", "rank", (Key("late", descending=True, nulls_last=True),)),
        ],
    )
    return ranked.drop("late", "previous_orders")
