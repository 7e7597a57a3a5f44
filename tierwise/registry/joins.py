"""Lookups, range joins, point-in-time joins and unmatched keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.functions.measures import decimal_sum, rounded_mean
from tierwise.operators.calendar import date_dimension
from tierwise.operators.history import snapshot
from tierwise.operators.joins import lookup, point_in_time, range_lookup, unmatched
from tierwise.plans.gold import budget_tiers
from tierwise.registry.catalog import mean6, query, read


@query(
    """SELECT o_orderkey, CASE WHEN cents >= 100000000 THEN 'BLOCKBUSTER' WHEN cents >= 40000000 THEN 'HIGH'
         WHEN cents >= 10000000 THEN 'MID' WHEN cents >= 1000000 THEN 'LOW' WHEN cents >= 0 THEN 'MICRO' END AS tier
FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"""
)
def price_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open intervals with an open top, from the tier table."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", cents.alias("cents"))
    tiers = budget_tiers(spark)
    return range_lookup(
        orders, "cents", tiers, "min_budget_usd", "max_budget_usd", {"tier": "tier_name"}
    ).drop("cents")


@query(
    """WITH bands AS (
  SELECT p_partkey, p_retailprice AS lo, lead(p_retailprice) OVER (ORDER BY p_retailprice) AS hi
  FROM (SELECT min(p_partkey) AS p_partkey, p_retailprice FROM part GROUP BY p_retailprice))
SELECT l.l_orderkey, l.l_linenumber::BIGINT AS l_linenumber, l.l_partkey, unit, p_partkey AS band
FROM (SELECT *, l_extendedprice / l_quantity AS unit FROM lineitem) l
LEFT JOIN bands ON unit >= lo AND (unit < hi OR hi IS NULL)"""
)
def unit_price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range join whose intervals grow with the data; each ends where the next begins."""
    prices = read(spark, sf_dir, "part").groupBy("p_retailprice").agg(F.min("p_partkey").alias("p_partkey"))
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit")
    )
    return range_lookup(lines, "unit", prices, "p_retailprice", None, {"band": "p_partkey"})


@query(
    """SELECT c_custkey, p_partkey FROM customer
LEFT JOIN part ON c_acctbal >= p_retailprice AND c_acctbal < p_retailprice + p_size / 10.0"""
)
def balance_price_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range join with overlapping intervals, one per part: every customer meets all parts around the balance."""
    parts = read(spark, sf_dir, "part").withColumn("high", F.col("p_retailprice") + F.col("p_size") / 10.0)
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    met = range_lookup(customers, "c_acctbal", parts, "p_retailprice", "high", {"p_partkey": "p_partkey"}, max_intervals=0)
    return met.drop("c_acctbal")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
         THEN CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) ELSE -1 END AS date_sk,
       coalesce(c_mktsegment, 'UNKNOWN') AS segment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"""
)
def unmatched_to_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts outside a short calendar, or with a filtered customer, go to the unknown member.

    Orders without a customer are dealt over many tasks; a customer with a large share of them is left to adaptive execution.
    """
    orders = read(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    calendar = date_dimension(spark, dt.date(1997, 1, 1), dt.date(2000, 1, 1))
    dated = lookup(orders, calendar, {"day": "full_date"}, {"date_sk": "date_sk"}, {"date_sk": -1})
    customers = read(spark, sf_dir, "customer").filter("c_acctbal > 0")
    named = lookup(
        dated, customers, {"o_custkey": "c_custkey"}, {"segment": "c_mktsegment"},
        {"segment": "UNKNOWN"}, spread_by=["o_orderkey"],
    )
    return named.select("o_orderkey", "date_sk", "segment")


@query(
    """SELECT n_name, coalesce(customers, 0) AS customers, avg_balance
FROM nation LEFT JOIN (SELECT c_nationkey, count(*) FILTER (WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000) AS customers, """
    + mean6("c_acctbal", 2)
    + """ AS avg_balance FROM customer GROUP BY 1) ON n_nationkey = c_nationkey"""
)
def nations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation appears, with the number of its rich builders, none or many; counted before the join."""
    rich_builder = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000)
    stats = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.count_if(rich_builder).alias("customers"),
        rounded_mean(F.col("c_acctbal"), 2, dtype="decimal(18,6)").alias("avg_balance"),
    )
    nations = read(spark, sf_dir, "nation")
    joined = lookup(
        nations, stats, {"n_nationkey": "c_nationkey"},
        {"customers": "customers", "avg_balance": "avg_balance"}, {"customers": 0},
    )
    return joined.select("n_name", "customers", "avg_balance")


@query(
    """SELECT c_custkey, c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 ORDER BY spent DESC, c_custkey LIMIT 25"""
)
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 25: totals per customer first, so the join sees one row per customer."""
    totals = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        decimal_sum(F.col("o_totalprice"), "decimal(18,2)").alias("spent")
    )
    customers = read(spark, sf_dir, "customer")
    named = lookup(
        totals, customers, {"o_custkey": "c_custkey"}, {"c_custkey": "c_custkey", "c_name": "c_name"}, how="inner"
    )
    return named.select("c_custkey", "c_name", "spent").orderBy(F.col("spent").desc(), "c_custkey").limit(25)


@query(
    """SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')"""
)
def customers_without_open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select("o_custkey").distinct()
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return unmatched(customers, pending, {"c_custkey": "o_custkey"})


@query(
    """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND c_acctbal < 0 THEN 'AT RISK'
         ELSE c_mktsegment END AS segment_then
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1995-01-01'"""
)
def orders_with_segment_then(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's segment of that day, from a version table of customers."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    moved = customers.withColumn(
        "c_mktsegment", F.when(F.col("c_acctbal") < 0, "AT RISK").otherwise(F.col("c_mktsegment"))
    )
    history = snapshot(None, customers, "c_custkey", ["c_mktsegment"], F.lit(dt.datetime(1995, 1, 1)))
    history = snapshot(history, moved, "c_custkey", ["c_mktsegment"], F.lit(dt.datetime(1998, 1, 1)))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = point_in_time(
        orders, history, {"o_custkey": "c_custkey"}, "o_orderdate",
        {"segment_then": "c_mktsegment"}, how="inner", spread_by=["o_orderkey"],
    )
    return joined.select("o_orderkey", "segment_then")
