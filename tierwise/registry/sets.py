"""Several groupings at once, distinct counts by sketch, and tables as multisets of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.operators.grouping import cube_sets, distinct_estimate, distinct_states, grouped_sets, merge_states, rollup_sets
from tierwise.operators.reconcile import differences, except_rows, intersect_rows, union_rows
from tierwise.registry.catalog import query, read


@query(
    """SELECT l_returnflag, l_linestatus, grouping_id(l_returnflag, l_linestatus) AS grouping_id, count(*) AS n_lines,
       sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents, max(l_quantity) AS largest
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)"""
)
def lines_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    values = {"n_lines": ("count", F.lit(1)), "cents": ("sum", cents), "largest": ("max", F.col("l_quantity"))}
    return grouped_sets(read(spark, sf_dir, "lineitem"), rollup_sets(["l_returnflag", "l_linestatus"]), values)


@query(
    """SELECT status, o_orderpriority, grouping_id(status, o_orderpriority) AS grouping_id, count(*) AS n_orders,
       min(o_orderdate)::DATE AS first_day
FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders) GROUP BY CUBE (status, o_orderpriority)"""
)
def orders_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination; orders without a status are a group of their own, apart from the totals."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = read(spark, sf_dir, "orders").withColumn("status", status)
    values = {"n_orders": ("count", F.lit(1)), "first_day": ("min", F.col("o_orderdate").cast("date"))}
    return grouped_sets(orders, cube_sets(["status", "o_orderpriority"]), values)


@query(
    """SELECT c_nationkey, c_mktsegment, grouping_id(c_nationkey, c_mktsegment) AS grouping_id, count(*) AS customers
FROM customer GROUP BY GROUPING SETS ((c_nationkey), (c_mktsegment), ()) HAVING count(*) > 20"""
)
def customer_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two single groupings and the grand total; small groups are left out."""
    values = {"customers": ("count", F.lit(1))}
    return grouped_sets(read(spark, sf_dir, "customer"), [["c_nationkey"], ["c_mktsegment"], []], values, F.col("customers") > 20)


@query(
    """SELECT coalesce(event_type, 'all') AS event_type, count(DISTINCT user_id) AS users, true AS close
FROM events GROUP BY ROLLUP (event_type)"""
)
def users_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States per type and day, merged to types and to all, within 3 % of the exact counts next to them."""
    events = read(spark, sf_dir, "events").select("event_type", F.col("ts").cast("date").alias("day"), "user_id")
    per_day = distinct_states(events, ["event_type", "day"], "user_id")
    by_type = merge_states(per_day, ["event_type"])
    states = by_type.unionByName(merge_states(by_type, []).withColumn("event_type", F.lit("all")))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    exact = exact.unionByName(events.agg(F.count_distinct("user_id").alias("users")).withColumn("event_type", F.lit("all")))
    close = F.abs(distinct_estimate("state") - F.col("users")) <= F.ceil(F.col("users") * 0.03)
    return exact.join(states, "event_type").select("event_type", "users", close.alias("close"))


def _suppliers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts of returned and of other lines, with repeats; one supplier in four is unknown."""
    supplier = F.when(F.col("l_suppkey") % 4 != 0, F.col("l_suppkey"))
    lines = read(spark, sf_dir, "lineitem").select(supplier.alias("s"), (F.col("l_partkey") % 50).alias("p"), "l_returnflag")
    return lines.where("l_returnflag = 'R'").drop("l_returnflag"), lines.where("l_returnflag = 'A'").drop("l_returnflag")


_SIDES = """WITH l AS (SELECT CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey END AS s, l_partkey % 50 AS p, l_returnflag FROM lineitem),
r AS (SELECT s, p FROM l WHERE l_returnflag = 'R'), a AS (SELECT s, p FROM l WHERE l_returnflag = 'A') """


@query(_SIDES + "SELECT * FROM r EXCEPT ALL SELECT * FROM a")
def supplies_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return except_rows(*_suppliers(spark, sf_dir), all_copies=True)


@query(_SIDES + "SELECT * FROM r EXCEPT SELECT * FROM a")
def supplies_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return except_rows(*_suppliers(spark, sf_dir))


@query(_SIDES + "SELECT * FROM r INTERSECT ALL SELECT * FROM a")
def supplies_intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intersect_rows(*_suppliers(spark, sf_dir), all_copies=True)


@query(_SIDES + "SELECT * FROM r INTERSECT SELECT * FROM a")
def supplies_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intersect_rows(*_suppliers(spark, sf_dir))


@query(_SIDES + "SELECT * FROM r UNION SELECT * FROM a")
def supplies_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_rows(*_suppliers(spark, sf_dir))


@query(
    _SIDES
    + """SELECT s, p, coalesce(x, 0) AS n_left, coalesce(y, 0) AS n_right FROM (SELECT s, p, count(*) AS x FROM r GROUP BY ALL)
FULL JOIN (SELECT s AS s2, p AS p2, count(*) AS y FROM a GROUP BY ALL) ON s IS NOT DISTINCT FROM s2 AND p = p2
WHERE coalesce(x, 0) <> coalesce(y, 0) AND x IS NOT NULL
UNION ALL SELECT s, p, 0, count(*) FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.s IS NOT DISTINCT FROM a.s AND r.p = a.p) GROUP BY ALL"""
)
def supplies_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the two sides do not have equally often."""
    return differences(*_suppliers(spark, sf_dir))
