"""Table counts, reference lists, stored tables and data checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.operators import quality
from tierwise.operators.audit import load_window, table_counts
from tierwise.operators.quality import Check
from tierwise.plans.silver import silver_genres
from tierwise.registry.catalog import query, read, scratch_store, stamp
from tierwise.sources.documents import land_snapshot

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(" UNION ALL ".join(f"SELECT '{t}' AS layer, count(*) AS row_count FROM {t}" for t in TABLES))
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({t: read(spark, sf_dir, t) for t in TABLES})


@query(
    f"""SELECT {stamp('max(ts)')} AS latest_ingestion, {stamp('min(ts)')} AS earliest_ingestion,
       count(*) AS total_raw_rows FROM events"""
)
def event_load_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_window(read(spark, sf_dir, "events"), "ts")


@query("SELECT n_nationkey::BIGINT AS genre_id, upper(trim(n_name)) AS genre_name FROM nation")
def reference_list_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference lists are appended whole, one array row per run; the newest one is read."""
    nation = read(spark, sf_dir, "nation")
    landed = None
    for day, rows in ((1, nation.filter("n_regionkey = 0")), (2, nation)):
        entry = F.struct(F.col("n_nationkey").alias("id"), F.concat(F.lit(" "), "n_name").alias("name"))
        # 25 nations: the list is fixed in size.
        text = rows.agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("t")).first()["t"]
        row = land_snapshot(spark, text, f"batch-{day}", dt.datetime(2024, 1, day))
        landed = row if landed is None else landed.unionByName(row)
    return silver_genres(landed, F.lit(None).cast("timestamp_ntz")).drop("_silver_loaded_at")


@query(
    """SELECT c_custkey, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) + 2 AS cents
FROM customer UNION ALL
SELECT s_suppkey, 'SUPPLIER', CAST(round(s_acctbal * 100) AS BIGINT) FROM supplier"""
)
def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table rebuilt twice from its own rows, then appended to."""
    store = scratch_store(spark)
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents")
    store.replace(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", cents), "GOLD", "accounts")
    for _ in range(2):
        store.replace(store.read("GOLD", "accounts").withColumn("cents", F.col("cents") + 1), "GOLD", "accounts")
    suppliers = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
        (F.round(F.col("s_acctbal") * 100).cast("bigint") + 0).alias("cents"),
    )
    rows = store.append(suppliers, "GOLD", "accounts")
    assert rows == suppliers.count()
    return store.read("GOLD", "accounts")


@query(
    """SELECT doc_id, quality::BIGINT AS quality FROM documents LEFT JOIN labels USING (doc_id)
WHERE quality IS NULL"""
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id")
    labelled = documents.join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return quality.not_null(labelled, "quality")


@query(
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    """SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1"""
)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = read(spark, sf_dir, "customer").filter("c_acctbal > 0")
    return quality.relationships(read(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey")


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", "event_type")
    return quality.accepted_values(events, "event_type", ["click", "view"])


@query(
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND NOT (l_quantity BETWEEN 5 AND 45)"""
)
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    return quality.between(lines, "l_quantity", 5, 45, F.col("l_returnflag") == "R").drop("l_returnflag")


@query(
    """SELECT 'orders' AS name, count(*) AS n_rows FROM orders HAVING NOT (count(*) BETWEEN 1 AND 100)
UNION ALL SELECT 'events', count(*) FROM events HAVING NOT (count(*) BETWEEN 1 AND 1000000000000)"""
)
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = quality.row_count_between(read(spark, sf_dir, "orders"), 1, 100)
    events = quality.row_count_between(read(spark, sf_dir, "events"), 1, 10**12)
    return orders.select(F.lit("orders").alias("name"), "n_rows").unionByName(
        events.select(F.lit("events").alias("name"), "n_rows")
    )


@query(
    """SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"""
)
def dq_not_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_negative(read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query(
    """SELECT * FROM (SELECT o_orderkey, cents, base, CASE WHEN o_orderstatus = 'P' THEN cents ELSE cents - base END AS net,
       cents - base AS expected, CASE WHEN o_orderstatus = 'P' THEN base ELSE 0 END AS discrepancy
FROM (SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice) AS BIGINT) AS cents, o_custkey AS base FROM orders))
WHERE discrepancy > 100"""
)
def dq_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.round("o_totalprice").cast("bigint").alias("cents"), F.col("o_custkey").alias("base"),
        "o_orderstatus",
    )
    net = F.col("cents") - F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.col("base"))
    return quality.difference_matches(orders.withColumn("net", net), "net", "cents", "base").drop("o_orderstatus")


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       date_diff('day', DATE '1998-06-30', CAST(o_orderdate AS DATE)) AS days_in_future
FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2000-06-30'"""
)
def dq_far_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date")
    )
    return quality.not_far_future(orders, "order_date", F.lit(dt.date(1998, 6, 30)))


@query(
    f"""SELECT event_type, {stamp('max(ts)')} AS newest, CASE WHEN age > 49 THEN 'error' WHEN age > 25 THEN 'warn'
       ELSE 'pass' END AS status FROM (
  SELECT 'all' AS event_type, ts, date_diff('second', (SELECT max(ts) FROM events), TIMESTAMP '2024-02-01') / 3600.0 AS age
  FROM events) GROUP BY event_type, age"""
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.freshness(read(spark, sf_dir, "events"), "ts", F.lit(dt.datetime(2024, 2, 1)))
    return checked.select(F.lit("all").alias("event_type"), "newest", "status")


@query(
    """SELECT 'orders' AS "table", 'unique_o_orderkey' AS "check",
  (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS failures, 'pass' AS status
UNION ALL SELECT 'orders', 'status', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')), 'warn'
UNION ALL SELECT 'orders', 'price', (SELECT count(*) FROM orders WHERE NOT (o_totalprice BETWEEN 1000 AND 200000)), 'fail'
UNION ALL SELECT 'orders', 'rows', 0, 'pass'
UNION ALL SELECT 'orders', 'customer', (SELECT count(DISTINCT o_custkey) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)),
  (SELECT CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'orders', 'absent', NULL, 'error'
UNION ALL SELECT 'customer', 'name', (SELECT count(*) FROM customer WHERE c_name IS NULL), 'pass'"""
)
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan per table for all row-level checks; a broken check is reported, not raised."""
    tables = {t: read(spark, sf_dir, t) for t in ("orders", "customer")}
    checks = [
        Check("orders", "unique_o_orderkey", "unique", "o_orderkey"),
        Check("orders", "status", "accepted_values", "o_orderstatus", values=("F", "O"), severity="warn"),
        Check("orders", "price", "between", "o_totalprice", low=1000, high=200000),
        Check("orders", "rows", "row_count", low=1, high=10**12),
        Check("orders", "customer", "relationships", "o_custkey", parent="customer", parent_column="c_custkey"),
        Check("orders", "absent", "not_null", "no_such_column"),
        Check("customer", "name", "not_null", "c_name"),
    ]
    return quality.run_checks(spark, tables, checks)
