"""Aggregates, filters, dates and expressions on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.functions.cleaning import (
    blank_to_null, compare_flag, map_labels, or_unknown, standard_upper, variant_field, zero_to_null,
)
from tierwise.functions.dates import (
    clean_date, date_key, date_parts, fiscal_year, quarter_label, release_season, safe_date,
)
from tierwise.functions.keys import document_hash, surrogate_key
from tierwise.functions.measures import (
    decimal_sum, difference_if_known, distinct_when, return_pct, rounded_mean, share_pct,
)
from tierwise.operators.calendar import date_dimension
from tierwise.operators.merge import high_water_mark, since_lookback
from tierwise.operators.ranking import group_medians
from tierwise.plans.reference_data import OTHER
from tierwise.registry.catalog import half_up, mean6, query, read, season_sql, sum6

MONEY = "decimal(18,2)"


def _sum2(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


@query(
    f"""SELECT l_returnflag, l_linestatus, {_sum2('l_quantity')} AS sum_qty,
       {_sum2('l_extendedprice')} AS sum_price, {mean6('l_discount', 4)} AS avg_discount,
       max(l_tax) AS max_tax, min(l_shipdate)::DATE AS first_shipped, count(*) AS n_lines
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2"""
)
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.lit(dt.datetime(1998, 9, 2)))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        decimal_sum(F.col("l_quantity"), MONEY).alias("sum_qty"),
        decimal_sum(F.col("l_extendedprice"), MONEY).alias("sum_price"),
        rounded_mean(F.col("l_discount"), 4, dtype="decimal(18,6)").alias("avg_discount"),
        F.max("l_tax").alias("max_tax"),
        F.min("l_shipdate").cast("date").alias("first_shipped"),
        F.count(F.lit(1)).alias("n_lines"),
    )


@query(
    """SELECT event_type, count(DISTINCT user_id) AS users,
       count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS users_above_50,
       count(DISTINCT CASE WHEN hour(ts) < 6 THEN user_id END) AS night_users,
       count(DISTINCT CASE WHEN ts >= TIMESTAMP '2024-01-25' THEN user_id END) AS recent_users
FROM events GROUP BY 1"""
)
def conditional_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, ts = F.col("user_id"), F.col("ts")
    return read(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count_distinct(user).alias("users"),
        distinct_when(F.col("value") > 50, user).alias("users_above_50"),
        distinct_when(F.hour(ts) < 6, user).alias("night_users"),
        distinct_when(ts >= F.lit(dt.datetime(2024, 1, 25)), user).alias("recent_users"),
    )


@query(
    f"""SELECT o_orderpriority, count(*) AS orders,
       {half_up("100 * count_if(o_orderstatus = 'F')", "count(*)", 1)} AS pct_finished,
       {half_up("100 * count_if(o_orderstatus = 'F' AND o_totalprice > 100000)",
                "count_if(o_totalprice > 100000)", 1)} AS pct_finished_of_large
FROM orders GROUP BY 1"""
)
def order_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished, large = F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        share_pct(F.count_if(finished), F.count(F.lit(1))).alias("pct_finished"),
        share_pct(F.count_if(finished & large), F.count_if(large)).alias("pct_finished_of_large"),
    )


@query(
    f"""SELECT l_returnflag,
       {half_up("CAST(2 * median(CAST(round(l_extendedprice * 100) AS BIGINT)) AS HUGEINT)", "200", 3)} AS median_price,
       {half_up("CAST(2 * median(CAST(round(l_quantity * 100) AS BIGINT)) AS HUGEINT)", "200", 3)} AS median_quantity,
       round(stddev_samp(l_quantity), 4) AS quantity_stddev
FROM lineitem GROUP BY 1"""
)
def median_and_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians without a group in one task, and the sample deviation."""
    lines = read(spark, sf_dir, "lineitem")
    typed = lines.select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").cast(MONEY).alias("median_price"),
        F.col("l_quantity").cast(MONEY).alias("median_quantity"),
    )
    medians = group_medians(
        typed, ["l_returnflag"], ["median_price", "median_quantity"],
        ["l_orderkey", "l_linenumber", "l_partkey"],
    )
    spread = lines.groupBy("l_returnflag").agg(
        F.round(F.stddev_samp("l_quantity"), 4).alias("quantity_stddev")
    )
    named = medians.withColumnRenamed("l_returnflag", "_flag")
    joined = spread.join(named, F.col("l_returnflag").eqNullSafe(F.col("_flag")), "left").drop("_flag")
    return joined.withColumn("median_price", F.round("median_price", 3))


@query(
    """SELECT CAST(event_id AS BIGINT) AS event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       md5('{"k":' || json_extract_string(props, '$.k') || '}') AS props_hash,
       CAST(NULL AS VARCHAR) AS absent FROM events"""
)
def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc")
    return read(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("doc")).select(
        "event_id",
        variant_field(doc, "$.k", "bigint").alias("k"),
        document_hash(doc).alias("props_hash"),
        variant_field(doc, "$.missing.deep", "string").alias("absent"),
    )


PRIORITY_GROUPS = {"1-URGENT": "NOW", "2-HIGH": "NOW", "3-MEDIUM": "SOON"}


@query(
    """SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '-' || coalesce(
         nullif(CAST(o_custkey AS VARCHAR), '0'), '_dbt_utils_surrogate_key_null_')) AS order_sk,
       CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_sk, CAST(o_orderdate AS DATE) AS order_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'NOW' WHEN '2-HIGH' THEN 'NOW'
         WHEN '3-MEDIUM' THEN 'SOON' ELSE 'OTHER' END AS urgency,
       coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'UNKNOWN') AS status
FROM orders"""
)
def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash keys (with a NULL part), date keys, labels and the unknown member."""
    customer = zero_to_null(F.col("o_custkey"))
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        surrogate_key(F.col("o_orderkey"), customer).alias("order_sk"),
        date_key(F.col("o_orderdate")).alias("date_sk"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        map_labels(F.col("o_orderpriority"), PRIORITY_GROUPS, OTHER).alias("urgency"),
        or_unknown(known).alias("status"),
    )


@query(
    """SELECT o_orderkey, TRY_CAST(text AS DATE) AS parsed,
       nullif(TRY_CAST(text AS DATE), DATE '0001-01-01') AS cleaned
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '0001-01-01' WHEN 'O' THEN ''
        ELSE strftime(o_orderdate, '%Y-%m-') || CAST(28 + o_orderkey % 4 AS VARCHAR) END AS text FROM orders)"""
)
def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date text with empty, impossible and placeholder values."""
    status = F.col("o_orderstatus")
    day = (28 + F.col("o_orderkey") % 4).cast("string")
    text = (
        F.when(status == "P", "0001-01-01").when(status == "O", "")
        .otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-"), day))
    )
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        safe_date(text, "yyyy-MM-dd").alias("parsed"),
        clean_date(text, "yyyy-MM-dd").alias("cleaned"),
    )


@query(
    f"""SELECT o_orderkey, year(o_orderdate) AS d_year, month(o_orderdate) AS d_month,
       quarter(o_orderdate) AS d_quarter, day(o_orderdate) AS d_day, dayofweek(o_orderdate) AS d_dow,
       strftime(o_orderdate, '%a') AS d_day_name, strftime(o_orderdate, '%Y-%m') AS d_month_label,
       {season_sql("o_orderdate")} AS season,
       year(o_orderdate) + CAST(month(o_orderdate) >= 10 AS BIGINT) AS fiscal_oct,
       year(o_orderdate) + CAST(month(o_orderdate) >= 7 AS BIGINT) AS fiscal_jul,
       year(o_orderdate) AS fiscal_jan, 'Q' || quarter(o_orderdate) AS quarter_label
FROM orders"""
)
def order_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    return orders.select(
        "o_orderkey",
        *date_parts("d"),
        release_season(F.month("d")).alias("season"),
        fiscal_year(F.col("d")).alias("fiscal_oct"),
        fiscal_year(F.col("d"), 7).alias("fiscal_jul"),
        fiscal_year(F.col("d"), 1).alias("fiscal_jan"),
        quarter_label(F.col("d")).alias("quarter_label"),
    )


@query(
    f"""SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, CAST(d AS DATE) AS full_date,
       year(d) AS calendar_year, quarter(d) AS calendar_quarter, month(d) AS calendar_month,
       day(d) AS day_of_month, dayofweek(d) AS day_of_week, dayofyear(d) AS day_of_year,
       weekofyear(d) AS week_of_year, monthname(d) AS month_name, strftime(d, '%b') AS month_name_short,
       dayname(d) AS day_name, 'Q' || quarter(d) AS quarter_label, strftime(d, '%Y-%m') AS year_month,
       dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
       {season_sql("d")} AS release_season,
       year(d) AS fiscal_year, quarter(d) AS fiscal_quarter, count(o_orderkey) AS n_orders
FROM (SELECT unnest(range((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders) + INTERVAL 1 DAY,
                          INTERVAL 1 DAY)) AS d)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY d"""
)
def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the order dates, with the orders of each day counted before the join."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    span = orders.agg(F.min("full_date").alias("a"), F.max("full_date").alias("b")).first()
    daily = orders.groupBy("full_date").agg(F.count(F.lit(1)).alias("n_orders"))
    calendar = date_dimension(spark, span["a"], span["b"] + dt.timedelta(days=1))
    return calendar.join(daily, "full_date", "left").fillna(0, ["n_orders"])


@query(
    """SELECT o_orderpriority, count(*) AS n_orders,
       max(o_orderdate)::DATE AS newest, min(o_orderdate)::DATE AS oldest
FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F') - INTERVAL 90 DAY
  AND o_totalprice BETWEEN 1000 AND 300000 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
GROUP BY 1"""
)
def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental window against a target's newest row, plus list and range filters."""
    orders = read(spark, sf_dir, "orders")
    mark = high_water_mark(orders.filter("o_orderstatus = 'F'"), "o_orderdate")
    recent = since_lookback(orders, "o_orderdate", mark, days=90).filter(
        F.col("o_totalprice").between(1000, 300000)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")
    )
    return recent.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.max("o_orderdate").cast("date").alias("newest"),
        F.min("o_orderdate").cast("date").alias("oldest"),
    )


@query(
    f"""SELECT p_partkey, upper(trim(p_type)) AS kind, nullif(trim(CASE WHEN p_size > 40 THEN '  ' ELSE p_name END), '')
         AS name, nullif(CASE WHEN p_size <= 10 THEN 0 ELSE p_size END, 0)::BIGINT AS known_size,
       CASE WHEN p_size > 10 THEN CAST(round(p_retailprice) AS BIGINT) - p_size END AS margin,
       CASE WHEN p_size > 10 THEN {half_up(
           "round(" + half_up("CAST(round(p_retailprice) AS BIGINT) - p_size", "p_size", 6) + " * 1000000)",
           "10000", 2)} END AS margin_pct,
       CASE WHEN p_size > 25 THEN 'ABOVE' WHEN p_size = 25 THEN 'EQUAL' ELSE 'BELOW' END AS size_flag
FROM part"""
)
def part_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text clean-up, zero as unknown, difference, return and the three-way flag."""
    size = zero_to_null(F.when(F.col("p_size") <= 10, 0).otherwise(F.col("p_size"))).cast("bigint")
    price = F.round("p_retailprice").cast("bigint")
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        standard_upper(F.col("p_type")).alias("kind"),
        blank_to_null(F.when(F.col("p_size") > 40, "  ").otherwise(F.col("p_name"))).alias("name"),
        size.alias("known_size"),
        difference_if_known(price, size).alias("margin"),
        return_pct(price, size).alias("margin_pct"),
        compare_flag(F.col("p_size"), F.lit(25), "ABOVE", "EQUAL", "BELOW").alias("size_flag"),
    )


@query(
    f"""SELECT l_suppkey, {half_up(sum6("l_extendedprice"), "1000000 * 1000", 2)} AS revenue_thousands,
       CAST(count_if(year(l_shipdate) >= (SELECT max(year(l_shipdate)) FROM lineitem) - 2) AS BIGINT)
         AS lines_last_years
FROM lineitem GROUP BY 1"""
)
def supplier_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled sums and a recent-years count per supplier."""
    lines = read(spark, sf_dir, "lineitem")
    newest = lines.agg(F.year(F.max("l_shipdate")).alias("newest"))
    return lines.groupBy("l_suppkey").agg(
        F.round(decimal_sum(F.col("l_extendedprice"), "decimal(18,6)") / 1000, 2).alias("revenue_thousands"),
        F.count_if(F.year("l_shipdate") >= newest.scalar() - 2).alias("lines_last_years"),
    )
