"""Every registered query against its SQL, and the shape of the plans."""

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tierwise.registry import ORACLES, QUERIES
from tierwise.registry.catalog import read


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, dt.date):
        return value.isoformat()[:10]
    return float(value) if not isinstance(value, str) else value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(picked, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    relation = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(relation.columns)
    assert table(got.columns, got.collect()) == table(relation.columns, relation.fetchall())


def test_every_query_has_sql_and_is_entered():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_gives_the_top_ten(spark):
    assert entry(spark).count() >= 10


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NO_JOIN_OVER_PAIRS = ("fact_movies", "kpi_genre_performance_fanout", "studio_output", "unit_price_bands", "order_ranks")


@pytest.mark.parametrize("name", NO_JOIN_OVER_PAIRS)
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["pricing_summary"](spark, sf_dir))
    assert "LessThanOrEqual(l_shipdate" in text
    assert "l_orderkey" not in text and "l_suppkey" not in text
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES["recent_orders"](spark, sf_dir))


def test_global_ranks_never_use_one_partition_for_the_rows(spark, sf_dir):
    assert "SinglePartition" not in plan(QUERIES["order_ranks"](spark, sf_dir))
    # The mean of the weighted rating brings one partial sum per task together, and no rows.
    lines = plan(QUERIES["kpi_top_movies"](spark, sf_dir)).splitlines()
    single = [below for line, below in zip(lines, lines[1:]) if "SinglePartition" in line]
    assert len(single) <= 2 and all("partial_avg" in line for line in single)


def test_queries_read_whole_tables(spark, sf_dir):
    assert QUERIES["land_documents"](spark, sf_dir).count() == read(spark, sf_dir, "part").count()


def test_calendar_and_incremental_counts_add_up_to_all_orders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").count()
    for name in ("order_calendar", "incremental_customers", "dim_dates"):
        assert QUERIES[name](spark, sf_dir).agg({"n_orders": "sum"}).first()[0] == orders
