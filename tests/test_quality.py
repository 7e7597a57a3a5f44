import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwise.operators import quality
from tierwise.operators.quality import Check
from tierwise.plans.checks import declared_checks

NOW = dt.datetime(2024, 2, 3)


@pytest.fixture(scope="module")
def table(spark):
    data = [(1, "a", 5.0), (2, "b", None), (2, None, 50.0), (None, "z", -1.0)]
    return spark.createDataFrame(data, "id int, kind string, x double")


def test_each_check_returns_its_violations(spark, table, rows):
    parent = spark.createDataFrame([(1,)], "pid int")
    assert rows(quality.not_null(table, "kind"), "id") == [(2,)]
    assert rows(quality.unique(table, "id")) == [(2, 2)]
    assert rows(quality.relationships(table, "id", parent, "pid")) == [(2, 2)]
    assert rows(quality.accepted_values(table, "kind", ["a", "b"]), "kind") == [("z",)]
    assert rows(quality.between(table, "x", 0, 10), "x") == [(-1.0,), (50.0,)]
    assert rows(quality.between(table, "x", 0, 10, F.col("id") == 2), "x") == [(50.0,)]
    assert rows(quality.between(table, "x", -1, 50)) == []
    assert rows(quality.row_count_between(table, 5, 9)) == [(4,)]
    assert rows(quality.row_count_between(table, 4, 4)) == []
    assert rows(quality.not_negative(table, "x"), "x") == [(-1.0,)]


def test_difference_tolerance_is_inclusive(spark, rows):
    df = spark.createDataFrame([(1, 100, 0, 200), (2, 100, 0, 201), (3, None, 0, 5)], "i int, a int, b int, r int")
    assert rows(quality.difference_matches(df, "r", "a", "b"), "i", "discrepancy") == [(2, 101)]


def test_far_future(spark, rows):
    df = spark.createDataFrame([(dt.date(2026, 2, 3),), (dt.date(2026, 2, 4),), (None,)], "d date")
    assert rows(quality.not_far_future(df, "d", F.lit(NOW.date()))) == [(dt.date(2026, 2, 4), 732)]


@pytest.mark.parametrize("hours, status", [(25, "pass"), (26, "warn"), (49, "warn"), (50, "error")])
def test_freshness_limits(spark, hours, status):
    df = spark.createDataFrame([(NOW - dt.timedelta(hours=hours),), (dt.datetime(2020, 1, 1),)], "t timestamp_ntz")
    assert quality.freshness(df, "t", F.lit(NOW)).first()["status"] == status


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert quality.freshness(df, "t", F.lit(NOW)).first()["status"] == "error"


def test_suite_reports_every_check(spark, table, rows):
    checks = [
        Check("t", "kind", "not_null", "kind"),
        Check("t", "x", "between", "x", low=0, high=10, severity="warn"),
        Check("t", "ids", "unique", "id"),
        Check("t", "rows", "row_count", low=1, high=10),
        Check("t", "rule", "rule", rule=F.col("x") > -5),
        Check("t", "gone", "not_null", "gone"),
        Check("gone", "id", "not_null", "id"),
        Check("t", "bad rule", "rule", rule=F.col("gone") > 0),
        Check("t", "parent", "relationships", "id", parent="t", parent_column="id"),
    ]
    got = {r["check"]: (r["failures"], r["status"]) for r in quality.run_checks(spark, {"t": table}, checks).collect()}
    assert got == {
        "kind": (1, "fail"), "x": (2, "warn"), "ids": (1, "fail"), "rows": (0, "pass"), "rule": (0, "pass"),
        "gone": (None, "error"), "id": (None, "error"), "bad rule": (None, "error"), "parent": (0, "pass"),
    }


def test_declared_checks_by_kind(spark):
    checks = declared_checks(NOW.date())
    counts = {}
    for check in checks:
        counts[check.kind] = counts.get(check.kind, 0) + 1
    assert counts == {
        "not_null": 46, "unique": 19, "relationships": 3, "accepted_values": 6, "between": 31,
        "row_count": 8, "rule": 3,
    }
    assert len({(c.table, c.name) for c in checks}) == len(checks) == 116


def test_a_check_that_breaks_at_run_time_is_alone_in_error(spark):
    from tierwise.operators.quality import stored_failures

    df = spark.createDataFrame([(1, "x"), (None, "3"), (-4, "4")], "n int, t string")
    checks = [
        Check("t", "known", "not_null", "n"),
        Check("t", "cast", "rule", rule=F.col("t").cast("int") > 0),
        Check("t", "positive", "rule", rule=F.col("n") > 0),
        Check("t", "few", "row_count", low=0, high=2),
        Check("t", "ids", "unique", "n"),
    ]
    got = {r["check"]: (r["failures"], r["status"]) for r in quality.run_checks(spark, {"t": df}, checks).collect()}
    assert got == {"known": (1, "fail"), "cast": (None, "error"), "positive": (1, "fail"), "few": (1, "fail"), "ids": (0, "pass")}
    failed = stored_failures({"t": df}, [c for c in checks if c.name != "cast"]).collect()
    assert sorted((r["t"] or "", r["n_rows"], r["failed_checks"]) for r in failed) == [("", 3, ["few"]), ("3", None, ["known"]), ("4", None, ["positive"])]


def test_checks_run_side_by_side(spark, table, monkeypatch):
    """Each of two checks of keys waits until the other has begun."""
    import threading

    both, begin = threading.Barrier(2, timeout=60), Check.failing_rows
    monkeypatch.setattr(Check, "failing_rows", lambda check, tables: both.wait() is not None and begin(check, tables))
    checks = [Check("t", "ids", "unique", "id"), Check("t", "kind", "not_null", "kind"), Check("t", "kinds", "unique", "kind")]
    got = quality.run_checks(spark, {"t": table}, checks).collect()
    assert [r["check"] for r in got] == ["ids", "kind", "kinds"] and "error" not in {r["status"] for r in got}
