"""As-of joins, frames, dated versions, groupings, sketches and multisets against plain Python or windows."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import Window, functions as F

from tierwise.operators import grouping, history, reconcile, sequences


def as_of(rows, facts, strict, keyed=True):
    out = []
    for i, k, t in rows:
        earlier = [(ft, fid) for fid, fk, ft in facts if t is not None and ft is not None and (not keyed or (k is not None and fk == k)) and (ft < t or ft == t and not strict)]
        out.append((i, max(earlier)[1] if earlier else None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("strict", "keyed", "partitions"), [(False, True, 8), (True, True, 3), (False, False, 8), (True, False, 2)])
def test_as_of_join_equals_search(spark, strict, keyed, partitions):
    rng = random.Random(partitions)
    key = lambda: rng.choice([0, 0, 0, rng.randrange(40), None])
    rows = [(i, key(), rng.choice([None, *[rng.randrange(300)] * 9])) for i in range(700)]
    facts = [(i, key(), rng.choice([None, *[rng.randrange(300)] * 9])) for i in range(500)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        left = spark.createDataFrame(rows, "i int, k int, t int")
        right = spark.createDataFrame(facts, "fid int, fk int, ft int")
        got = sequences.as_of_join(left, right, {"k": "fk"} if keyed else {}, "t", "ft", {"fid": "fid"}, ["fid"], strict)
        assert got.columns == ["i", "k", "t", "fid"]
        assert sorted(((r.i, r.fid) for r in got.collect()), key=str) == as_of(rows, facts, strict, keyed)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_a_hot_key_of_an_as_of_join_runs_over_tasks_and_facts_may_be_rare(spark):
    rows = spark.range(20_000).select("id", F.lit(1).alias("k"), F.col("id").alias("t"))
    facts = spark.createDataFrame([(1, 5, "a"), (1, 15_000, "b"), (2, 0, "c")], "k int, t long, v string")
    got = sequences.as_of_join(rows, facts, {"k": "k"}, "t", "t", {"v": "v"})
    assert sorted(map(tuple, got.groupBy("v").count().collect()), key=str) == sorted([(None, 5), ("a", 14_995), ("b", 5_000)], key=str)
    empty = sequences.as_of_join(rows.limit(0), facts, {"k": "k"}, "t", "t", {"v": "v"})
    assert empty.count() == 0
    assert sequences.as_of_join(rows.limit(3), facts.limit(0), {"k": "k"}, "t", "t", {"v": "v"}).where("v is null").count() == 3


@pytest.mark.parametrize("block", [3, 7, 1000])
def test_frames_equal_windows(spark, block):
    rng = random.Random(block)
    data = [(i, rng.choice(["hot", "hot", "x", None]), rng.choice([None, rng.randrange(20)]), rng.randrange(100)) for i in range(200)]
    df = spark.createDataFrame(data, "id int, g string, o int, v int").repartition(5)
    for partition in ([], ["g"]):
        w = Window.partitionBy(*partition).orderBy("o", "id")
        want = df.select(
            "id", F.sum("v").over(w.rowsBetween(-4, 1)).alias("s"), F.lead("v", 2).over(w).alias("l"), F.lag("v").over(w).alias("p"),
            F.first("v").over(w.rowsBetween(-3, -1)).alias("f"), F.count("o").over(w.rowsBetween(0, 0)).alias("c"),
        )
        values = {"s": (F.sum("v"), -4, 1), "l": (F.first("v"), 2, 2), "p": (F.first("v"), -1, -1), "f": (F.first("v"), -3, -1), "c": (F.count("o"), 0, 0)}
        got = sequences.framed(df, ["id"], ["o"], values, partition, block).select("id", *values)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


MOMENTS = [dt.datetime(2024, 1, d) for d in range(1, 9)]


def test_dated_versions_do_not_depend_on_arrival(spark, rows):
    data = [(1, MOMENTS[0], "a"), (1, MOMENTS[4], "b"), (1, MOMENTS[2], "c"), (1, MOMENTS[2], "d"), (2, MOMENTS[5], "x"), (2, MOMENTS[3], None), (3, MOMENTS[6], "y")]
    want = {
        (1, "a", MOMENTS[0], MOMENTS[2]), (1, "d", MOMENTS[2], MOMENTS[4]), (1, "b", MOMENTS[4], None),
        (2, None, MOMENTS[3], MOMENTS[5]), (2, "x", MOMENTS[5], None), (3, "y", MOMENTS[6], None),
    }
    rng = random.Random(1)
    for cuts in ([7], [1, 3, 7], [4, 5, 7]):
        rng.shuffle(data)
        state, start = None, 0
        for end in cuts:
            batch = [*data[start:end], *data[:start][:2], (None, MOMENTS[0], "z"), (9, None, "z")]  # some rows come again
            state = history.dated_versions(state, spark.createDataFrame(batch, "k int, t timestamp_ntz, v string"), "k", "t", "dbt_")
            start = end
        found = state.select("k", "v", "dbt_valid_from", "dbt_valid_to", "dbt_updated_at", "dbt_scd_id").collect()
        assert {tuple(r)[:4] for r in found} == want and len(found) == len(want)
        assert len({r.dbt_scd_id for r in found}) == len(want) and all(r.dbt_updated_at == r.dbt_valid_from for r in found)


def test_late_rows_leave_other_keys_alone_and_new_columns_are_kept(spark):
    first = spark.createDataFrame([(1, MOMENTS[0], "a"), (2, MOMENTS[0], "b")], "k int, t timestamp_ntz, v string")
    late = spark.createDataFrame([(1, MOMENTS[1], "c", 5)], "k int, t timestamp_ntz, v string, extra int")
    state = history.dated_versions(history.dated_versions(None, first, "k", "t"), late, "k", "t")
    found = {(r.k, r.v, r.extra, r.valid_to) for r in state.collect()}
    assert found == {(1, "a", None, MOMENTS[1]), (1, "c", 5, None), (2, "b", None, None)}
    with pytest.raises(ValueError, match="lack"):
        history.dated_versions(state, first, "k", "t")


def test_grouping_sets_keep_null_groups_apart_from_totals(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, None, 4), (None, "x", None)], "p string, q string, v int")
    values = {"n": ("count", F.col("v")), "s": ("sum", F.col("v")), "m": ("max", F.col("v"))}
    got = {(r.p, r.q, r.grouping_id): (r.n, r.s, r.m) for r in grouping.grouped_sets(df, grouping.cube_sets(["p", "q"]), values).collect()}
    want = {
        ("a", None, 0): (1, 1, 1), ("a", "x", 0): (1, 2, 2), (None, None, 0): (1, 4, 4), (None, "x", 0): (0, None, None),
        ("a", None, 1): (2, 3, 2), (None, None, 1): (1, 4, 4), (None, None, 2): (2, 5, 4), (None, "x", 2): (1, 2, 2), (None, None, 3): (3, 7, 4),
    }
    assert got == want
    assert grouping.rollup_sets(["p", "q"]) == [("p", "q"), ("p",), ()]
    few = grouping.grouped_sets(df, [["q"], ["q"], ["p"]], values, F.col("n") > 1)
    assert rows(few, "p", "q", "grouping_id", "n") == [("a", None, 2, 2), (None, None, 1, 2)]  # q comes first, its bit is the higher one
    assert rows(grouping.grouped_sets(df, [[]], values), "n", "grouping_id") == [(3, 0)]
    with pytest.raises(ValueError, match="avg"):
        grouping.grouped_sets(df, [["p"]], {"x": ("avg", F.col("v"))})


def test_states_of_new_rows_are_merged_into_stored_ones(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("day"), (F.col("id") % 20_000).alias("v"))
    stored = grouping.distinct_states(df.where("day < 6"), ["g", "day"], "v")
    both = stored.unionByName(grouping.distinct_states(df.where("day = 6"), ["g", "day"], "v"))
    for group in ([], ["g"], ["day"]):
        exact = {tuple(r)[:-1]: r.n for r in df.groupBy(*group).agg(F.count_distinct("v").alias("n")).collect()}
        told = grouping.merge_states(both, group).select(*group, grouping.distinct_estimate("state").alias("n"))
        for r in told.collect():
            assert abs(r.n - exact[tuple(r)[:-1]]) <= 0.03 * exact[tuple(r)[:-1]]


def test_multisets_with_repeats_and_nulls(spark):
    import collections

    rng = random.Random(4)
    values = list(itertools.product([1, 2, None], ["a", None]))
    left, right = ([rng.choice(values) for _ in range(n)] for n in (60, 45))
    a, b = (spark.createDataFrame(x, "k int, v string") for x in (left, right))
    x, y = collections.Counter(left), collections.Counter(right)
    count = lambda df: collections.Counter(map(tuple, df.collect()))
    assert count(reconcile.except_rows(a, b, True)) == x - y and count(reconcile.intersect_rows(a, b, True)) == x & y
    assert count(reconcile.except_rows(a, b.where("k = 1"))) == collections.Counter(set(x) - {v for v in y if v[0] == 1})
    assert count(reconcile.intersect_rows(a, b)) == collections.Counter(set(x) & set(y)) and count(reconcile.union_rows(a, b)) == collections.Counter(set(x) | set(y))
    found = {(r.k, r.v): (r.n_left, r.n_right) for r in reconcile.differences(a, b).collect()}
    assert found == {v: (x[v], y[v]) for v in {*x, *y} if x[v] != y[v]}
    assert reconcile.differences(a, a).isEmpty() and reconcile.except_rows(a.limit(0), b).isEmpty()
