import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierwise.operators import dedup, history, joins, merge, nested, ranking
from tierwise.operators.calendar import date_dimension
from tierwise.operators.ranking import (
    Key, Rank, change_from_previous, global_ranks, group_medians, window_ranks,
)



def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


DAY = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def test_keep_latest_breaks_ties_and_limits_before_the_shuffle(spark, rows):
    df = spark.createDataFrame(
        [(1, DAY[0], "a"), (1, DAY[1], "b"), (1, DAY[1], "c"), (2, None, "d")], "k int, t timestamp, v string"
    )
    latest = dedup.keep_latest(df, ["k"], "t", ["v"])
    assert rows(latest, "k", "v") == [(1, "c"), (2, "d")]
    text = plan(latest)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_keep_first_lowest_child_and_latest_row(spark, rows):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, None), (3, 9)], "p int, c int")
    assert rows(dedup.keep_first(df, ["p"], ["c"])) == [(1, 2), (2, None), (3, 9)]
    assert rows(dedup.lowest_child(df, "p", "c")) == [(1, 2), (3, 9)]
    assert rows(dedup.latest_row(df, "c")) == [(3, 9)]
    assert rows(dedup.drop_null_keys(df, ["c"])) == [(1, 2), (1, 3), (3, 9)]


DOCS = [
    (1, '{"g":[{"id":7.6,"name":"A","more":1},{"id":2},{"id":8,"name":"again"}]}'),
    (2, '{"g":[]}'),
    (3, "{}"),
    (4, '{"g":[{"name":"no id"}]}'),
]


def documents(spark):
    return spark.createDataFrame(DOCS, "k int, t string").select("k", F.parse_json("t").alias("doc"))


FIELDS = {"gid": ("id", "bigint"), "gname": ("name", "string")}


def test_explode_array_keeps_position_and_rounds(spark, rows):
    got = nested.explode_array(documents(spark), "doc", "$.g", FIELDS, keep=["k"], position="at")
    assert rows(got) == [(1, 0, 8, "A"), (1, 1, 2, None), (1, 2, 8, "again"), (4, 0, None, "no id")]


def test_explode_array_once_per_value(spark, rows):
    got = nested.explode_array(
        documents(spark), "doc", "$.g", FIELDS, keep=["k"], position="at", once_per="gid"
    )
    assert rows(got) == [(1, 0, 8, "A"), (1, 1, 2, None)]


def test_explode_array_outer_keeps_childless_parents(spark, rows):
    got = nested.explode_array(documents(spark), "doc", "$.g", FIELDS, keep=["k"], outer=True)
    assert [r[0] for r in rows(got)] == [1, 1, 1, 2, 3, 4]


def test_lookback_window(spark, rows):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DAY)], "i int, t timestamp")
    mark = merge.high_water_mark(df.filter("i <= 6"), "t")
    assert [r[0] for r in rows(merge.since_lookback(df, "t", mark, 3), "i")] == [3, 4, 5, 6, 7, 8]
    empty = merge.high_water_mark(df.limit(0), "t")
    assert empty is None and merge.since_lookback(df, "t", empty).count() == 9


def test_merge_upsert_is_idempotent(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    once = merge.merge_upsert(old, new, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(merge.merge_upsert(once, new, ["k"])) == rows(once)


def test_merge_upsert_takes_the_newest_incoming(spark, rows):
    old = spark.createDataFrame([(1, 0)], "k int, t int")
    new = spark.createDataFrame([(1, 5), (1, 7)], "k int, t int")
    assert rows(merge.merge_upsert(old, new, ["k"], newest="t")) == [(1, 7)]
    with pytest.raises(ValueError, match="duplicate merge key"):
        merge.require_unique(new, ["k"])


def test_replace_children_leaves_no_stale_rows(spark, rows):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "p int, c string")
    new = spark.createDataFrame([(1, "z")], "p int, c string")
    assert rows(merge.replace_children(old, new, ["p"])) == [(1, "z"), (2, "c")]
    assert rows(merge.purge_keys(old, new, ["p"])) == [(2, "c")]


def test_incremental_bridge_drops_children_of_emptied_parents(spark, rows):
    def build(df):
        return df.select("p", F.explode("cs").alias("c"), "t")

    first = spark.createDataFrame([(1, ["a"], DAY[0]), (2, ["b"], DAY[0])], "p int, cs array<string>, t timestamp")
    target = merge.incremental(build, first, "t", None, "t", ["p", "c"], children_of=["p"])
    later = spark.createDataFrame([(1, [], DAY[1]), (2, ["x"], DAY[1])], first.schema)
    merged = merge.incremental(build, later, "t", target, "t", ["p", "c"], children_of=["p"])
    assert rows(merged, "p", "c") == [(2, "x")]
    refreshed = merge.incremental(build, first, "t", merged, "t", ["p", "c"], full_refresh=True)
    assert rows(refreshed, "p", "c") == [(1, "a"), (2, "b")]


def test_snapshot_life_cycle(spark, rows):
    schema = "k int, a string, note string"
    states = [
        [(1, "x", "n"), (2, None, "n"), (3, "z", "n")],
        [(1, "x", "moved"), (2, "y", "n")],
        [(1, None, "n"), (2, "y", "n"), (3, "z", "n"), (4, "w", "n")],
    ]
    table = None
    for state, day in zip(states, DAY):
        table = history.snapshot(table, spark.createDataFrame(state, schema), "k", ["a"], F.lit(day))
    got = rows(table, "k", "a", F.dayofmonth("valid_from"), F.dayofmonth("valid_to"))
    assert sorted(got, key=lambda r: (r[0], r[2])) == [
        (1, "x", 1, 3), (1, None, 3, None),
        (2, None, 1, 2), (2, "y", 2, None),
        (3, "z", 1, 2), (3, "z", 3, None),
        (4, "w", 3, None),
    ]
    # The unchecked column did not open a version, and is stored as first seen.
    assert rows(table.filter("k = 1 and a = 'x'"), "note") == [("n",)]
    assert table.select("scd_id").distinct().count() == table.count()
    at = history.as_of_rows(table, F.lit(DAY[1]))
    assert rows(at, "k", "a") == [(1, "x"), (2, "y")]
    kept = history.snapshot(None, spark.createDataFrame(states[0], schema), "k", ["a"], F.lit(DAY[0]))
    kept = history.snapshot(
        kept, spark.createDataFrame(states[1], schema), "k", ["a"], F.lit(DAY[1]), hard_deletes=False
    )
    assert rows(kept.filter("k = 3"), "valid_to") == [(None,)]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_lookup_with_nulls_apart_equals_the_plain_one(spark, rows, threshold):
    facts = spark.createDataFrame(
        [(i, None if i % 3 == 0 else (7 if i % 3 == 1 else i)) for i in range(60)], "id int, k int"
    )
    dim = spark.createDataFrame([(7, "seven"), (8, "eight"), (None, "none")], "key int, name string")
    args = (facts, dim, {"k": "key"}, {"label": "name"}, {"label": "UNKNOWN"})
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plain = rows(joins.lookup(*args))
        apart = joins.lookup(*args, spread_by=["id"])
        assert plain == rows(apart)
        # The dimension is never copied, whatever its size.
        assert "explode" not in plan(apart).lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
    assert len(plain) == 60 and sum(r[2] == "seven" for r in plain) == 20


TIERS = [("LOW", 0, 10), ("MID", 10, 100), ("TOP", 100, None)]


def test_range_lookup_boundaries(spark, rows):
    tiers = spark.createDataFrame(TIERS, "tier string, lo int, hi int")
    values = spark.createDataFrame([(v,) for v in (-1, 0, 9, 10, 99, 100, 5000, None)], "v int")
    args = (values, "v", tiers, "lo", "hi", {"tier": "tier"})
    expected = [
        (-1, None), (0, "LOW"), (9, "LOW"), (10, "MID"), (99, "MID"), (100, "TOP"), (5000, "TOP"), (None, None),
    ]
    assert rows(joins.range_lookup(*args)) == expected
    assert rows(joins.range_lookup(*args, max_intervals=0)) == expected
    odd = [("ODD", 50, 100), ("NONE", 60, 60), ("BACK", 70, 50), ("UNKNOWN", None, 80), ("ALL", -5, None)]
    overlapping = tiers.unionByName(spark.createDataFrame(odd, tiers.schema))
    expected = [(v, t) for v, t in expected if t] + [(v, "ALL") for v, _ in expected if v is not None] + [(99, "ODD"), (None, None)]
    for most in (1000, 0):
        assert sorted(rows(joins.range_lookup(values, "v", overlapping, "lo", "hi", {"tier": "tier"}, max_intervals=most)), key=str) == sorted(expected, key=str)
    steps = rows(joins.range_lookup(values, "v", tiers, "lo", None, {"tier": "tier", "from": "lo"}))
    assert steps == [(-1, None, None), (0, "LOW", 0), (9, "LOW", 0), (10, "MID", 10), (99, "MID", 10), (100, "TOP", 100), (5000, "TOP", 100), (None, None, None)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_range_lookup_with_a_hundred_thousand_overlapping_intervals(spark, monkeypatch, tmp_path, broadcast):
    import duckdb

    if not broadcast:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    low = (F.xxhash64("id") % 1_000_000).cast("double") / 7
    intervals = spark.range(100_000).select("id", low.alias("lo"), (low + F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(9)) * F.col("id") % 40).alias("hi"))
    intervals = intervals.withColumn("hi", F.when(F.col("id") % 50_000 != 7, F.col("hi")))
    values = spark.range(6_000).select("id", ((F.xxhash64(F.lit(2), "id") % 1_000_000).cast("double") / 7).alias("v"))
    values = values.withColumn("v", F.when(F.col("id") % 3 > 0, F.col("v")).otherwise(F.lit(55.5)))  # a third has one value
    values.write.parquet(f"{tmp_path}/v")
    intervals.write.parquet(f"{tmp_path}/i")
    want = duckdb.sql(
        f"SELECT v.id, count(i.id), sum(i.id) FROM '{tmp_path}/v/*.parquet' v LEFT JOIN '{tmp_path}/i/*.parquet' i ON v >= lo AND (v < hi OR hi IS NULL) GROUP BY 1"
    ).fetchall()
    got = joins.range_lookup(values, "v", intervals, "lo", "hi", {"of": "id"}).groupBy("id").agg(F.count("of"), F.sum("of"))
    assert sorted(map(tuple, got.collect())) == sorted(want) and max(n for _, n, _ in want) > 10


@pytest.mark.parametrize(("dtype", "make"), [("string", lambda i: "k%05d" % i), ("date", lambda i: dt.date(2000, 1, 1) + dt.timedelta(days=i)), ("decimal(10,2)", lambda i: Decimal(i) / 4), ("float", lambda i: i / 8), ("timestamp", lambda i: dt.datetime(2001, 1, 1) + dt.timedelta(seconds=i))])
def test_range_lookup_types(spark, dtype, make):
    rng = random.Random(3)
    bounds = [(n, *sorted(rng.sample(range(300), 2))) for n in range(80)]
    intervals = spark.createDataFrame([(n, make(a), make(b)) for n, a, b in bounds], f"n int, lo {dtype}, hi {dtype}")
    values = spark.createDataFrame([(i, make(i)) for i in range(300)], f"i int, v {dtype}")
    got = joins.range_lookup(values, "v", intervals, "lo", "hi", {"n": "n"}, max_intervals=0).collect()
    want = [(i, n) for i in range(300) for n in ([n for n, a, b in bounds if a <= i < b] or [None])]
    assert sorted([(r.i, r.n) for r in got], key=str) == sorted(want, key=str)


def test_range_lookup_with_many_intervals_gaps_and_outliers(spark):
    tiers = spark.range(1500).select((F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 7).alias("hi"), F.col("id").alias("tier"))
    tiers = tiers.withColumn("hi", F.when(F.col("tier") < 1499, F.col("hi")))
    values = spark.range(20_000).select((F.col("id") - 5).alias("v")).unionAll(spark.createDataFrame([(10**12,), (None,), (-(10**12),)], "v long"))
    hot = spark.range(5_000).select(F.lit(42).cast("long").alias("v"))
    got = joins.range_lookup(values.unionAll(hot), "v", tiers, "lo", "hi", {"tier": "tier"}).collect()
    assert len(got) == 25_003

    def tier(v):
        if v is None or v < 0:
            return None
        return 1499 if v >= 14990 else v // 10 if v % 10 < 7 else None

    assert all(r.tier == tier(r.v) for r in got)


def test_point_in_time_meets_one_version_on_a_boundary(spark, rows):
    current = spark.createDataFrame([(1, "a")], "k int, v string")
    versions = history.snapshot(None, current, "k", ["v"], F.lit(DAY[0]))
    versions = history.snapshot(versions, current.withColumn("v", F.lit("b")), "k", ["v"], F.lit(DAY[2]))
    facts = spark.createDataFrame([(1, d) for d in DAY[1:4]], "fk int, t timestamp_ntz")
    for spread in (None, ["t"]):
        got = joins.point_in_time(facts, versions, {"fk": "k"}, "t", {"v": "v"}, spread_by=spread)
        assert rows(got, F.dayofmonth("t"), "v") == [(2, "a"), (3, "b"), (4, "b")]


def test_unmatched_ignores_null_keys(spark, rows):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(joins.unmatched(child, parent, {"k": "p"})) == [(2,)]


ALL_RANKS = [
    Rank("a_dense", "dense_rank", (Key("a", True, True),)),
    Rank("a_rank_in_g", "rank", (Key("a", True, True),), partition=("g",)),
    Rank("b_pct", "percent_rank", (Key("b"),), places=4),
    Rank("b_decile", "ntile", (Key("b"),)),
    Rank("ba_dense", "dense_rank", (Key("b", True), Key("a", True))),
    Rank("c_row", "row_number", (Key("c", True, True),)),
    Rank("a_seventh_in_g", "ntile", (Key("a"),), partition=("g",), buckets=7),
    Rank("b_rank", "rank", (Key("b", True, True),)),
]


@pytest.mark.parametrize("size, chunks", [(0, 4), (1, 4), (7, 5), (400, 1), (400, 13)])
def test_global_ranks_equal_windows(spark, rows, size, chunks):
    """Without adaptive merging there are many chunks, so runs of equal keys cross them."""
    rng = random.Random(size)
    data = [
        (
            i,
            rng.choice([None, 1, 2, 3, 3, 3]),
            rng.choice([None, float("nan"), -1.5, 0.0, 2.5]),
            rng.choice([None, 0, 1]),
            rng.randint(-50, 50),
        )
        for i in range(size)
    ]
    df = spark.createDataFrame(data, "id int, a bigint, b double, g int, c decimal(12,2)" .replace("decimal(12,2)", "int"))
    df = df.withColumn("c", F.col("c").cast("decimal(12,2)"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(chunks))
    try:
        got = global_ranks(df, ["id"], ALL_RANKS)
        expected = window_ranks(df, ["id"], ALL_RANKS).select(*got.columns)
        assert rows(got) == rows(expected)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_rank_rejects_what_it_cannot_sort(spark):
    df = spark.createDataFrame([(1, {"x": 1})], "id int, s map<string, int>")
    with pytest.raises(TypeError):
        global_ranks(df, ["id"], [Rank("r", "rank", (Key("s"),))])
    with pytest.raises(ValueError):
        Rank("r", "median", (Key("s"),))


@pytest.mark.parametrize("margin, accuracy", [(0.002, 10_000), (0.2, 10_000), (0.0, 2)])
def test_group_medians_equal_builtin(spark, rows, monkeypatch, margin, accuracy):
    """With a usual and a wide bracket, and with one that misses the middle."""
    monkeypatch.setattr(ranking, "MEDIAN_MARGIN", margin)
    monkeypatch.setattr(ranking, "MEDIAN_ACCURACY", accuracy)
    rng = random.Random(3)
    data = [(i, rng.choice("pqr") if i % 10 else "one", rng.choice([None, *range(90)])) for i in range(301)]
    data += [(400 + i, "hot", 5 if i % 3 else i) for i in range(60)]
    data += [(500, "pair", 1), (501, "pair", 4), (502, "single", 9), (999, "empty", None), (998, None, 1)]
    df = spark.createDataFrame(data, "id int, g string, v bigint")
    expected = rows(df.groupBy("g").agg(F.median("v")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert rows(group_medians(df, ["g"], ["v"], ["id"])) == expected
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_change_from_previous_skips_gaps(spark, rows):
    df = spark.createDataFrame([(2001, 5), (2003, 9)], "y int, n int")
    assert rows(change_from_previous(df, "y", ["n"])) == [(2001, 5, None), (2003, 9, 5)]


def test_calendar_end_is_exclusive(spark, rows):
    calendar = date_dimension(spark, dt.date(2000, 1, 1), dt.date(2030, 12, 31), unknown_member=True)
    assert calendar.count() == 11322 + 1
    assert rows(calendar.agg(F.min("date_sk"), F.max("date_sk"))) == [(-1, 20301230)]
    first = calendar.filter("date_sk = 20230101").first()
    assert (first["day_of_week"], first["week_of_year"], first["is_weekend"], first["is_weekday"]) == (0, 52, True, False)
    assert (first["month_name"], first["month_name_short"], first["day_name"]) == ("January", "Jan", "Sunday")


def test_newest_row_does_not_depend_on_the_order_of_the_input(spark, rows):
    from tierwise.functions.keys import document_hash
    from tierwise.plans import bronze, silver

    lines = [
        '{"id": 1, "title": "a", "production_companies": [{"id": 9, "name": "One"}, {"id": 9, "name": "Two"}]}',
        '{"id": 1, "title": "b", "production_companies": [{"id": 9, "name": "Three"}]}',
    ]
    picks = set()
    for order in (lines, lines[::-1]):
        df = spark.createDataFrame([(1, x, "u", DAY[0], "batch") for x in order], "movie_id bigint, t string, source_url string, ingested_at timestamp_ntz, batch_id string")
        raw = df.coalesce(1).withColumn("raw_data", F.parse_json("t")).drop("t")
        from tierwise.sources.documents import land_upsert

        newest = bronze.bronze_movies_raw(raw)
        companies = silver.silver_production_companies(newest, F.lit(DAY[0]))
        landed = land_upsert(None, raw).select(document_hash(F.col("raw_data")))
        picks.add((rows(newest, "row_hash")[0], rows(companies, "company_name")[0], rows(landed)[0]))
    assert len(picks) == 1
    twice = spark.createDataFrame([(1, lines[0], "u", DAY[0], "batch")], "movie_id bigint, t string, source_url string, ingested_at timestamp_ntz, batch_id string")
    companies = silver.silver_production_companies(bronze.bronze_movies_raw(twice.withColumn("raw_data", F.parse_json("t")).drop("t")), F.lit(DAY[0]))
    assert rows(companies, "company_name") == [("One",)]


def test_new_columns_are_kept_and_lost_ones_refused(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B", 5)], "k int, v string, extra int")
    assert rows(merge.merge_upsert(old, new, ["k"])) == [(1, "a", None), (2, "B", 5)]
    assert rows(merge.replace_children(old, new, ["k"])) == [(1, "a", None), (2, "B", 5)]
    with pytest.raises(ValueError, match="lack"):
        merge.merge_upsert(new, old, ["k"])
    table = history.snapshot(None, old, "k", ["v"], F.lit(DAY[0]))
    table = history.snapshot(table, new, "k", ["v"], F.lit(DAY[1]))
    assert rows(table, "k", "v", "extra") == [(1, "a", None), (2, "B", 5), (2, "b", None)]


def test_second_snapshot_at_one_moment_changes_the_version(spark, rows):
    states = [spark.createDataFrame([(1, v)], "k int, v string") for v in "abc"]
    table = history.snapshot(None, states[0], "k", ["v"], F.lit(DAY[0]))
    for state in states[1:]:
        table = history.snapshot(table, state, "k", ["v"], F.lit(DAY[1]))
    assert rows(table, "v", F.dayofmonth("valid_from"), F.dayofmonth("valid_to")) == [("a", 1, 2), ("c", 2, None)]
    assert table.select("scd_id").distinct().count() == 2


def test_incremental_aggregates_rebuild_whole_groups(spark, rows):
    source = spark.createDataFrame([(k, DAY[d]) for k, d in ((1, 0), (1, 3), (2, 0))], "k int, t timestamp_ntz")
    build = lambda df: df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("t"))
    target = build(source.filter(F.col("t") < DAY[1]))
    fresh = merge.incremental(build, source, "t", target, "t", ["k"], lookback_days=0, group_by=["k"])
    assert rows(fresh, "k", "n") == [(1, 2), (2, 1)]


def test_groups_are_rebuilt_in_a_stated_number_of_partitions(spark):
    """Merged by their compressed bytes, all rows of this size would be joined and rebuilt in one task."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        source = spark.range(300_001).select((F.col("id") % 1000).alias("k"), F.lit(DAY[0]).alias("t"))
        places = []

        def build(df):
            places.append(df.withColumn("p", F.spark_partition_id()))
            return df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("t"))

        target = build(source)
        fresh = merge.incremental(build, source, "t", target, "t", ["k"], lookback_days=0, group_by=["k"])
        assert fresh.count() == 1000 and fresh.agg(F.sum("n")).first()[0] == 300_001
        assert places[-1].select("p").distinct().count() == 4
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_median_of_the_null_group(spark, rows):
    data = spark.createDataFrame([(g, i, float(v)) for i, (g, v) in enumerate([("a", 1), ("a", 3), (None, 5), (None, 9), (None, 7)])], "g string, i int, v double")
    from tierwise.operators.ranking import group_medians

    assert rows(group_medians(data, ["g"], ["v"], ["i"]), "g", "v") == [("a", 2.0), (None, 7.0)]


def test_return_on_a_tiny_cost_does_not_overflow(spark):
    from tierwise.functions.measures import PERCENT, return_pct, rounded_mean

    huge = spark.createDataFrame([(1, 5 * 10**10), (1, 10**12)], "cost bigint, revenue bigint")
    mean = huge.select(return_pct(F.col("revenue"), F.col("cost")).alias("r")).agg(rounded_mean(F.col("r"), 2, dtype=PERCENT)).first()[0]
    assert float(mean) == pytest.approx(5.25e13, rel=1e-6)


def test_ranks_by_date_time_text_and_flag(spark, rows):
    data = [(i, d, t, x, f) for i, (d, t, x, f) in enumerate([
        (dt.date(2020, 1, 1), dt.datetime(2020, 1, 1, 5), "ab", True), (dt.date(1960, 1, 1), dt.datetime(1960, 1, 1), "abc", False),
        (None, None, None, None), (dt.date(2020, 1, 1), dt.datetime(2020, 1, 1, 4), "", True), (dt.date(2021, 1, 1), None, "é", None), (None, None, "b", False),
    ])]
    df = spark.createDataFrame(data, "id int, d date, t timestamp_ntz, x string, f boolean")
    ranks = [Rank(f"{c}{down}{last}", kind, (Key(c, down, last), Key("x", not down)), buckets=3)
             for c in "dtxf" for down in (False, True) for last, kind in ((False, "dense_rank"), (True, "row_number"))]
    got = global_ranks(df, ["id"], ranks)
    names = [r.name for r in ranks]
    assert rows(got, "id", *names) == rows(window_ranks(df, ["id"], ranks), "id", *names)


def test_chunks_hold_no_more_rows_in_larger_tables(spark, rows, monkeypatch):
    """The chunks that tasks sort are as many as the rows need, and ranks run on from one to the next."""
    assert [ranking._chunks(n) for n in (0, 300_001, 10**8, 10**9)] == [2, 4, 200, 500]
    monkeypatch.setattr(ranking, "CHUNK_ROWS", 7)
    stored, cut = [], ranking.cut_lineage
    monkeypatch.setattr(ranking, "cut_lineage", lambda df: stored.append(cut(df)) or stored[-1])
    df = spark.createDataFrame([(i, i * 7 % 10) for i in range(60)], "id long, v long")
    ranks = [Rank("r", "rank", (Key("v"),)), Rank("d", "dense_rank", (Key("v"),)), Rank("n", "row_number", (Key("v"),))]
    assert rows(global_ranks(df, ["id"], ranks)) == rows(window_ranks(df, ["id"], ranks).drop("v"))
    numbered = next(t for t in stored if "_chunk" in t.columns)
    assert 5 < numbered.select("_chunk").distinct().count() <= 9


def test_medians_leave_rows_where_they_are(spark, monkeypatch):
    """Few groups of many rows are not shuffled by group to meet their bounds."""
    plans, join = [], ranking._null_safe_join
    monkeypatch.setattr(ranking, "_null_safe_join", lambda *a: plans.append(plan(out := join(*a))) or out)
    df = spark.range(20_000).selectExpr("id", "id % 3 AS g", "CAST(hash(id) AS DECIMAL(18,2)) AS v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        assert group_medians(df, ["g"], ["v"], ["id"]).count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]


MIRRORED = [
    Rank("a_up", "ntile", (Key("a"),)), Rank("a_down", "dense_rank", (Key("a", True, True),)), Rank("a_down_null", "dense_rank", (Key("a", True),)),
    Rank("b_up", "percent_rank", (Key("b"),), ("g",), places=4), Rank("b_down", "dense_rank", (Key("b", True),), ("g",)),
    Rank("ab_down", "dense_rank", (Key("a", True), Key("b", True, True))), Rank("ab_up", "dense_rank", (Key("a", False, True), Key("b"))),
    Rank("c_down", "row_number", (Key("c", True),)), Rank("c_up", "dense_rank", (Key("c"),)), Rank("c_up_null", "dense_rank", (Key("c", False, True),)),
]


@pytest.mark.parametrize("with_null", [True, False])
def test_dense_ranks_are_read_off_the_order_from_the_other_end(spark, rows, monkeypatch, with_null):
    orders, _ = ranking._placed_orders(MIRRORED)
    assert len(orders) == 4 and len({(r.partition, r.order) for r in MIRRORED}) == 10
    monkeypatch.setattr(ranking, "CHUNK_ROWS", 40)
    rng = random.Random(3)
    none = [None] if with_null else []
    data = [(i, rng.choice([*none, 1, 2, 3, 3]), rng.choice([*none, float("nan"), -1.5, 0.0, 2.5]), rng.choice([None, 0, 1]), rng.randint(0, 9)) for i in range(150)]
    df = spark.createDataFrame(data, "id int, a bigint, b double, g int, c int")
    got = global_ranks(df, ["id"], MIRRORED)
    assert rows(got) == rows(window_ranks(df, ["id"], MIRRORED).select(*got.columns))
