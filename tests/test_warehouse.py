"""The walk-through: two movies, a revenue update, history, and clean-up."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tierwise.operators.history import as_of_rows
from tierwise.plans import gold, marts, silver
from tierwise.plans.warehouse import LAYERS, Warehouse
from tierwise.sources.documents import land_snapshot, parse_documents, stamp_batch

T0, T1 = dt.datetime(2022, 9, 5, 8, 30), dt.datetime(2022, 9, 6, 7, 15)
GENRES = [{"id": 28, "name": "Action"}, {"id": 12, "name": " Adventure "}, {"id": 18, "name": "Drama"}]
KNOWN = {
    "id": 501, "title": "Harbour Lights", "release_date": "2021-10-08", "budget": 4000000,
    "revenue": 9000000, "runtime": 97, "status": "Released", "vote_average": 6.4, "vote_count": 310,
    "popularity": 12.25, "original_language": "en", "imdb_id": "tt0000501", "genres": GENRES[:2],
    "production_companies": [{"id": 71, "name": "Lionsgate", "origin_country": "CA"}],
}
#: First without a revenue; sent again a day later with one, and with other companies.
PENDING = {
    "id": 502, "title": "The Long Canal", "release_date": "2021-02-19", "budget": 50000000,
    "revenue": 0, "runtime": 121, "status": "Released", "vote_average": 5.5, "vote_count": 120,
    "popularity": 33.0, "original_language": "en", "imdb_id": "tt0000502", "genres": GENRES[2:],
    "production_companies": [{"id": 72, "name": "Miramax", "origin_country": "US"}],
}
UPDATED = {
    **PENDING, "revenue": 61000000, "vote_average": 5.9, "vote_count": 480, "popularity": 35.5,
    # The first company must not stay primary, and the second entry of one company must not win.
    "production_companies": [{"id": 73, "name": "A24", "origin_country": ""}, {"id": 73, "name": "A24 again"}],
}


def batch(spark, docs, number, at):
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return stamp_batch(parse_documents(lines)[0], f"load-{number}", at, "url")


@pytest.fixture(scope="module")
def demo(spark, tmp_path_factory):
    from tierwise.sources.tables import TableStore

    store = TableStore(spark, str(tmp_path_factory.mktemp("demo")), prefix="demo_")
    warehouse = Warehouse(store)
    warehouse.load_documents(batch(spark, [KNOWN, PENDING], 1, T0))
    warehouse.load_genres(land_snapshot(spark, json.dumps(GENRES), "g", T0))
    warehouse.run(T0)
    warehouse.snapshot(T0)
    before = {r["movie_id"]: r.asDict() for r in warehouse.table("fact_movies").collect()}
    warehouse.load_documents(batch(spark, [UPDATED], 2, T1))
    warehouse.run(T1)
    warehouse.snapshot(T1)
    return warehouse, before


def test_facts_before_and_after_the_update(demo):
    warehouse, before = demo
    assert (before[501]["profit_usd"], str(before[501]["roi_pct"])) == (5000000, "125.00")
    assert before[501]["profitability_flag"] == "PROFITABLE" and before[501]["budget_tier"] == "LOW"
    assert (before[501]["primary_genre_id"], before[501]["date_sk"]) == (12, 20211008)
    assert (before[502]["revenue_usd"], before[502]["profitability_flag"]) == (None, "UNKNOWN")
    after = {r["movie_id"]: r for r in warehouse.table("fact_movies").collect()}
    assert len(after) == 2
    assert (after[502]["revenue_usd"], after[502]["primary_company_id"]) == (61000000, 73)
    assert after[501]["title"] == "Harbour Lights"


def test_bridge_and_company_rows(demo, rows):
    warehouse, _ = demo
    bridge = warehouse.table("silver_movie_companies")
    assert rows(bridge, "movie_id", "company_id", "company_name", "company_position", "is_primary_company") == [
        (501, 71, "Lionsgate", 0, True), (502, 73, "A24", 0, True),
    ]
    dim = warehouse.table("dim_production_companies")
    columns = ["company_id", "company_name", "origin_country", "region", "studio_tier"]
    # A merge keeps companies that no document names any more.
    assert rows(dim, *columns) == [
        (71, "Lionsgate", "CA", "NORTH_AMERICA", "MINI_MAJOR"), (72, "Miramax", "US", "NORTH_AMERICA", "MINI_MAJOR"),
        (73, "A24", "UNKNOWN", "OTHER", "INDIE"),
    ]


def test_history_has_the_expected_versions(demo, rows):
    warehouse, _ = demo
    versions = warehouse.table("snap_silver_movies").filter("movie_id = 502")
    got = rows(versions, "revenue_usd", "vote_average", "dbt_valid_from", "dbt_valid_to")
    assert got == [(61000000, 5.9, T1, None), (None, 5.5, T0, T1)]
    first = warehouse.table("snap_silver_movies").filter("movie_id = 501")
    assert rows(first, "dbt_valid_to") == [(None,)]
    moment = F.lit(dt.datetime(2022, 9, 6)).cast("timestamp_ntz")
    assert rows(as_of_rows(versions, moment, "dbt_"), "revenue_usd") == [(None,)]
    assert warehouse.table("snap_dim_genres").count() == 3


def test_closed_versions_are_not_written_again(demo, rows):
    warehouse, _ = demo
    parts = warehouse.store.state(None, "snap_silver_movies").parts
    closed = [p for tag, p in parts if tag == "closed"]
    warehouse.snapshot(T1)
    again = warehouse.store.state(None, "snap_silver_movies").parts
    assert closed and [p for tag, p in again if tag == "closed"] == closed
    assert [p for tag, p in again if tag == "open"] != [p for tag, p in parts if tag == "open"]
    assert warehouse.table("snap_silver_movies").count() == 3


def test_marts_and_user_sql(spark, demo):
    warehouse, _ = demo
    year = warehouse.table("kpi_yearly_trends").first()
    assert (year["release_year"], year["total_movies_released"], float(year["total_revenue_millions"])) == (2021, 2, 70.0)
    genres = {r["genre_name"]: r for r in warehouse.table("kpi_genre_performance").collect()}
    assert set(genres) == {"ACTION", "ADVENTURE", "DRAMA"}
    assert (genres["ACTION"]["total_movies"], genres["ACTION"]["roi_rank"]) == (0, 3)
    top = spark.sql(
        "SELECT title, revenue_usd / 1000000 AS m FROM demo_GOLD.KPI_TOP_MOVIES "
        "WHERE revenue_rank_all_time <= 10 ORDER BY revenue_rank_all_time"
    ).collect()
    assert [r["title"] for r in top] == ["The Long Canal", "Harbour Lights"]
    raw = spark.sql("SELECT count(DISTINCT movie_id) FROM demo_BRONZE.raw_movies WHERE batch_id = 'load-2'")
    assert raw.first()[0] == 1


def test_another_session_goes_on_where_this_one_stopped(spark, demo, rows):
    from tierwise.sources.tables import TableStore

    warehouse, _ = demo
    later = Warehouse(TableStore(spark.newSession(), warehouse.store.root, prefix="demo_"))
    assert set(later.tables()) == set(LAYERS)
    assert rows(later.table("snap_silver_movies"), "movie_id") == [(501,), (502,), (502,)]


def test_checks_and_stored_failures(demo):
    warehouse, _ = demo
    summary = {(r["table"], r["check"]): r for r in warehouse.test(T1)}
    assert len(summary) == 116
    failed = {k for k, r in summary.items() if r["status"] != "pass"}
    # Bounds meant for a full load.
    assert failed == {
        ("silver_genres", "row_count"), ("dim_genres", "row_count"), ("kpi_genre_performance", "row_count"),
        ("kpi_yearly_trends", "row_count"), ("kpi_top_movies", "row_count"),
    }
    stored = warehouse.store.read("AUDIT", "dim_genres__failures").first()
    assert (stored["n_rows"], stored["failed_checks"]) == (3, ["row_count"])


def test_a_failed_model_skips_only_its_readers(demo, monkeypatch):
    from tierwise.operators.audit import run_log

    warehouse, _ = demo
    monkeypatch.setattr(gold, "dim_genres", lambda *a: 1 / 0)
    models = ["dim_dates", "dim_genres", "dim_production_companies", "fact_movies", "kpi_yearly_trends"]
    with pytest.raises(ZeroDivisionError):
        warehouse.run(T1, models=models)
    last = run_log(warehouse.store).filter("run_status = 'FAILED'").collect()
    assert [(r["models_total"], r["models_completed"], r["models_errored"]) for r in last] == [(5, 2, 1)]


def test_seed_files_arrive_with_every_run(spark, store, tmp_path, rows):
    (tmp_path / "seeds").mkdir()
    seed = tmp_path / "seeds" / "budget_tiers.csv"
    warehouse = Warehouse(store, seeds=str(tmp_path / "seeds"), unknown_members=True, buckets=2)
    warehouse.load_documents(batch(spark, [KNOWN, {**PENDING, "genres": [], "production_companies": []}], 1, T0))
    warehouse.load_genres(land_snapshot(spark, json.dumps(GENRES), "g", T0))
    for middle, tiers in ((10**7, ["LARGE", "SMALL"]), (10**3, ["LARGE", "LARGE"])):
        seed.write_text(f"tier_name,min_budget_usd,max_budget_usd,tier_rank\nSMALL,0,{middle},1\nLARGE,{middle},,2\n")
        warehouse.run(T0)
        assert sorted(r[0] for r in rows(warehouse.table("fact_movies"), "budget_tier")) == tiers
    # Unmatched facts meet the unknown member of every dimension.
    fact = warehouse.table("fact_movies").filter("movie_id = 502")
    for table, key in (("dim_genres", "genre_sk"), ("dim_production_companies", "company_sk")):
        assert fact.join(warehouse.table(table), key).count() == 1
    assert warehouse.table("dim_dates").filter("date_sk = -1").count() == 1


def test_facts_with_more_tiers_than_are_broadcast(spark):
    tiers = spark.range(1001).select(F.concat(F.lit("T"), "id").alias("tier_name"), (F.col("id") * 5000).alias("min_budget_usd"), ((F.col("id") + 1) * 5000).alias("max_budget_usd"))
    bronze, at = batch(spark, [KNOWN, PENDING], 1, T0), F.lit(T0)
    genres = gold.dim_genres(silver.silver_genres(land_snapshot(spark, json.dumps(GENRES), "g", T0), at), at)
    companies = gold.dim_production_companies(silver.silver_production_companies(bronze, at), at)
    fact = gold.fact_movies(
        silver.silver_movies(bronze, at), silver.silver_movie_genres(bronze, at), silver.silver_movie_companies(bronze, at),
        gold.dim_dates(spark), genres, companies, tiers, at,
    )
    assert {r["movie_id"]: r["budget_tier"] for r in fact.collect()} == {501: "T800", 502: None}


def test_purge_and_full_refresh(spark, demo):
    warehouse, _ = demo
    warehouse.purge(spark.createDataFrame([(501,)], "movie_id bigint"))
    warehouse.run(T1, full_refresh=True)
    for name in ("raw_movies", "silver_movies", "fact_movies", "silver_movie_companies", "snap_silver_movies"):
        assert warehouse.table(name).filter("movie_id = 501").isEmpty(), name
    assert set(warehouse.tables()) == set(LAYERS)


def test_appended_documents_leave_the_newest_in_bronze(spark, store, rows):
    warehouse = Warehouse(store)
    for docs, number, at in (([KNOWN, PENDING], 1, T0), ([UPDATED], 2, T1)):
        warehouse.load_documents(batch(spark, docs, number, at), append=True)
    assert warehouse.table("raw_movies").count() == 3
    warehouse.build("bronze_movies_raw", T1)
    newest = rows(warehouse.table("bronze_movies_raw"), "movie_id", "batch_id")
    assert newest == [(501, "load-1"), (502, "load-2")]


EDGE = [
    {"id": 1, "budget": 1000000, "revenue": 1000000, "release_date": "", "status": None, "vote_count": 100},
    {"id": 2, "budget": 999999, "release_date": "1999-12-31", "status": "Released", "vote_count": 99},
    {"id": 3, "status": "Rumored", "vote_count": 500},
    {"id": 4, "revenue": 5, "release_date": "2030-12-31", "vote_count": 500, "genres": [], "adult": 1},
    {"id": 5, "budget": 2, "revenue": 1, "release_date": "2010-06-01", "vote_count": 500, "runtime": 89.6,
     "genres": [{"id": 28, "name": "Action"}, {"id": 28, "name": "Action"}, {"name": "x"}]},
    {"id": 6, "title": "  ", "vote_count": 500, "vote_average": 5, "popularity": 1, "release_date": "2012-06-01"},
]


@pytest.fixture(scope="module")
def edge(spark):
    bronze = batch(spark, EDGE, 1, T0)
    at = F.lit(T0)
    movies = silver.silver_movies(bronze, at)
    genres = gold.dim_genres(
        silver.silver_genres(land_snapshot(spark, json.dumps(GENRES), "g", T0), at), at
    )
    companies = gold.dim_production_companies(silver.silver_production_companies(bronze, at), at)
    fact = gold.fact_movies(
        movies, silver.silver_movie_genres(bronze, at), silver.silver_movie_companies(bronze, at),
        gold.dim_dates(spark), genres, companies, gold.budget_tiers(spark), at,
    )
    return movies, fact, genres, companies


def test_edge_facts(edge, rows):
    movies, fact, _, _ = edge
    got = rows(fact, "movie_id", "date_sk", "budget_tier", "profitability_flag", "genre_sk")
    unknown = [r[:4] for r in got if r[4] == "UNKNOWN"]
    assert unknown == [
        (1, -1, "LOW", "BREAK_EVEN"), (2, -1, "MICRO", "UNKNOWN"), (4, -1, None, "UNKNOWN"), (6, 20120601, None, "UNKNOWN"),
    ]
    assert [r[:4] for r in got if r[4] != "UNKNOWN"] == [(5, 20100601, "MICRO", "LOSS")]
    assert rows(movies.filter("movie_id in (5, 6)"), "title", "runtime_minutes", "release_season") == [
        (None, 90, "SUMMER"), (None, None, "SUMMER"),
    ]
    assert rows(movies.filter("movie_id = 4"), "is_adult_content") == [(True,)]


def test_edge_marts(edge, rows):
    _, fact, genres, companies = edge
    top = marts.kpi_top_movies(fact, genres, companies, F.lit(T0))
    # Movie 5 has no rating: unknown ratings rank first and sit in the lowest decile.
    got = rows(top, "movie_id", "rating_rank_all_time", "rating_decile", "revenue_rank_all_time", "roi_rank_all_time")
    assert [r[0] for r in got] == [1, 4, 5, 6]
    by_id = {r[0]: r[1:] for r in got}
    assert by_id[6][0] == 3 and by_id[6][1] == 4 and by_id[1][2] == 1 and by_id[1][3] == 1
    yearly = rows(marts.kpi_yearly_trends(fact, F.lit(T0)), "release_year", "yoy_movie_count_change", "revenue_rank")
    # Years without revenue rank first; 2010 follows 1999 in the list.
    assert yearly == [(1999, None, 1), (2010, 0, 3), (2012, 0, 1), (2030, 0, 3)]


def test_fanout_totals_equal_the_literal_pairs(spark):
    schema = (
        "movie_id bigint, genre_sk string, release_year int, budget_usd bigint, revenue_usd bigint, "
        "profit_usd bigint, roi_pct decimal(38,2), vote_average double, vote_count bigint, "
        "popularity_score double, runtime_minutes bigint, _gold_loaded_at timestamp_ntz"
    )
    data = [
        (1, "g", 2020, 10**6, 10**8, 99 * 10**6, None, 7.0, 10, 10.0, 90, T0),
        (2, "g", 2020, 10**6, 2 * 10**8, 199 * 10**6, None, 8.0, 10, 10.0, 90, T0),
        (3, "g", 2010, None, None, None, None, 9.0, 10, 15.0, 90, T0),
        (4, "h", 2010, None, None, None, None, 9.0, 10, 15.0, 90, T0),
    ]
    fact = spark.createDataFrame(data, schema)
    genres = spark.createDataFrame(
        [("g", 1, "G", "X", True), ("h", 2, "H", "X", False), ("i", 3, "I", "X", False)],
        "genre_sk string, genre_id int, genre_name string, genre_group string, is_blockbuster_genre boolean",
    )
    columns = ["total_revenue_millions", "total_popularity", "rating_stddev", "total_movies", "median_revenue_millions"]

    def measured(fanout):
        mart = marts.kpi_genre_performance(fact, genres, 2024, fanout=fanout)
        return {r["genre_name"]: [None if v is None else float(v) for v in (r[c] for c in columns)] for r in mart.collect()}

    assert measured(False) == {
        "G": [300.0, 35.0, 1.0, 3.0, 150.0], "H": [None, 15.0, None, 1.0, None], "I": [None, None, None, 0.0, None],
    }
    assert measured(True) == {
        "G": [900.0, 70.0, 0.89, 3.0, 150.0], "H": [None, 15.0, None, 1.0, None], "I": [None, None, None, 0.0, None],
    }


def test_of_two_snapshots_from_one_state_the_second_is_refused(spark, store, monkeypatch):
    from tierwise.functions.dates import moment
    from tierwise.plans import snapshots
    from tierwise.sources.tables import Conflict

    name, warehouse = "snap_dim_genres", Warehouse(store)
    current = spark.range(3).select(*[F.col("id").alias(c) if c == "genre_id" else F.lit("a").alias(c) for c in snapshots.GENRE_COLUMNS])
    warehouse._snapshot(name, current, moment(T0))
    read, real = store.state(None, name), store.state
    warehouse._snapshot(name, current.withColumn("genre_name", F.lit("b")), moment(T1))
    stale = [read]
    monkeypatch.setattr(store, "state", lambda *a: stale.pop() if stale else real(*a))
    with pytest.raises(Conflict):
        warehouse._snapshot(name, current.withColumn("genre_name", F.lit("c")), moment(T1 + dt.timedelta(days=1)))
    assert store.read(None, name).count() == 6 and store.read(None, name).where("genre_name = 'c'").isEmpty()


def _documents(spark, n, batch="b"):
    lines = spark.range(n).select(F.format_string('{"id": %d, "title": "t%d", "deep": {"a": [%d]}}', F.col("id") + 1, "id", "id").alias("value"))
    return stamp_batch(parse_documents(lines)[0], batch, T0, "url")


def _parquet_columns(path):
    import glob

    import pyarrow.parquet as pq

    return {c.path for f in glob.glob(f"{path}/**/*.parquet", recursive=True) for c in pq.ParquetFile(f).schema}


def test_documents_are_written_whole(spark, store):
    """Columns for each path of a document cost more to write and to put together than they save."""
    from tierwise.sources.shared_folder import cut_lineage

    name = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(name)
    cut = cut_lineage(_documents(spark, 50))
    assert [f for f in cut.inputFiles() if any("typed_value" in c for c in _parquet_columns(f.removeprefix("file://")))] == []
    store.replace(_documents(spark, 50), "BRONZE", "raw", ["movie_id"], 4)
    columns = _parquet_columns(store.folder("BRONZE", "raw"))
    assert "raw_data.value" in columns and not any("typed_value" in c for c in columns)
    assert spark.conf.get(name) == before
    assert cut.selectExpr("sum(variant_get(raw_data, '$.deep.a[0]', 'int'))").first()[0] == sum(range(50))


def test_setting_is_put_back_after_writes_side_by_side(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from tierwise.sources.shared_folder import write_parquet

    name = "spark.sql.variant.inferShreddingSchema"
    spark.conf.set(name, "true")
    try:
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda i: write_parquet(_documents(spark, 20 + i), f"{tmp_path}/{i}"), range(4)))
        with pytest.raises(Exception):
            write_parquet(_documents(spark, 5), f"{tmp_path}/0")
        assert spark.conf.get(name) == "true"
        assert not any("typed_value" in c for c in _parquet_columns(str(tmp_path)))
    finally:
        spark.conf.unset(name)


def test_documents_meet_and_are_hashed_only_where_keys_repeat(spark, rows):
    from tierwise.plans import bronze
    from tierwise.sources.documents import newest_documents
    from tierwise.sources.shared_folder import cut_lineage

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    once = cut_lineage(_documents(spark, 30))
    assert "Exchange" not in plan(bronze.bronze_movies_raw(once)) and "md5" not in plan(newest_documents(once))
    later = once.withColumn("ingested_at", F.lit(T1).cast("timestamp")).withColumn("batch_id", F.lit("c"))
    resent = cut_lineage(once.withColumn("ingested_at", F.col("ingested_at").cast("timestamp")).unionByName(later))
    assert "md5" not in plan(newest_documents(resent))
    assert rows(newest_documents(resent).groupBy("batch_id").count()) == [("c", 30)]
    twice = cut_lineage(once.unionByName(once))
    assert "md5" in plan(newest_documents(twice)) and newest_documents(twice).count() == 30


def test_few_tags_are_written_by_many_tasks(spark, store):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        wide = spark.range(0, 4000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
        store.replace(wide, "SILVER", "wide", ["id"], 2)
        rows_of = store.read("SILVER", "wide")
        assert len(rows_of.inputFiles()) >= 4 and rows_of.distinct().count() == 4000
        assert {t for t, _ in store.state("SILVER", "wide").parts} == {"0", "1"}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_documents_are_hashed_when_they_are_loaded(spark, store, rows):
    """A run takes the hash from the raw table, and works it out for documents that were stored without one."""
    from tierwise.functions.keys import document_hash
    from tierwise.plans import bronze

    documents = batch(spark, [KNOWN, PENDING], 1, T0)
    store.append(documents.where("movie_id = 501"), "BRONZE", "raw_movies", ["movie_id"], 2)
    warehouse = Warehouse(store, buckets=2)
    warehouse.load_documents(documents.where("movie_id = 502"), append=True)
    stored = {r["movie_id"]: r["row_hash"] for r in warehouse.table("raw_movies").collect()}
    made = {r["movie_id"]: r["h"] for r in documents.select("movie_id", document_hash(F.col("raw_data")).alias("h")).collect()}
    assert stored == {501: None, 502: made[502]}
    assert {r["movie_id"]: r["row_hash"] for r in bronze.bronze_movies_raw(warehouse.table("raw_movies")).collect()} == made
    warehouse.load_documents(batch(spark, [KNOWN, UPDATED], 2, T1))
    assert warehouse.table("raw_movies").where("row_hash IS NULL").isEmpty()
    warehouse.build("bronze_movies_raw", T1)
    again = bronze.bronze_movies_raw(warehouse.table("raw_movies").drop("row_hash"))
    assert rows(warehouse.table("bronze_movies_raw"), "movie_id", "row_hash") == rows(again, "movie_id", "row_hash")


def test_picked_rows_are_worked_out_once_for_a_merge(spark, store, monkeypatch):
    """A merge reads the incoming rows three times; companies are picked out of all documents."""
    warehouse = Warehouse(store, buckets=2)
    warehouse.load_documents(batch(spark, [KNOWN, PENDING], 1, T0))
    for now in (T0, T1):
        warehouse.build("bronze_movies_raw", now)
        plans, update = [], store.update
        monkeypatch.setattr(store, "update", lambda touched, *a: plans.append(touched._jdf.queryExecution().optimizedPlan().toString()) or update(touched, *a))
        warehouse.build("silver_production_companies", now)
        monkeypatch.setattr(store, "update", update)
        warehouse.load_documents(batch(spark, [UPDATED], 2, T1))
    assert len(plans) == 1 and "Window" not in plans[0] and "variant_get" not in plans[0]
    assert {r["company_id"] for r in warehouse.table("silver_production_companies").collect()} == {71, 72, 73}
