import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tierwise.functions.cleaning import variant_field
from tierwise.operators.audit import RunLog, load_window, models_of_latest_run, require_rows, run_log, table_counts
from tierwise.operators.merge import merge_upsert
from tierwise.sources import documents, seeds
from tierwise.sources.shared_folder import scratch_path, shared_folder
from tierwise.sources.tables import Conflict, State, TableStore, namespace
from tierwise.streaming.upsert import upsert_stream

LINES = [
    '{"id": 1, "title": "One", "extra": {"deep": [1, 2]}}',
    '{"id": 2.0, "title": null}',
    '{"title": "no id"}',
    '{"id": 0}',
    "not json",
    '{"id": 3, "id": 4}',
    "   ",
]
NOW = dt.datetime(2024, 3, 1, 10)


def test_documents_and_rejects_add_up(spark, rows, tmp_path):
    (tmp_path / "docs.jsonl").write_text("\n".join(LINES))
    landed, rejects = documents.parse_documents(documents.read_lines(spark, str(tmp_path)))
    assert rows(landed, "movie_id", variant_field(F.col("raw_data"), "$.title", "string")) == [(1, "One"), (2, None)]
    assert rows(rejects) == [
        ("not json", "malformed"), ('{"id": 0}', "no id"), ('{"id": 3, "id": 4}', "malformed"), ('{"title": "no id"}', "no id"),
    ]


def test_documents_are_parsed_once(spark):
    lines = spark.createDataFrame([(t,) for t in LINES], "value string")
    landed, _ = documents.parse_documents(lines)
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_array_files(spark, rows, tmp_path):
    for name, ids in (("a.json", [1, 2]), ("b.json", [3])):
        (tmp_path / name).write_text(json.dumps([{"id": i, "title": f"t{i}"} for i in ids], indent=1))
    landed, rejects = documents.parse_documents(documents.read_array_files(spark, str(tmp_path)))
    assert [r[0] for r in rows(landed, "movie_id")] == [1, 2, 3] and rejects.isEmpty()


def test_bad_array_files_are_rejected(spark, rows, tmp_path):
    for name, text in (("a.json", '[{"id": 1}, {"x": 2}, 5]'), ("b.json", '[{"id": 2'), ("c.json", '{"id": 3, "deep": {"id": 4}}'), ("d.json", "[]"), ("e.json", "")):
        (tmp_path / name).write_text(text)
    landed, rejects = documents.parse_documents(documents.read_array_files(spark, str(tmp_path)))
    assert [r[0] for r in rows(landed, "movie_id")] == [1]
    got = rows(rejects)
    assert [r[1] for r in got].count("malformed") == 1 and len(got) == 4
    assert any("no array" in r[0] and '"id": 3' in r[0].replace("\\", "") for r in got)


def test_land_upsert_and_snapshot(spark, rows):
    def batch(pairs, day):
        lines = spark.createDataFrame([(json.dumps({"id": i, "v": v}),) for i, v in pairs], "value string")
        docs, _ = documents.parse_documents(lines)
        return documents.stamp_batch(docs, f"b{day}", NOW + dt.timedelta(days=day), "u")

    landed = documents.land_upsert(None, batch([(1, "a"), (2, "b")], 0))
    landed = documents.land_upsert(landed, batch([(2, "B"), (3, "c")], 1))
    value = variant_field(F.col("raw_data"), "$.v", "string")
    assert rows(landed, "movie_id", value, "batch_id") == [(1, "a", "b0"), (2, "B", "b1"), (3, "c", "b1")]
    row = documents.land_snapshot(spark, '[{"id": 1}]', "b", NOW)
    assert row.columns == ["raw_data", "ingested_at", "batch_id"] and row.count() == 1


def test_distinct_listing_keeps_the_first(spark, rows):
    pages = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 5), (2, 2, None)], "page int, place int, id int")
    assert rows(documents.distinct_listing(pages, "id", ["page", "place"])) == [(1, 1, 5), (1, 2, 6)]


def test_seed_types_and_nulls(spark, rows, tmp_path):
    path = tmp_path / "tiers.csv"
    path.write_text("tier_name,low,high\nLOW,0,10\nTOP,10,\n")
    schema = "tier_name string, low bigint, high bigint"
    assert rows(seeds.read_seed(spark, str(path), schema)) == [("LOW", 0, 10), ("TOP", 10, None)]
    path.write_text("tier_name,low,high\nLOW,zero,10\n")
    with pytest.raises(Exception, match="MALFORMED"):
        seeds.read_seed(spark, str(path), schema).collect()


def test_namespace():
    assert namespace("gold") == "GOLD" and namespace(" gold ", "dev") == "DEV_GOLD"
    assert namespace(None, "dev") == "DBT_STAGING"


def test_table_is_rebuilt_from_its_own_rows(spark, store, rows):
    assert store.find("GOLD", "t") is None
    assert store.replace(spark.range(3), "GOLD", "t") == 3
    doubled = store.read("GOLD", "t").select((F.col("id") * 2).alias("id"))
    assert store.replace(doubled, "GOLD", "t") == 3
    assert store.append(spark.range(10, 11), "GOLD", "t") == 1
    assert rows(store.read("GOLD", "t")) == [(0,), (2,), (4,), (10,)]
    assert spark.sql(f"select count(*) from {store.name('gold', 'T')}").first()[0] == 4
    store.replace(spark.range(1).select(F.lit("x").alias("other")), "GOLD", "t")
    assert store.read("GOLD", "t").columns == ["other"]


def test_failed_write_leaves_the_table(spark, store, rows):
    store.replace(spark.range(3), "GOLD", "t")
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        store.replace(broken, "GOLD", "t")
    assert store.read("GOLD", "t").count() == 3


class Session:
    """What the folder rules look at."""

    def __init__(self, setting=None, master="local[2]"):
        self.sparkContext, self.conf, self.master, self.folder = self, self, master, None
        self.setting = setting

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


def test_shared_folder_follows_the_session():
    assert shared_folder(Session("/somewhere/shared")) == "/somewhere/shared"
    assert scratch_path(Session("/somewhere/shared/"), "x").startswith("/somewhere/shared/x-")
    local = Session()
    assert shared_folder(local) == shared_folder(local) == local.folder != None  # noqa: E711
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(master="yarn"))


def test_run_log(spark, store, rows):
    log = RunLog(store)
    log.start(NOW, 3)
    assert rows(store.read(None, "dbt_run_log"), "run_status", "models_total") == [("RUNNING", 3)]
    log.model("a", "SILVER", NOW, listed=False)
    log.model("b", "GOLD", NOW)
    log.model("c", "GOLD", NOW, "skipped")
    log.finish(NOW + dt.timedelta(minutes=1))
    failed = RunLog(store)
    failed.start(NOW + dt.timedelta(hours=1), 1)
    failed.model("b", "GOLD", NOW, "error")
    failed.finish(NOW + dt.timedelta(hours=2))
    columns = ["run_status", "models_total", "models_completed", "models_errored"]
    assert rows(run_log(store), *columns) == [("FAILED", 1, 0, 1), ("SUCCESS", 3, 2, 0)]
    # The log only grows: two events a run.
    assert store.read(None, "dbt_run_log").count() == 4
    models = store.read(None, "dbt_model_log")
    assert rows(models, "model_name", "model_schema") == [("b", "GOLD")]
    assert models_of_latest_run(run_log(store), models).isEmpty()


def test_counts_and_load_window(spark, rows):
    df = spark.createDataFrame([(NOW,), (NOW + dt.timedelta(days=1),)], "t timestamp")
    assert rows(table_counts({"a": df, "b": df.limit(0)})) == [("a", 2), ("b", 0)]
    assert rows(load_window(df, "t"))[0][2] == 2
    with pytest.raises(ValueError, match="empty"):
        require_rows(df.limit(0), "raw")


def test_a_table_outlives_its_session(spark, store, rows):
    store.append(spark.range(3), "GOLD", "t")
    # Another session, or another cluster, knows the root folder only.
    for name in (store.name("GOLD", "t"),):
        spark.sql(f"DROP TABLE {name}")
    later = TableStore(spark.newSession(), store.root, prefix=store.prefix)
    assert later.exists("GOLD", "t")
    assert later.append(spark.range(10, 12), "GOLD", "t") == 2
    assert rows(later.read("GOLD", "t")) == [(0,), (1,), (2,), (10,), (11,)]
    assert rows(store.read("GOLD", "t")) == [(0,), (1,), (2,), (10,), (11,)]
    assert spark.sql(f"select sum(id) from {store.name('GOLD', 't')}").first()[0] == 24


def test_data_without_a_state_is_not_started_over(spark, store):
    spark.range(1).write.parquet(f"{store.folder('GOLD', 't')}/data-1")
    with pytest.raises(ValueError, match="refusing"):
        store.append(spark.range(1), "GOLD", "t")


def test_a_half_written_state_does_not_count(spark, store, tmp_path):
    store.replace(spark.range(2), "GOLD", "t")
    (tmp_path / store.database("GOLD") / "t" / "states" / "000000000001").write_text('{"parts": [')
    assert store.read("GOLD", "t").count() == 2


def test_of_two_writers_one_is_refused_and_appends_go_on(spark, store, rows, monkeypatch):
    store.replace(spark.range(1), "GOLD", "t")
    first, other = store.state("GOLD", "t"), TableStore(spark, store.root, prefix=store.prefix)
    other.append(spark.range(5, 6), "GOLD", "t")
    stale, real = [first], store.state
    monkeypatch.setattr(store, "state", lambda *a: stale.pop() if stale else real(*a))
    with pytest.raises(Conflict):
        store.replace(spark.range(9), "GOLD", "t")
    stale.append(first)
    assert store.append(spark.range(7, 8), "GOLD", "t") == 1
    assert rows(store.read("GOLD", "t")) == [(0,), (5,), (7,)]


def test_an_update_touches_only_the_buckets_of_its_keys(spark, store, rows):
    table = spark.range(200).select("id", F.lit("old").alias("v"))
    store.replace(table, "GOLD", "t", ["id"], buckets=8)
    before = dict(store.state("GOLD", "t").parts)
    assert len(before) == 8
    new = spark.createDataFrame([(3, "new", 1), (1000, "new", 2)], "id long, v string, extra int")
    written = store.update(new, lambda past: merge_upsert(past, new, ["id"]), "GOLD", "t")
    after = dict(store.state("GOLD", "t").parts)
    changed = {b for b in before if before[b] != after[b]}
    assert 1 <= len(changed) <= 2 and 2 <= written < 120
    got = store.read("GOLD", "t")
    assert got.count() == 201 and rows(got.filter("v = 'new'")) == [(3, "new", 1), (1000, "new", 2)]
    assert spark.sql(f"select count(*) from {store.name('GOLD', 't')} where extra is null").first()[0] == 199
    gone = spark.createDataFrame([(3,)], "id long")
    store.update(gone, lambda past: past.join(gone, "id", "left_anti"), "GOLD", "t")
    assert store.append(spark.createDataFrame([(3, "again", None)], "id long, v string, extra int"), "GOLD", "t") == 1
    assert rows(store.read("GOLD", "t").filter("id = 3"), "v") == [("again",)]
    with pytest.raises(ValueError, match="lack"):
        store.append(gone, "GOLD", "t")


def test_stream_upsert_keeps_the_newest_over_several_runs(spark, store, rows, tmp_path):
    folder, schema = str(tmp_path / "in"), "k int, t int, v string"

    def arrive(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        upsert_stream(stream, store, "SILVER", "s", ["k"], "t", str(tmp_path / "log")).awaitTermination()
        return rows(store.read("SILVER", "s"))

    assert arrive([(1, 1, "a"), (1, 3, "c"), (2, 1, "x")]) == [(1, 3, "c"), (2, 1, "x")]
    assert arrive([(1, 2, "late"), (2, 5, "y"), (3, 1, "new")]) == [(1, 3, "c"), (2, 5, "y"), (3, 1, "new")]


def test_a_writer_that_died_stops_nobody(spark, store, rows, tmp_path):
    store.append(spark.range(1), "GOLD", "t")
    states = tmp_path / store.database("GOLD") / "t" / "states"
    (states / "000000000001").write_text("")
    (states / "000000000002").write_text('{"parts": [')
    (states / "_left").write_text("")
    assert store.append(spark.range(5, 6), "GOLD", "t") == 1
    assert store.state("GOLD", "t").version == 3
    store.replace(spark.range(7, 8), "GOLD", "t")
    assert rows(store.read("GOLD", "t")) == [(7,)]
    assert store.state("GOLD", "t").version == 4


def test_a_refused_write_is_no_conflict(spark, store, tmp_path, monkeypatch):
    store.append(spark.range(1), "GOLD", "t")
    states = tmp_path / store.database("GOLD") / "t" / "states"
    kept = {f.name: f.read_bytes() for f in states.iterdir()}
    for f in list(states.iterdir()):
        f.unlink()
    states.rmdir()
    states.write_text("a file where the folder was")  # nothing can be created below it
    state = State(0, spark.range(1).schema, ())
    monkeypatch.setattr(store, "state", lambda *a: state)
    monkeypatch.setattr(store, "_names", lambda *a: list(kept))
    with pytest.raises(Exception) as caught:
        store.append(spark.range(1), "GOLD", "t")
    assert not isinstance(caught.value, Conflict)


def test_appends_give_up_after_many_conflicts(spark, store, monkeypatch):
    store.append(spark.range(1), "GOLD", "t")

    def taken(*_):
        raise Conflict("taken")

    monkeypatch.setattr(store, "_commit", taken)
    with pytest.raises(Conflict):
        store.append(spark.range(1), "GOLD", "t")


def test_rows_worked_out_from_an_older_state_are_refused(spark, store, rows):
    store.replace_tags(spark.range(2), F.lit("open"), [], "GOLD", "t")
    read = store.state("GOLD", "t")
    mine = store.rows("GOLD", "t", read, {"open"})
    store.append(spark.range(7, 10), "GOLD", "t")
    with pytest.raises(Conflict):
        store.replace_tags(mine, F.lit("open"), ["open"], "GOLD", "t", read)
    with pytest.raises(Conflict):
        store.replace_tags(spark.range(1), F.lit("open"), [], "GOLD", "t")
    assert store.read("GOLD", "t").count() == 5
    store.replace(spark.range(4), "GOLD", "b", ["id"], buckets=2)
    read = store.state("GOLD", "b")
    store.append(spark.range(4, 5), "GOLD", "b")
    with pytest.raises(Conflict):
        store.update(spark.range(4), lambda past: past.where("id > 1"), "GOLD", "b", read)
    assert rows(store.read("GOLD", "b")) == [(0,), (1,), (2,), (3,), (4,)]
