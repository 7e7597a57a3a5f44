"""The rule ensemble: held-out accuracy, the compiled column, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import quality
from tierwise.llm.queries import QUERIES


@pytest.fixture(scope="module")
def trained(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, quality.train(docs, labels)


def test_held_out_accuracy(spark, trained):
    docs, labels, _ = trained
    scored = QUERIES["op4_quality"](spark, "/root/testdata/sf0.01")
    assert scored.count() == docs.count()
    held = scored.where("held_out").join(labels, "doc_id")
    right = held.where("predicted = quality").count() / held.count()
    good = held.where("quality = 1")
    assert right >= 0.95 and good.where("predicted = 1").count() >= 0.99 * good.count()


def test_labels_of_held_out_rows_are_not_read(spark, trained):
    docs, labels, model = trained
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, flipped).rules == model.rules


def test_column_equals_the_rules(spark, trained):
    docs, _, model = trained
    values = quality.statistics(F.col("text"))
    rows = docs.select(*[values[f].alias(f) for f in model.features], model.column(values).alias("p")).limit(100).collect()
    x = np.array([list(r)[:-1] for r in rows])
    total = np.full(len(x), model.base)
    for weight, rule in model.rules:
        total += weight * quality._holds(x, rule)
    assert [r.p for r in rows] == pytest.approx(1 / (1 + np.exp(-total)))


def test_lasso_drops_useless_columns():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 2, (600, 12)).astype(float)
    y = (z[:, 0] + z[:, 1] > 1).astype(float)
    _, w = quality._lasso(z, y, 0.03)
    assert (w[:2] > 0.5).all() and np.count_nonzero(w) <= 5


def test_odd_rows(spark, trained):
    _, _, model = trained
    rows = [(1, None), (2, ""), (None, " \n\t "), (3, "word " * 200_000), (3, "x"), (3, "x")]
    docs = spark.createDataFrame([(*r, 1.0, "k") for r in rows], "doc_id long, text string, stat_chars double, quality_score string")
    scored = quality.score(docs, model, "s").collect()
    assert len(scored) == 6 and all(r.s is not None and 0 <= r.s <= 1 and not math.isnan(r.s) for r in scored)
    assert {r.stat_chars for r in scored} == {1.0}
    assert scored[0].s == scored[1].s
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert docs.select(quality.held_out(F.col("doc_id")).alias("h")).where("h is null").count() == 0


def test_without_labels_or_one_class(spark, trained):
    docs, labels, _ = trained
    for few in (labels.limit(0), labels.where("quality = 1"), labels.withColumn("quality", F.lit(None).cast("int"))):
        model = quality.train(docs.limit(50), few)
        assert model.rules == [] and 0 < quality.score(docs.limit(1), model, "s").first().s < 1
    assert quality.keep_good(docs.limit(0), model).count() == 0


def test_the_filter_does_not_repeat_the_statistics(spark, trained):
    docs, _, model = trained
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (quality.score(docs, model, "s"), quality.keep_good(docs, model))]
    assert plans[0].count("split(") == plans[1].count("split(") and plans[1].count("regexp_replace(") == 1
