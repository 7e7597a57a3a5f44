"""The pipeline, stage by stage, against plain Python on the smallest data."""

import collections
import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from tierwise.llm import decontaminate, line_dedup, near_dedup, quality


def test_numbered_queries_are_entered():
    numbers = {n[2:].split("_")[0] for n in queries() if n.startswith("op")}
    assert numbers == {str(i) for i in range(1, 14)} and "pipeline" in queries()


def by_quality(docs, spark, sf_dir):
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model, "s").collect()
    return {r.doc_id: r.text for r in scored if r.s >= 0.3}


def by_lines(docs, *_):
    rows = {r.doc_id: r.text.split("\n") for r in docs.collect()}
    keys = {i: [line_dedup.line_keys(x.encode())[0] for x in lines] for i, lines in rows.items()}
    counts = collections.Counter(k for ks in keys.values() for k in set(ks))
    return {i: "\n".join(x for x, k in zip(lines, keys[i], strict=True) if not k or counts[k] < 10) for i, lines in rows.items()}


def by_fingerprint(docs, *_):
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: near_dedup.simhash(t.encode()) & (2**64 - 1) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: t for i, t in texts.items() if find(i) == i}


def by_benchmark(docs, spark, sf_dir):
    cut = [p for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() for p in decontaminate.pieces_of(decontaminate.normal(r.text.encode()))]
    rows = {r.doc_id: r.text for r in docs.collect()}
    return {i: t for i, t in rows.items() if not any(p in decontaminate.normal(t.encode()) for p in cut)}


PLAIN = dict(zip([name for name, _ in corpus_pipeline.STAGES], [by_quality, by_lines, by_fingerprint, by_benchmark], strict=False))


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name in PLAIN:
            assert out.columns == columns
            assert {r.doc_id: r.text for r in out.collect()} == PLAIN[name](docs, spark, sf_dir), name
            assert out.where(F.col("n_chars") != F.length("text")).count() == 0
            docs = out
    assert out.count() == docs.count() and 0 < out.where("taken > 0").count()
    sums = out.agg(F.sum("taken"), F.sum("size")).first()
    assert sums[0] == pytest.approx(1.5 * sums[1], rel=0.01)
    again = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 0), (2, "word " * 50_000, "en", "s", 250_000)]])
def test_odd_tables(spark, tmp_path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() <= max(0, len(rows) - 1)
