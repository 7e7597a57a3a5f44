"""Targets, epochs and the fractional draw."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tierwise.llm import mixing

SCHEMA = "doc_id long, text string, source string, before int, chunk int"


def corpus():
    rng = random.Random(9)
    sources = ["hot"] * 5 + ["b", "a", "\U0001f600", "￿", None, "tiny"]
    rows = [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(0, 90))), rng.choice(sources)) for i in range(700)]
    return [*rows, (None, "a b c", "hot"), (None, "a b c", "hot"), (3, None, "a"), (800, "", "empty"), (801, "1 2 3", "tiny"), (801, "1 2 3", "tiny")]


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held, goal = {}, share * sum(sizes.values())
    while True:
        rest = {s: (goal - sum(held.values())) * w[s] / sum(w[x] for x in sizes if x not in held) for s in sizes if s not in held}
        over = [s for s in rest if rest[s] >= most * sizes[s]]
        if not over:
            return held | rest
        held |= {s: most * sizes[s] for s in over}


def test_mix(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(4)
    got = mixing.mix(docs).collect()
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = targets(dict(sizes))
    assert len(got) == len(rows)
    by_source = collections.defaultdict(list)
    named = {(i, len((t or "").split())): s for i, t, s in rows}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_source[named[(r.id, r.size)]].append(r)
    for source, found in by_source.items():
        size = sizes[source]
        assert {r.source_size for r in found} == {size}
        assert found[0].target == pytest.approx(want[source])
        assert sum(r.taken for r in found) == int(found[0].target)
        if size:
            whole = int(found[0].target // size)
            assert sum(r.size * whole < r.taken < r.size * (whole + 1) for r in found) <= 1
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_quality_raises_the_chance(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "good words here").otherwise("#### $$$$ %%%%").alias("text"), F.lit("s").alias("source"))
    half = mixing.mix(docs, share=0.3).withColumn("clean", F.col("id") % 2 == 0).groupBy("clean").agg(F.sum("taken")).collect()
    taken = {r[0]: r[1] for r in half}
    assert taken[True] > 5 * taken[False]


def test_running_totals_over_many_chunks(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("v")).repartition(6)
    got = mixing.running_totals(rows, ["g"], [F.col("k").asc()], "v", "totals").collect()
    sums = collections.Counter()
    for r in sorted(got, key=lambda r: r.k):
        assert r.before == sums[r.g]
        sums[r.g] += r.v


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
