"""Exact groups and the hash index."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tierwise.llm import exact_dedup

SCHEMA = "doc_id long, text string, h string, tag int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        rest = list(ids)
        rest.remove(keep)
        for i, kept in [(keep, True), *[(i, False) for i in rest]]:
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(2)
    texts = ["Text %d é" % i for i in range(120)]
    rows = [(i, rng.choice(texts).swapcase() if rng.random() < 0.3 else rng.choice(texts)) for i in range(400)]
    rows += [(1000 + i, "Hot copy") for i in range(300)] + [(5000, None), (5001, ""), (5002, " "), (5003, "É"), (5004, "é")]
    return [*rows, rows[-1], (None, "hot COPY"), (None, None), (None, "alone"), (None, "alone"), (6000, "x" * 300_000)]


@pytest.mark.parametrize("key_bits", [64, 3])
def test_groups(spark, key_bits):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    got = exact_dedup.exact_groups(docs, bucket_entries=20, key_bits=key_bits)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_directory_splits_overfull_buckets_only(spark):
    crowded = spark.range(300).select(F.col("id").alias("h"))
    spread = spark.range(100).select(F.shiftleft(F.col("id") * 2_654_435_761 % 2**32, 32).alias("h"))
    entries = crowded.unionAll(spread).distinct()
    total = entries.count()
    buckets = exact_dedup.directory(entries, 50).collect()
    assert sum(b.n for b in buckets) == total and max(b.n for b in buckets) <= 50
    assert max(b.depth for b in buckets) > 50 and min(b.depth for b in buckets) < 8


def test_index_files_hold_whole_buckets(spark):
    entries = spark.range(1000).select(F.xxhash64("id").alias("h"))
    index = exact_dedup.write_index(entries, 100)
    files = index.select("bucket", F.input_file_name().alias("file")).distinct().groupBy("bucket").count()
    assert index.count() == 1000 and index.select("bucket").distinct().count() >= 10
    assert files.where("count > 1").count() == 0


def test_empty_table(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a", "x", 1)], SCHEMA)
    text = exact_dedup.exact_groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text


def test_owners_decide(spark):
    """What the owners of the buckets say is the result: links of one text meet there, and bytes that differ are refused."""
    link = "h long, sha binary, n long, top struct<id: long, tag: long>, text string, same_bytes long"
    rows = [(7, b"a", 2, (1, 1), None, 0), (7, b"a", 1, (9, 4), None, 0), (7, b"a", 0, None, "one", 3), (7, b"b", 1, (3, 3), None, 0), (-1, b"c", 1, (None, 8), None, 0)]
    index = exact_dedup.write_index(spark.createDataFrame(rows, link), 1, decide=exact_dedup._chained)
    assert sorted((r.h, bytes(r.sha), r.n, tuple(r.top)) for r in index.collect()) == [(-1, b"c", 1, (None, 8)), (7, b"a", 3, (9, 4)), (7, b"b", 1, (3, 3))]
    for wrong in ((7, b"a", 0, None, "two", 1), (7, b"a", 0, None, "one", 1)):
        with pytest.raises(Exception, match="share a hash"):
            exact_dedup.write_index(spark.createDataFrame([*rows, wrong], link), 1, decide=exact_dedup._chained)


def test_the_result_is_read_from_the_index(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a", "x", 1), (2, "A", "x", 1)], SCHEMA)
    right = exact_dedup._chained
    monkeypatch.setattr(exact_dedup, "_chained", lambda owned: right(owned).withColumn("n", F.col("n") + 5))
    assert {r.group_size for r in exact_dedup.exact_groups(docs).collect()} == {7}
