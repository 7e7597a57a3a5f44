"""Frequent lines against counting, and the perfect hash against a dictionary."""

import random

import numpy as np
import pytest

from tierwise.llm import line_dedup

SCHEMA = "doc_id long, text string, line_id string, n_lines int, pos int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected(rows, min_docs, min_chars):
    counts = {}
    for _, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            counts[k] = counts.get(k, 0) + 1
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or counts[key(x)] < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(6)
    common = ["Common line", "  COMMON LINE\t", "Été ", "x", "", " \r", "rare one", "\x0bodd\x0c", " not stripped"]
    rows = []
    for i in range(60):
        lines = [rng.choice(common) if rng.random() < 0.4 else "own %d" % rng.randrange(40) for _ in range(rng.randrange(1, 9))]
        rows.append((i, "\n".join(lines)))
    return [*rows, (100, None), (101, ""), (102, "\n\n"), (None, "Common line\nkeep"), (None, "Common line\nkeep"), (7, "common line\nrare one")]


@pytest.mark.parametrize(("min_docs", "min_chars", "shard_keys", "stream_rows"), [(10, 1, 5, 3), (3, 4, 1000, 1000)])
def test_equals_counting(spark, min_docs, min_chars, shard_keys, stream_rows):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 5, 6) for r in rows], SCHEMA)
    got = line_dedup.drop_frequent_lines(docs, min_docs=min_docs, min_chars=min_chars, shard_keys=shard_keys, stream_rows=stream_rows)
    assert set(got.columns) == {"doc_id", "text", "line_id", "pos", "n_lines", "n_dropped"}
    found = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr)
    assert found == expected(rows, min_docs, min_chars)


def test_shard_finds_every_hash_and_clashing_ones():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    keys[:3] = keys[3]
    prints, counts = np.arange(20_000) % 2**32, rng.integers(1, 10**6, 20_000)
    row = line_dedup.build_shard(keys, prints, counts)
    assert (line_dedup.Shard(row).lookup(keys, prints) == counts).all()
    assert len(row["bits"]) * 8 < 6 * len(keys) and len(row["counts"]) == 4 * (len(keys) - 4)
    assert line_dedup.Shard(line_dedup.build_shard(keys[:0], prints[:0], counts[:0])).lookup(keys[:5], prints[:5]).sum() == 0


def test_empty_table(spark):
    assert line_dedup.drop_frequent_lines(spark.createDataFrame([], SCHEMA)).count() == 0
