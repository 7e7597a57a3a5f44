"""Repeated passages against all windows of all documents."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tierwise.llm import common, substring_dedup

SCHEMA = "doc_id long, text string, id string, opened int"


def expected(rows, window):
    first = {}
    order = [(2**63 - 1 if i is None else i, i, t) for i, t in rows]
    for key, _, text in order:
        words = (text or "").encode().split()
        for a in range(len(words) - window + 1):
            w = tuple(words[a : a + window])
            first[w] = min(key, first.get(w, key))
    out = []
    for key, i, text in order:
        words = (text or "").encode().split()
        gone = set()
        for a in range(len(words) - window + 1):
            if first[tuple(words[a : a + window])] < key:
                gone |= set(range(a, a + window))
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = ["word%d" % i for i in range(60)]
    passages = [[rng.choice(words) for _ in range(rng.choice([49, 50, 51, 120]))] for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [rng.choice(words) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "EDIT%d" % rng.randrange(3)
            parts += p + [rng.choice(words) for _ in range(rng.randrange(5))]
        rows.append((rng.randrange(10**6), rng.choice([" ", "\n", "\t \r", "\x0b\x0c"]).join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_windows(spark, seed):
    rows = corpus(seed)
    same = " ".join("z%d" % (i % 7) for i in range(200))
    rows += [(None, rows[0][1]), (5, None), (6, ""), (7, "  one word"), (8, same), (8, same), (9, same + " tail"), (None, same)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(docs).collect()), key=repr)
    assert got == expected(rows, 50)


def test_other_windows(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(docs, window=20, k=5).collect()), key=repr)
    assert got == expected(rows, 20)


def test_spans_verify_at_their_source(spark):
    rows = corpus(3)
    texts = {i: t.split() for i, t in rows}
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    for r in substring_dedup.repeated_spans(docs).collect():
        assert r.source < r.id and r.length >= 50
        passage = " ".join(texts[r.id][r.start : r.start + r.length])
        assert f" {passage} " in f" {' '.join(texts[r.source])} "


def test_nonbranching_paths_are_compacted(spark):
    """A copied passage is one path however long it is, and ends where a branch leaves it."""
    long = ["w%d" % i for i in range(3000)]
    half = long[:1500] + ["x%d" % i for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(long), "", 0), (2, " ".join(["head", *long]), "", 0), (2, " ".join(["head", *long]), "", 0)], SCHEMA)
    spans = {(r.id, r.start, r.length, r.source) for r in substring_dedup.repeated_spans(docs).collect()}
    assert max(n for _, _, n, _ in spans) > 2900 and len([s for s in spans if s[2] > 50]) < 4
    docs = docs.unionByName(spark.createDataFrame([(3, " ".join(half), "", 0)], SCHEMA))
    spans = [(r.id, r.start, r.length) for r in substring_dedup.repeated_spans(docs).distinct().collect() if r.length > 50]
    assert max(n for i, _, n in spans if i == 3) <= 1500
    assert 1200 < max(n for i, _, n in spans if i == 2) <= 1700


def test_words_are_compared_at_their_source(spark, monkeypatch):
    """Equal hashes of different words remove nothing."""
    honest = substring_dedup.repeated_spans
    wrong = F.when(F.col("high").isNotNull(), F.col("high") + 1).alias("high")
    monkeypatch.setattr(substring_dedup, "repeated_spans", lambda *a: honest(*a).where("high is not null").withColumn("high", wrong))
    text = " ".join("w%d" % i for i in range(300))
    docs = spark.createDataFrame([(1, text, "", 0), (2, text, "", 0)], SCHEMA)
    assert [r.n_removed for r in substring_dedup.remove_repeats(docs).collect()] == [0, 0]
    monkeypatch.setattr(substring_dedup, "repeated_spans", honest)
    assert sorted(r.n_removed for r in substring_dedup.remove_repeats(docs).collect()) == [0, 300]


def test_stored_tables_go_when_they_are_read(spark, tmp_path, monkeypatch):
    """Only the tables that the spans are read from stay on the disk."""
    docs = spark.createDataFrame([(*r, "x", 1) for r in corpus(5)], SCHEMA)
    monkeypatch.setattr(common, "scratch_path", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    spans = substring_dedup.repeated_spans(docs)
    left = sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert spans.count() > 0 and left == ["compacted_paths", "places"]


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_word_hashes_do_not_depend_on_the_parts():
    texts = [b"one two  three", b"", b" two " + b"x" * 500 + b" one", b"three"]
    whole, firsts = substring_dedup.word_hashes(texts)
    assert len(whole) == 7 and firsts.tolist() == [0, 3, 3, 6, 7]
    assert whole[1] == whole[3] and whole[0] == whole[5] and whole[2] == whole[6] and len(set(whole.tolist())) == 4
    for size in (1, 7, 100):
        assert (substring_dedup.word_hashes(texts, size)[0] == whole).all()
