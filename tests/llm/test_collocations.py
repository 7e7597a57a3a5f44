"""Phrase mining against counting all phrases in plain Python."""

import collections
import random
import re

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tierwise.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, n int, block long"


def plain(rows, min_count, top, max_words=5, percent=100):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p for p in f if len(p) > 1 and f[p] >= min_count}
        kept = []
        for p in found:
            if any(100 * f[q] >= percent * f[p] and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in found if len(q) > len(p)):
                continue
            score, k = min((1000 * f[p] * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed=2, n=120):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(12)] + ["É", "é", "x y", "A", "a", "'", "🙂"]
    fixed = ["the end of all things", "w1 w1 w1 w1 w1 w1 w1", "one\ttwo  three", "of all"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", " ?! ", "\r"]))
        rows.append((i, "".join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    return [*rows, (900, None, "en"), (901, "", None), (902, " .,; \n", "fr"), (903, "one", "xx"), (3, rows[3][1], rows[3][2]), (None, "the end of all things", "en")]


def got(spark, rows, partitions=3, **options):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(partitions)
    return sorted(map(tuple, co.collocations(docs, **options).collect()))


@pytest.mark.parametrize(("min_count", "top", "max_words", "percent"), [(5, 2000, 5, 100), (3, 7, 3, 100), (4, 50, 5, 60)])
def test_equals_counting_everything(spark, min_count, top, max_words, percent):
    rows = corpus()
    want = plain(rows, min_count, top, max_words, percent)
    assert len(want) > 20
    assert got(spark, rows, min_count=min_count, top=top, max_words=max_words, cover_percent=percent) == want


def test_long_pieces_go_over_blocks_and_groups_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 7)
    monkeypatch.setattr(co, "_TAIL", 14)
    monkeypatch.setattr(co, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(co, "HOT_SHARE", 20)
    rows = corpus(5, 60) + [(950, "again " * 400 + "and " * 3 + ". no, and no", "en"), (951, "the end of all things " * 90, "fr")]
    want = plain(rows, 6, 2000)
    assert any(p.startswith("again again again again again") for _, _, p, *_ in want)
    assert got(spark, rows, min_count=6) == want


def test_shared_codes_are_made_anew(spark, monkeypatch):
    tried = []
    usual = co._vocabulary

    def vocabulary(docs, attempt):
        from pyspark.sql import functions as F

        tried.append(attempt)
        found = usual(docs, attempt)
        return found.withColumn("twice", F.lit(True)) if attempt == 0 else found

    monkeypatch.setattr(co, "_vocabulary", vocabulary)
    rows = corpus(8, 40)
    assert got(spark, rows, min_count=4) == plain(rows, 4, 2000) and tried == [0, 1]


def test_large_products_are_exact(spark):
    rows = [(10**15 // 7, 10**15 // 3, [10**9 + 7], [10**9 + 9]), (123_456_789_012, 999_999_999_999_999, [10**12, 7 * 10**11], [3 * 10**11, 10**12 - 1])]
    found = spark.createDataFrame(rows, "a long, n long, pre array<long>, suf array<long>").select(co._score("n").alias("cut")).collect()
    for (a, n, pre, suf), r in zip(rows, found, strict=True):
        score, k = min((1000 * a * n // (pre[k] * suf[len(suf) - 1 - k]), k) for k in range(len(pre)))
        assert (r.cut.score, r.cut.k) == (score, k + 1)


def test_empty_table_and_no_candidates(spark):
    assert got(spark, []) == [] and got(spark, [(1, None, None), (2, "a b c", "en")]) == []


def test_a_very_long_text(spark):
    text = "alpha beta gamma, " * 40_000
    found = got(spark, [(1, text, "en")], 1)
    assert found == [("en", 1, "alpha beta gamma", 40_000, 40_000, 40_000, 120_000, 3000)]


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(oracle_sql()["op12_collocations"])
    rows = queries()["op12_collocations"](spark, sf_dir)
    assert rows.columns == want.columns
    assert sorted(map(tuple, rows.collect())) == sorted(want.fetchall())
