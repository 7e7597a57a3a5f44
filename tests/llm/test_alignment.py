"""Alignment of two tokenizers against plain Python over the tokenizers themselves."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tierwise.llm import alignment
from tierwise.llm.vocabularies import ByteVocabulary, vocabulary_path

SCHEMA = "doc_id long, text string, chunk long, a string, groups int"


def plain(rows):
    """Every document's figures, from the bytes of single tokens."""
    own = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    letters = {c: bytes([b]) for c, b in __import__("tierwise.llm.vocabularies", fromlist=["x"])._byte_of_letter().items()}

    def b_bytes(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    links, shown = [], []
    counts = collections.Counter()
    for _, text in rows:
        a = own.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        ab = [b"".join(letters[c] for c in own.id_to_token(i)) for i in a]
        bb = [b_bytes(i) for i in b]
        if b"".join(ab) != (" " + (text or "")).encode() or b"".join(bb) != (" " + (text or "")).encode():
            a, b, ab, bb = [], [], [], []
        ends_a, ends_b = (list(np.cumsum([len(x) for x in s])) for s in (ab, bb))
        both = sorted(set(ends_a) & set(ends_b))
        mine = [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in both]
        counts.update(mine)
        groups, i, j = [], 0, 0
        for e in both:
            p, q = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        links.append(mine)
        shown.append((len(a), len(b), ";".join(groups)))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), mine, (n_a, n_b, groups) in zip(rows, links, shown, strict=True):
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        out.append((i, n_a, n_b, len(mine), len(mine), sum(counts[x] == most[x[1]] for x in mine), sum(counts[x] for x in mine), digest))
    return sorted(out, key=repr), counts, links


ODD = [
    (None, None), (1, None), (2, ""), (3, " "), (4, "  two  spaces \n\n\tand tabs "), (5, "<s> </s> <|endoftext|> <unk> <0x41>"), (6, "é́ ▁ 漢字🙂  　"),
    (7, "\x00\x01�"), (8, "word and " * 3000), (8, "word and " * 3000), (9, "a"), (9, "a"), (None, "a b"), (10, "x" * 5000), (11, "ﬁ ½ Ⅷ ①"), (12, "\r\n\r\n"),
]


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = "the of Überraschung naïveté token-ization 12345 don't 漢字 éléphant xyzzy antidisestablishmentarianism // == {}".split()
    return ODD + [(100 + i, rng.choice(["", " "]).join(rng.choice(words) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randrange(80)))) for i in range(n)]


def got(spark, rows, partitions=3, **options):
    docs = spark.createDataFrame([(*r, 5, "x", 1) for r in rows], SCHEMA).repartition(partitions)
    return sorted(map(tuple, alignment.align(docs, **options).collect()), key=repr)


def test_equals_plain(spark):
    rows = corpus()
    want, counts, _ = plain(rows)
    assert sum(r[1] for r in want) > 10_000 and max(counts.values()) >= 6000
    assert got(spark, rows) == want


@pytest.mark.parametrize(("docs", "entries"), [(8, 10**6), (64, 40)])
def test_many_chunks_hot_pairs_and_bitmaps(spark, monkeypatch, docs, entries):
    for name, value in (("CHUNK_DOCS", docs), ("CHUNK_ENTRIES", entries), ("BROADCAST_ROWS", 0), ("HOT_SHARE", 20), ("SALTS", 3)):
        monkeypatch.setattr(alignment, name, value)
    rows = corpus(7, 150)
    assert got(spark, rows, 2) == plain(rows)[0]


def test_pair_counts_over_arrays_and_bitmaps(spark):
    rows = corpus(3, 40) + [(1000 + i, "of the " * (i % 5 + 1)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = alignment.scan(docs)
    postings = found.where("a is not null").select("chunk", "a", "b", "maps")
    assert postings.selectExpr("max(octet_length(maps[0]))").first()[0] == alignment.BITMAP_BYTES
    want, counts, links = plain(rows)
    documents = collections.Counter(x for mine in links for x in set(mine))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    pairs = alignment.pair_counts(postings).collect()
    assert {(r.a, r.b): (r.documents, r.links, r.best) for r in pairs} == {p: (documents[p], n, n == most[p[1]]) for p, n in counts.items()}
    assert got(spark, rows, 1) == want


def test_containers_come_back():
    rng = random.Random(2)
    runs = [sorted(rng.sample(range(alignment.CHUNK_DOCS), n)) for n in (0, 1, 2047, 2048, 3, 2500, 0, 32768, 7)]
    ends = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
    for first in (0, 2):
        maps = alignment.containers(ends, np.array([d for r in runs for d in r], dtype=np.int64)).slice(first)
        owner, docs = alignment.opened(maps)
        assert [docs[owner == i].tolist() for i in range(len(maps))] == runs[first:]
        assert max(len(x) for x in maps.to_pylist()) == alignment.BITMAP_BYTES


def test_groups_as_text(spark):
    rows = [(1, "Hello wonderful wörld"), (2, "")]
    text, digest = got(spark, rows, 1, digest=False), got(spark, rows, 1)
    assert text[1][-1] == "" and hashlib.sha256(text[0][-1].encode()).hexdigest() == digest[0][-1]
    a = [int(x) for g in text[0][-1].split(";") for x in g.split("|")[0].split(",")]
    assert a == ByteVocabulary().ids(" " + rows[0][1])


def test_empty_table(spark):
    assert got(spark, []) == []


def test_query_on_whole_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = queries()["op11_alignment"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)[0]
