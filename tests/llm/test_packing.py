"""Packing: the plan against the best packing of small instances, the pieces against the tokenizer itself."""

import collections
import functools
import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tierwise.llm import packing
from tierwise.llm.vocabularies import ByteVocabulary, vocabulary_path

SCHEMA = "doc_id long, text string, piece string, chunk int"


def fewest(sizes, capacity):
    """The least number of bins, by search over all contents of the bin of the longest piece."""

    @functools.cache
    def solve(left):
        if not left:
            return 0
        rest, best = left[:-1], len(left)
        for n in range(len(rest) + 1):
            for chosen in set(itertools.combinations(range(len(rest)), n)):
                if left[-1] + sum(rest[i] for i in chosen) <= capacity:
                    best = min(best, 1 + solve(tuple(x for i, x in enumerate(rest) if i not in chosen)))
        return best

    return solve(tuple(sorted(sizes)))


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - s)
    return sorted(rooms)


def held(patterns):
    out = collections.Counter()
    for times, content in patterns:
        for s, m in content:
            out[s] += times * m
    return out


def test_reduction_keeps_the_best_packing():
    rng = random.Random(4)
    fixed_any = triples = 0
    for _ in range(400):
        capacity = rng.choice([10, 12, 20, 30])
        low = rng.choice([1, 2, capacity // 4, capacity // 3])
        sizes = [rng.randint(low, capacity) for _ in range(rng.randint(1, 8))]
        fixed, left = packing.reduce_instance(collections.Counter(sizes), capacity)
        assert held(fixed) + collections.Counter(left) == collections.Counter(sizes)
        assert all(sum(s * m for s, m in content) <= capacity for _, content in fixed)
        rest = list(collections.Counter(left).elements())
        assert sum(t for t, _ in fixed) + fewest(rest, capacity) == fewest(sizes, capacity), sizes
        fixed_any += bool(fixed)
        triples += any(sum(m for _, m in content) == 3 for _, content in fixed)
    assert fixed_any > 200 and triples > 3


def test_best_fit_of_counts_is_best_fit_of_pieces():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([10, 64, 100])
        sizes = [rng.randint(1, rng.choice([3, capacity // 2, capacity])) for _ in range(rng.randint(0, 120))]
        patterns = packing.best_fit(collections.Counter(sizes), capacity)
        assert held(patterns) == collections.Counter(sizes)
        rooms = sorted(capacity - sum(s * m for s, m in c) for t, c in patterns for _ in range(t))
        assert rooms == plain_best_fit(sizes, capacity)


def test_plan_grows_with_the_capacity_alone():
    rng = random.Random(9)
    some = {s: rng.randint(1, 50) for s in range(1, 1024)}
    many = {s: n * 10**9 + rng.randint(0, 10**6) for s, n in some.items()}
    small, large = packing.plan(some), packing.plan(many)
    assert held(large) == collections.Counter(many)
    assert sum(len(c) for _, c in large) < 50_000 and sum(len(c) for _, c in small) < 50_000
    for counts, patterns in ((some, small), (many, large)):
        total, bound = sum(t for t, _ in patterns), -(-sum(s * n for s, n in counts.items()) // 1024)
        assert bound <= total <= sum(t for t, _ in packing.best_fit(counts))


def check(rows, texts, capacity=1024):
    """Pieces cover every document as its tokens say, and sequences are gapless."""
    own = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    want, got = collections.Counter(), collections.Counter()
    for i, text in texts:
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        n = -(-len(ids) // capacity)
        end = len(ids)
        for k in range(n - 1, -1, -1):
            start = 0 if k == 0 else end - capacity
            want[i, k, start, end - start, zlib.crc32(ids[start:end].tobytes())] += 1
            end = start
    by_sequence = collections.defaultdict(list)
    for r in rows:
        got[r.id, r.piece, r.start, r.length, r.crc] += 1
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in rows)


ODD = [
    (None, None), (1, None), (1, None), (2, ""), (2, ""), (3, "a <|endoftext|> b"), (4, " \n\t  x  " * 700), (5, "é漢字🙂" * 900),
    (6, "word " * 40_000), (7, "a" * 30_000), (8, " " * 30_000), (9, "\x00\x7f￿"),
]


@pytest.mark.parametrize("partitions", [1, 5])
def test_odd_rows(spark, partitions):
    rng = random.Random(3)
    texts = ODD + [(i, " ".join("w%d" % rng.randrange(50) for _ in range(rng.choice([1, 5, 60, 300, 500, 700])))) for i in range(100, 160)]
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts], SCHEMA).repartition(partitions)
    sequences, tokens = check(packing.pack(docs).collect(), texts)
    assert sequences <= 1.1 * tokens / 1024 + 1


def test_other_capacity(spark):
    texts = [(i, "one two three four five six seven eight nine ten " * (i % 7)) for i in range(40)]
    check(packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), capacity=16).collect(), texts, 16)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ranks_and_file_give_the_same_ids():
    tokens = ByteVocabulary(special=True)
    assert tokens.ranks is not None
    rng = random.Random(11)
    letters = "aAbeé'sStm ll  \n\t\r 　.,;!-_0129漢字🙂ا́\x00<|>endoftext"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert tokens.ids(text) == tokens.plain.encode(text, add_special_tokens=False).ids
    assert b"".join(tokens.bytes[i] for i in tokens.ids("naïve 漢字 🙂\n")) == "naïve 漢字 🙂\n".encode()


def test_query_on_whole_documents(spark, sf_dir):
    rows = queries()["op13_best_fit"](spark, sf_dir).withColumnsRenamed({"doc_id": "id", "ids_crc32": "crc"}).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sequences, tokens = check(rows, texts)
    assert -(-tokens // 1024) <= sequences <= 1.01 * tokens / 1024 + 1
