"""SimHash fingerprints and components against plain computations."""

import itertools
import random

import xxhash
from pyspark.sql import functions as F

from tierwise.llm import near_dedup
from tierwise.llm.components import components

SCHEMA = "doc_id long, text string"


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, max_bits=4):
    prints = {fingerprint(t) for _, t in rows}
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= max_bits and find(a) != find(b):
            root[find(b)] = find(a)
    least = {}
    for i, t in rows:
        if i is not None:
            least[find(fingerprint(t))] = min(i, least.get(find(fingerprint(t)), i))
    return sorted(((i, fingerprint(t), least.get(find(fingerprint(t)))) for i, t in rows), key=repr)


def got(spark, rows):
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    return sorted(((r.id, r.fp & (2**64 - 1), r.component_id) for r in found.collect()), key=repr)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for i in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 60, 200]))]
        for j in range(rng.choice([1, 2, 12])):
            copy = list(base)
            if j % 3 == 1:
                copy[rng.randrange(len(copy))] = "X"
            rows.append((len(rows) + 1, (" \t" if j % 2 else " ").join(copy)))
    return rows


def test_components_equal_all_pairs(spark):
    rows = corpus() + [(900, None), (901, ""), (902, " \x0b\n "), (903, "One"), (903, "One"), (None, "ONE"), (None, "é É")]
    assert got(spark, rows) == expected(rows)


def test_dense_group_needs_no_pair_of_every_member(spark):
    rng = random.Random(5)
    prints = {sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) ^ 0x0F0F123456789ABC for _ in range(300)}
    far = {rng.getrandbits(64) for _ in range(300)}
    chain = [0xAAAA5555AAAA5555]
    for i in range(8):
        chain.append(chain[-1] ^ (0b1111 << (4 * i)))
    nodes = sorted(prints | far | set(chain))
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in nodes]
    found = near_dedup.links(spark.createDataFrame(signed, "fp long"))
    roots = {r.node & (2**64 - 1): r.root for r in found.collect()}
    group = {p: roots.get(p, p) for p in nodes}
    for a, b in itertools.combinations(nodes, 2):
        if (a ^ b).bit_count() <= 4:
            assert group[a] == group[b]
    assert len({group[p] for p in prints}) == 1 and len({group[p] for p in chain}) == 1
    assert not {group[p] for p in prints} & {group[p] for p in chain}


def test_any_close_pair_shares_a_table():
    rng = random.Random(1)
    for distinct in (1, 1000, 10**6, 10**10):
        masks = near_dedup.block_tables(distinct)
        for _ in range(300):
            differ = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(differ & m == 0 for m in masks)


def test_components_of_a_path_and_of_no_links(spark):
    path = spark.range(50).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(path).collect()} == {0}
    assert components(path.where("a < 0")).count() == 0


def test_keep_one_keeps_columns_and_one_of_a_group(spark):
    text = " ".join("w%d" % i for i in range(100))
    rows = [(7, text, "a"), (3, text.upper(), "b"), (3, text.upper(), "b"), (9, "other words stand here", "c"), (None, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key string")
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.row_key) for r in kept.where("doc_id is not null").collect()) == [(3, "b"), (9, "c")]
    assert kept.where("doc_id is null").count() == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.keep_one(empty).count() == 0
