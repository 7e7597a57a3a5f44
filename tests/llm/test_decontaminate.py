"""Benchmark passages against approximate matching of every piece."""

import random

import numpy as np
from pyspark.sql import functions as F

from tierwise.llm import decontaminate as dc

SCHEMA = "doc_id long, text string, item string, row_key int"
WORDS = ["".join(random.Random(i).choice("abcdefghé") for _ in range(2 + i % 7)) for i in range(300)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        i = rng.randrange(len(chars))
        chars[i] = rng.choice(["", "z", chars[i] + "q"])
    return "".join(chars)


def least_edits(pattern, text):
    """Edits of the best place of a pattern in a text, over all places."""
    row = np.zeros(len(text) + 1, dtype=int)
    data = np.frombuffer(text, dtype=np.uint8)
    shift = np.arange(len(text) + 1)
    for i, c in enumerate(pattern):
        moved = row + 1
        moved[1:] = np.minimum(moved[1:], row[:-1] + (data != c))
        moved[0] = i + 1
        row = np.minimum.accumulate(moved - shift) + shift
    return row.min()


def corpus():
    rng = random.Random(12)
    items = [(i, prose(rng, rng.choice([8, 20, 45, 90]))) for i in range(25)]
    rows = []
    for i in range(120):
        text = prose(rng, rng.randrange(1, 60))
        if i % 3:
            passage = rng.choice(items)[1]
            if i % 3 == 2:
                passage = edited(rng, passage, rng.randrange(1, 14))
            if i % 4 == 0:
                passage = passage[: len(passage) // 2].upper().replace(" ", " \n ")
            text += " " + passage + " " + prose(rng, rng.randrange(20))
        rows.append((i, text))
    return rows, items


def test_finds_every_piece_within_its_budget(spark):
    rows, items = corpus()
    want = set()
    for i, text in rows:
        t = dc.normal(text.encode())
        for j, item in items:
            x = dc.normal(item.encode())
            if any(least_edits(p, t) <= int(len(p) * dc.EDITS) for p in dc.pieces_of(x)) if len(x) >= dc.MIN_BYTES else b" " + x + b" " in b" " + t + b" ":
                want.add((i, j))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(want) > 50
    for block in (dc.BLOCK_BYTES, 500):
        found = dc.contaminated(docs, bench, block_bytes=block).collect()
        assert {(r.id, r.item) for r in found} == want and len(found) == len(want)
    texts = dict(rows)
    for r in found:
        if r.edits == 0:
            assert dc.normal(texts[r.id][r.start : r.end].encode()) in dc.normal(dict(items)[r.item].encode())


def spread_edits(rng, text, n):
    """The text with n substitutions that leave as few whole q-grams as they can, in runs of any length."""
    chars = list(text)
    for i in range(n):
        at = min(len(chars) - 1, (i + 1) * len(chars) // (n + 1) + rng.randrange(-4, 5))
        chars[at] = "#"
    return "".join(chars)


def test_pieces_of_many_lengths_do_not_hide_each_other(spark):
    """Exactly the allowed edits, and one more, with items of all lengths in one benchmark and in each of their own."""
    rng = random.Random(21)
    items = [(n, "a" + "".join(rng.choice("abcdefghijklm") for _ in range(size - 2)) + "z") for n, size in enumerate([32, 33, 40, 47, 60, 75, 90, 118, 120, 200, 31, 12, 3])]
    rows, want = [], set()
    for n, item in items:
        size = min(len(item), dc.PIECE)
        for extra in (0, 1):
            for _ in range(6):
                passage = spread_edits(rng, item[:size], (int(size * dc.EDITS) if size >= dc.MIN_BYTES else 0) + extra)
                rows.append((len(rows), prose(rng, 30) + " " + passage + " " + prose(rng, 30)))
    for i, text in rows:
        t = dc.normal(text.encode())
        for n, item in items:
            x = dc.normal(item.encode())
            exact = b" " + x + b" " in b" " + t + b" "
            if exact if len(x) < dc.MIN_BYTES else any(least_edits(p, t) <= int(len(p) * dc.EDITS) for p in dc.pieces_of(x)):
                want.add((i, n))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(2)
    assert len(want) >= 6 * len(items) and {n for _, n in want} == {n for n, _ in items}
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (dc.BLOCK_BYTES, 1):
        found = dc.contaminated(docs, bench, block_bytes=block).collect()
        assert {(r.id, r.item) for r in found} == want and len(found) == len(want)
    kept = dc.drop_contaminated(docs, bench, block_bytes=150)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in rows} - {i for i, _ in want})
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[1]


def test_short_items_match_whole_words_once(spark):
    docs = spark.createDataFrame([(1, "  Yes,\n  PLEASE  do yes, please do", "", 0), (2, "yes, pleased", "", 0), (3, "oyes, please", "", 0), (4, "yes, please", "", 0)], SCHEMA)
    bench = spark.createDataFrame([(5, "yes, please"), (6, " YES,  please "), (7, ""), (8, None)], "item_id long, text string")
    found = {(r.id, r.item): (r.edits, r.start, r.end) for r in dc.contaminated(docs, bench).collect()}
    assert found == {(1, 5): (0, 2, 15), (1, 6): (0, 2, 15), (4, 5): (0, 0, 11), (4, 6): (0, 0, 11)}


CASED = [
    "à côté de l'église, l'élève préféré récitait à haute voix la fable où le chêne défie le très léger roseau éploré",
    "die süßen äpfel fielen über nacht auf die große straße, und müde hörten wir, daß draußen löwenmäulchen blühen",
    "el niño soñó que el pingüino cruzó el océano en un camión pequeño según contó después su tía maría en málaga",
    "ο παππούς τους λέει πως ο δρόμος προς τις όμορφες πόλεις της ελλάδας είναι μακρύς και γεμάτος ήλιους",
    "в чащах юга жил бы цитрус, да но фальшивый экземпляр, съешь ещё этих мягких французских булок да выпей чаю",
    "ŝanĝu ĉiujn ĵaŭdojn, ĥoro ĝojas, źdźbło żółci, příliš žluťoučký kůň úpěl ďábelské ódy, zażółć gęślą jaźń",
]


def test_capitals_of_any_script(spark):
    before = "İſẞ ﬁ K, %s: " % WORDS[0]  # their folded forms have other lengths
    rows, want = [], set()
    for i, item in enumerate(CASED):
        for text in (item.upper(), item.upper().replace(" ", " \n "), before + item.upper() + " ẞİ", item.title(), item[:40].upper()):
            rows.append((len(rows), text, "x", 1))
            # upper() is the test's own folding
            flat = " ".join(text.upper().split()).encode()
            pieces = dc.pieces_of(" ".join(item.upper().split()).encode())
            if any(least_edits(p, flat) <= int(len(p) * dc.EDITS) for p in pieces):
                want.add((rows[-1][0], i))
    assert want == {(5 * i + j, i) for i in range(len(CASED)) for j in range(4)}
    bench = spark.createDataFrame(list(enumerate(CASED)), "item_id long, text string")
    found = dc.contaminated(spark.createDataFrame(rows, SCHEMA), bench).collect()
    assert {(r.id, r.item) for r in found} == want and {r.edits for r in found} == {0}
    for r in found:
        place = " ".join(rows[r.id][1][r.start : r.end].upper().split())
        assert len(place) > 30 and place in CASED[r.item].upper()
    again = dc.contaminated(bench.select(F.col("item_id").alias("doc_id"), "text"), spark.createDataFrame([(i, t.upper()) for i, t in enumerate(CASED)], "item_id long, text string"))
    assert {(r.id, r.item, r.edits) for r in again.collect()} == {(i, i, 0) for i in range(len(CASED))}


def test_pieces_cover_an_item():
    text = bytes(range(40, 240)) * 3
    for size in (1, 60, 119, 120, 121, 180, 300, 600):
        cut = dc.pieces_of(text[:size])
        assert cut[0] == text[: min(120, size)] and text[:size].endswith(cut[-1]) and all(len(p) == min(120, size) for p in cut)


def test_matches_stay_inside_a_document(spark):
    item = " ".join("word%d" % (i * 37) for i in range(30))[: dc.PIECE]
    half = len(item) // 2
    docs = spark.createDataFrame([(1, "aa " + item[:half], "", 0), (2, item[half:], "", 0), (3, item, "", 0)], SCHEMA).coalesce(1)
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [r.id for r in dc.contaminated(docs, bench).collect()] == [3]


def test_odd_rows_and_columns(spark):
    item = prose(random.Random(2), 40)
    rows = [(None, item, "a", 1), (1, None, "b", 2), (2, "", "c", 3), (3, "x " * 100_000 + item, "d", 4), (4, item, "e", 5), (4, item, "e", 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    bench = spark.createDataFrame([(None, item), ("n", None), ("s", "short")], "item_id string, text string")
    found = dc.contaminated(docs, bench).collect()
    assert sorted(str(r.id) for r in found) == ["3", "4", "4", "None"] and {r.item for r in found} == {None}
    clean = dc.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2]


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "text", "", 0)], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(docs, bench).count() == 0
    assert dc.drop_contaminated(docs, bench).count() == 1
    assert dc.contaminated(docs.where(F.lit(False)), spark.createDataFrame([(1, "w " * 50)], "item_id long, text string")).count() == 0
