"""Repeated passages of many words, found on a compacted de Bruijn graph of the corpus.

Token k-mers are the edges of the graph. A window of 50 consecutive words is a path of 50 - k + 1 edges; the edge with
the smallest hash is its anchor. Consecutive windows of a document with one anchor form a path label, so a corpus of n
words gives about n / 20 labels instead of n windows. Equal windows have equal anchors, hence:

* a label that several documents have is a repeated path. Two paths are one where every occurrence of the first goes on
  with the second and none of the second comes from elsewhere; such nonbranching paths are compacted by joins, each
  round doubling the reach, until only ends and branches are left;
* an anchor with several labels is a branch: its labels are opened into single windows, each read once, at the source
  coordinates of its first document, and compared by a 128-bit digest of their words;
* a compacted path is read at the source coordinates (document, first word) of its first occurrence, and words are
  removed elsewhere only where the digest of what stands there is the same.

Anchor and label hashes, which propose paths, come from different multipliers and are compared in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.llm.common import LAST_ID, discard, row_key, slices_by_bytes, stored

WINDOW = 50
KMER = 12
#: Bytes of text whose words are hashed at once in a Python worker; one longer text is taken alone.
CHUNK_BYTES = 2_000_000

_BASE, _EDGE, _LABEL = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_NODE = ["anchor", "label"]


def _powers(base: int, n: int):
    import numpy as np

    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Hashes of any ranges of a sequence, from one prefix sum modulo 2^64."""

    def __init__(self, values, base: int):
        import numpy as np

        n = len(values) + 1
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(values * _powers(base, n)[:-1], out=self.sums[1:])
        self.back = _powers(pow(base, -1, 2**64), n)

    def of(self, start, end):
        import numpy as np

        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * np.uint64(_BASE))


def word_hashes(texts: list[bytes], part_bytes: int = CHUNK_BYTES):
    """(hash of every word, its first word's index per text plus the total) of texts, words split at ASCII white space."""
    import numpy as np

    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.concatenate(([True], space[:-1]))
    starts, ends = np.flatnonzero(before & ~space), np.flatnonzero(~before & space)
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    firsts = np.searchsorted(starts, offsets)
    hashes, i = np.empty(len(starts), dtype=np.uint64), 0
    while i < len(starts):  # a long text goes in parts, cut between words
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + part_bytes)))
        a, b = starts[i], ends[j - 1]
        rolling = _Rolling(data[a:b].astype(np.uint64) + np.uint64(1), _BASE)
        hashes[i:j] = rolling.of(starts[i:j] - a, ends[i:j] - a)
        i = j
    return hashes, firsts


def path_labels(words, firsts, window: int = WINDOW, k: int = KMER):
    """Runs of windows with one anchor: (text index, first word in the text, windows, anchor hash, label hash)."""
    import numpy as np

    if len(words) < window:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),) * 2
    at = np.arange(len(words) - k + 1)
    edges = _Rolling(words, _EDGE).of(at, at + k)
    reach, span = at, 1  # reach[i]: the leftmost smallest edge of span edges from i
    while span < window - k + 1:
        step = min(span, window - k + 1 - span)
        left, right = reach[:-step], reach[step:]
        reach, span = np.where(edges[right] < edges[left], right, left), span + step
    text = np.searchsorted(firsts, np.arange(len(reach)), side="right") - 1
    valid = np.arange(len(reach)) + window <= firsts[text + 1]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),) * 2
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (reach[starts[1:]] != reach[starts[:-1]]) | (text[starts[1:]] != text[starts[:-1]])
    run = np.flatnonzero(new)
    first, counts = starts[run], np.diff(np.append(run, len(starts)))
    label = _Rolling(words, _LABEL).of(first, first + counts + window - 1)
    return text[first], first - firsts[text[first]], counts, edges[reach[first]], label


def _signed(values):
    import numpy as np

    return values.view(np.int64)


def labels(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """(id, rk, start, n, anchor, label) of every run; ``docs`` has id, rk and text."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "text", CHUNK_BYTES):
                texts = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
                text, start, counts, anchor, label = path_labels(*word_hashes(texts), window, k)
                picked = part.select(["id", "rk"]).take(pa.array(text, pa.int64()))
                rest = [pa.array(start, pa.int32()), pa.array(counts, pa.int32()), pa.array(_signed(anchor)), pa.array(_signed(label))]
                yield pa.RecordBatch.from_arrays([*picked.columns, *rest], names=["id", "rk", "start", "n", "anchor", "label"])

    return docs.mapInArrow(run, "id long, rk long, start int, n int, anchor long, label long")


def _digests(text: bytes, starts, lengths):
    """Two longs for each range of words, from the words themselves, joined by one space."""
    import hashlib

    import numpy as np

    words = text.split()
    plain = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    begins = np.concatenate(([0], ends))[starts]
    found = [hashlib.blake2b(plain[b:e], digest_size=16).digest() for b, e in zip(begins.tolist(), (ends[starts + lengths - 1] - 1).tolist(), strict=True)]
    return np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, 2)


def read_places(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, rk, start, anchor, label, high, low) of the places in ``docs.asked``: the digest of a whole path, or, with a
    null label, of each of its windows."""
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "text", CHUNK_BYTES):
                for i, text in enumerate(part.column("text").cast(pa.large_binary())):
                    asked = part.column("asked")[i].values
                    begin, n, anchor, label = (asked.field(c) for c in ("start", "n", "anchor", "label"))
                    single = label.is_null().to_numpy(zero_copy_only=False)
                    counts = np.where(single, n.to_numpy(), 1)
                    row = np.repeat(np.arange(len(counts)), counts)
                    start = begin.to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                    length = np.where(single, window, n.to_numpy() + window - 1)[row]
                    digest = _digests(text.as_py(), start, length)
                    keys = [part.column(c).take(pa.array(np.full(len(row), i))) for c in ("id", "rk")]
                    nodes = [c.take(pa.array(row)) for c in (anchor, label)]
                    yield pa.RecordBatch.from_arrays(
                        [*keys, pa.array(start, pa.int32()), *nodes, pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                        names=["id", "rk", "start", "anchor", "label", "high", "low"],
                    )

    return docs.mapInArrow(run, "id long, rk long, start int, anchor long, label long, high long, low long")


def compacted(runs: DataFrame) -> DataFrame:
    """(anchor, label, n): the first path of every maximal nonbranching path, and the windows of all of it. Stored.

    ``runs`` has (id, rk, start, n, anchor, label), each place once. A path goes on in a document where its next window
    starts another one. Paths merge where all occurrences of the one go on with the other and both occur equally often,
    so all occurrences of a compacted path are whole. Documents end, so no cycle is left.
    """
    along = Window.partitionBy("id", "rk").orderBy("start")
    after = F.lead(F.struct("start", *_NODE)).over(along)
    steps = runs.withColumn("after", after).withColumn("after", F.when(F.col("after.start") == F.col("start") + F.col("n"), F.col("after")))
    ends = [f(F.col(f"after.{c}")).alias(f"{name}_{c}") for name, f in (("low", F.min), ("high", F.max)) for c in _NODE]
    nodes = stored(steps.groupBy(*_NODE).agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("times"), F.count("after").alias("goes_on"), *ends), "nodes")
    one_way = nodes.where("goes_on = times and low_anchor = high_anchor and low_label = high_label")
    back = one_way.select(F.col("low_anchor").alias("anchor"), F.col("low_label").alias("label"), "times", F.col("anchor").alias("to_anchor"), F.col("label").alias("to_label"), F.col("n").cast("long").alias("away"))
    # Every node but a first one points back; each round points twice as far, until all point to a first one.
    links = stored(nodes.join(back, [*_NODE, "times"]).select(*_NODE, "n", "to_anchor", "to_label", "away"), "links")
    while True:
        further = links.select(F.col("anchor").alias("to_anchor"), F.col("label").alias("to_label"), F.col("to_anchor").alias("next_anchor"), F.col("to_label").alias("next_label"), F.col("away").alias("more"))
        moved = links.join(further, ["to_anchor", "to_label"], "left").select(
            *_NODE, "n", F.coalesce("next_anchor", "to_anchor").alias("to_anchor"), F.coalesce("next_label", "to_label").alias("to_label"),
            (F.col("away") + F.coalesce("more", F.lit(0))).alias("away"), F.col("more").isNotNull().alias("moved"),
        )
        moved = stored(moved, "links")
        discard(links)
        links, done = moved.drop("moved"), moved.where("moved").isEmpty()
        if done:
            break
    reach = links.groupBy(F.col("to_anchor").alias("anchor"), F.col("to_label").alias("label")).agg(F.max(F.col("away") + F.col("n")).alias("all_n"))
    firsts = nodes.join(links.select(*_NODE), _NODE, "left_anti")
    found = stored(firsts.join(reach, _NODE, "left").select(*_NODE, F.coalesce("all_n", "n").cast("int").alias("n")), "path_ends")
    discard(nodes, links)
    return found


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id (null as the last id), rk and text."""
    return docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID)).alias("id"), row_key(id_column, text_column).alias("rk"), F.col(text_column).cast("string").alias("text"))


def _per_document(rows: DataFrame, struct: Column, name: str) -> DataFrame:
    return rows.groupBy("id", "rk").agg(F.collect_list(struct).alias(name))


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, k: int = KMER) -> DataFrame:
    """(id, rk, start, length, source, high, low): runs of words that a document with a smaller id, ``source``, has too.

    Every window of such a run starts in a smaller document; runs may overlap. id is the largest long for a null id.
    ``high`` and ``low`` are the digest of the words at the source of a compacted path, still to be compared with the
    words of the run; they are null for single windows, whose digests were compared.
    """
    texts = _keyed(docs, id_column, text_column)
    runs = stored(labels(texts, window, k), "path_labels")
    paths = stored(runs.groupBy(*_NODE).agg(F.min("id").alias("source"), F.max("id").alias("last")), "paths")
    shared = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("ways"), F.min("source").alias("a"), F.max("last").alias("b")).where("a < b")
    repeated = (F.col("source") < F.col("last")).alias("repeated")
    known = paths.join(shared.select("anchor", (F.col("ways") > 1).alias("branch")), "anchor").select(*_NODE, "source", "branch", repeated).where("branch or repeated")
    # Rows of one document lie together, each place once, for the joins along the text.
    placed = runs.join(known, _NODE).repartition("id", "rk").dropDuplicates(["id", "rk", "start"])
    placed = stored(placed, "placed_runs")
    discard(runs, paths)

    several = placed.where("repeated").select("id", "rk", "start", "n", *_NODE, "source")
    ends = compacted(several.drop("source"))
    whole = stored(several.drop("n").join(ends, _NODE), "compacted_paths")
    discard(ends)
    first = whole.where("id = source").groupBy(*_NODE, "id", "n").agg(F.min(F.struct("rk", "start")).alias("at"))
    first = first.select("id", "at.rk", "at.start", "n", *_NODE)
    branches = placed.where("branch and id = source").select("id", "rk", "start", "n", "anchor", F.lit(None).cast("long").alias("label"))
    asked = _per_document(first.unionByName(branches), F.struct("start", "n", *_NODE), "asked")
    places = stored(read_places(texts.join(asked, ["id", "rk"]).select("id", "rk", "text", "asked"), window), "places")
    discard(placed)

    digests = places.where("label is not null").groupBy(*_NODE).agg(F.min("high").alias("high"), F.min("low").alias("low"))
    length = (F.col("n") + window - 1).alias("length")
    whole = whole.where("id > source").join(digests, _NODE).select("id", "rk", "start", length, "source", "high", "low")
    single = places.where("label is null")
    key = ["anchor", "high", "low"]
    again = single.groupBy(*key).agg(F.min("id").alias("source"), F.max("id").alias("last")).where("source < last")
    opened = single.join(again, key).where("id > source")
    none = F.lit(None).cast("long")
    return whole.unionAll(opened.select("id", "rk", "start", F.lit(window).alias("length"), "source", none.alias("high"), none.alias("low")))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, k: int = KMER) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept (the kept words joined by one space).

    Removed is each word covered by a window of ``window`` words that also starts in a document with a smaller id. Null
    and empty texts have no words and keep none; a text shorter than a window keeps all. Repeated rows give repeated
    rows: a document has no smaller id than itself. A null id counts as larger than all others, and comes back null. An
    empty table gives no rows; other columns are ignored. Words that differ from those at the source of a path, which
    takes two equal pairs of hashes of different words, are kept.
    """
    import numpy as np
    import pyarrow as pa

    def differing(text: bytes, begin, length, high, low):
        """Flags of the spans with a digest that is not that of their words."""
        other = np.zeros(len(begin), dtype=bool)
        asked = np.flatnonzero(high.is_valid().to_numpy(zero_copy_only=False))
        if len(asked):
            source = np.stack([c.take(pa.array(asked)).to_numpy() for c in (high, low)], axis=1)
            other[asked] = (_digests(text, begin[asked], length[asked]) != source).any(axis=1)
        return other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, "text", 4 * CHUNK_BYTES):
                totals, gone, kept = [], [], []
                for text, spans in zip(part.column("text").cast(pa.large_binary()), part.column("spans"), strict=True):
                    words = (text.as_py() or b"").split()
                    totals.append(len(words))
                    if spans.is_valid:
                        delta = np.zeros(len(words) + 1, dtype=np.int32)
                        begin, length = (spans.values.field(i).to_numpy() for i in range(2))
                        sure = ~differing(text.as_py(), begin, length, spans.values.field(2), spans.values.field(3))
                        begin, length = begin[sure], length[sure]
                        np.add.at(delta, begin, 1)
                        np.add.at(delta, begin + length, -1)
                        keep = np.cumsum(delta[:-1]) == 0
                        words = [w for w, x in zip(words, keep, strict=True) if x]
                    gone.append(totals[-1] - len(words))
                    kept.append(b" ".join(words))
                columns = [part.column("id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept"])

    spans = repeated_spans(docs, id_column, text_column, window, k).select("id", "rk", "start", "length", "high", "low").distinct()
    per_document = _per_document(spans, F.struct("start", "length", "high", "low"), "spans")
    joined = _keyed(docs, id_column, text_column).join(per_document, ["id", "rk"], "left").select("id", "text", "spans")
    done = joined.mapInArrow(run, "id long, n_words long, n_removed long, kept string")
    return done.withColumn("id", F.when(F.col("id") != LAST_ID, F.col("id")))
