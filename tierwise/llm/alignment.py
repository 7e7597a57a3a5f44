"""Alignment of two tokenizers over a corpus, on inverted bitmaps of token pairs.

Both token sequences of a text cover the same bytes. Offsets where tokens of both end cut them into groups, and the two tokens
that end there are linked. For every linked pair of ids the scan writes a posting: a compressed bitmap of the documents of a
chunk that hold the link (up to 2^15 documents, numbered in the chunk), and planes, bitmaps too, with the binary digits of how
many more links than one a document has. Sums of popcounts give the documents and the links of a pair over the corpus. The
scores of the pairs then go back along the postings: each bitmap says which documents get them, and the planes how often.

A container is an array of 16-bit document numbers, or from ``DENSE`` documents on a bitmap of 4096 bytes in Spark's own format.
Documents meet again by chunk, whose postings are bounded; no task holds all postings of a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm.common import slices_by_bytes, stored
from tierwise.llm.vocabularies import BYTE_VOCABULARY, PIECE_VOCABULARY, ByteVocabulary, PieceVocabulary

#: Documents of a chunk at most, and (pair, document) entries from which on a chunk is closed.
CHUNK_DOCS = 2**15
CHUNK_ENTRIES = 2_000_000
CHUNK_BYTES = 2_000_000
BITMAP_BYTES = CHUNK_DOCS // 8
#: Documents from which on a bitmap is no larger than an array.
DENSE = BITMAP_BYTES // 2
#: Pairs are broadcast up to so many; beyond they meet the postings by shuffle, those of hot pairs in parts.
BROADCAST_ROWS = 200_000
HOT_SHARE, SALTS = 1000, 64

_SCHEMA = "id long, chunk long, low int, n_a long, n_b long, n_groups long, groups string, a int, b int, maps array<binary>"


class Aligner:
    """Tokens, groups and links of texts. ``digest`` gives the SHA-256 of the groups in place of their text."""

    def __init__(self, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY, digest: bool = True):
        import numpy as np

        self.a, self.b, self.digest = ByteVocabulary(byte_vocabulary), PieceVocabulary(piece_vocabulary), digest
        self.sizes = [np.array([len(x) for x in v.bytes], dtype=np.int64) for v in (self.a, self.b)]
        # Decimal ids with the mark behind them: inside of a side, at the end of the first side, at the end of a group.
        self.shown = [b"%d%s" % (i, mark) for v, last in ((self.a, b"|"), (self.b, b";")) for mark in (b",", last) for i in range(len(v.bytes))]

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both sides, none if the bytes of a side differ from space and text."""
        if not text:
            return [], []
        whole = " " + text
        a, b, raw = self.a.ids(whole), self.b.ids(text), whole.encode("utf-8", "surrogatepass")
        same = b"".join(map(self.a.bytes.__getitem__, a)) == raw and b"".join(map(self.b.bytes.__getitem__, b)) == raw
        return (a, b) if same else ([], [])

    def align(self, texts: list[str]):
        """(n_a, n_b, n_groups) per text, their groups, and (text, a, b) of every link."""
        import numpy as np

        both = [self.tokens(t) for t in texts]
        counts = np.array([[len(a), len(b)] for a, b in both], dtype=np.int64).reshape(-1, 2)
        a, b = (np.concatenate([np.array(pair[side], dtype=np.int64) for pair in both]) for side in (0, 1))
        # Both sides of a text have the same bytes, so offsets may run on from text to text.
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        shown = np.empty(len(a) + len(b), dtype=np.int64)
        n_a, n_b = len(self.a.bytes), len(self.b.bytes)
        shown[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = a + n_a * last_a
        shown[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = b + n_b * last_b + 2 * n_a
        groups, at = [], 0
        for size in counts.sum(axis=1).tolist():
            text = b"".join(map(self.shown.__getitem__, shown[at : at + size].tolist()))[:-1]
            groups.append(hashlib.sha256(text).hexdigest() if self.digest and size else text.decode())
            at += size
        text = np.repeat(np.arange(len(texts)), counts[:, 0])[last_a]
        n_groups = np.bincount(text, minlength=len(texts))
        return counts[:, 0], counts[:, 1], n_groups, groups, (text, a[last_a], b[last_b])


def containers(lists, docs):
    """A container for each run of ``docs`` (16-bit numbers); ``lists`` are the places where runs start, and the end."""
    import numpy as np
    import pyarrow as pa

    dense = np.flatnonzero(np.diff(lists) >= DENSE)
    raw, size = docs.astype("<u2").tobytes(), 2 * np.diff(lists)
    if not len(dense):
        return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((2 * lists).astype(np.int32)), pa.py_buffer(raw)])
    parts, at = [], 0
    for i in dense:
        bits = np.zeros(CHUNK_DOCS, dtype=np.uint8)
        bits[docs[lists[i] : lists[i + 1]]] = 1
        parts += [raw[at : 2 * lists[i]], np.packbits(bits, bitorder="little").tobytes()]
        at, size[i] = 2 * lists[i + 1], BITMAP_BYTES
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(b"".join([*parts, raw[at:]]))])


def opened(maps):
    """(container of each document, document numbers) of an array of containers."""
    import numpy as np

    ends = np.frombuffer(maps.buffers()[1], dtype=np.int32)[maps.offset : maps.offset + len(maps) + 1].astype(np.int64)
    raw = maps.buffers()[2].to_pybytes() if maps.buffers()[2] is not None else b""
    size = np.diff(ends)
    dense = np.flatnonzero(size == BITMAP_BYTES)
    owners, docs, at = [], [], 0
    for i in [*dense, len(size)]:
        docs.append(np.frombuffer(raw[ends[at] : ends[i]], dtype="<u2"))
        owners.append(np.repeat(np.arange(at, i), size[at:i] // 2))
        if i < len(size):
            docs.append(np.flatnonzero(np.unpackbits(np.frombuffer(raw[ends[i] : ends[i + 1]], dtype=np.uint8), bitorder="little")))
            owners.append(np.full(len(docs[-1]), i))
        at = i + 1
    return np.concatenate(owners), np.concatenate(docs).astype(np.int64)


def _postings(pair, low, times):
    """(pair, maps) of the pairs of a chunk: the documents of each, and the digits of its further links."""
    import numpy as np
    import pyarrow as pa

    order = np.lexsort((low, pair))
    pair, low, more = pair[order], low[order], times[order] - 1
    new = np.concatenate(([True], pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, dtype=bool)
    row, pairs = np.cumsum(new) - 1, pair[new]
    # One container per (pair, plane); plane 0 holds the documents, plane j digit j - 1.
    rows, planes, docs = [row], [np.zeros(len(row), dtype=np.int64)], [low]
    top = np.zeros(len(pairs), dtype=np.int64)
    for j in range(int(more.max(initial=0)).bit_length()):
        here = np.flatnonzero(more >> j & 1)
        rows, planes, docs = [*rows, row[here]], [*planes, np.full(len(here), j + 1)], [*docs, low[here]]
        top[row[here]] = j + 1
    row, plane, low = np.concatenate(rows), np.concatenate(planes), np.concatenate(docs)
    first = np.concatenate(([0], np.cumsum(top + 1)))
    place = first[row] + plane
    order = np.argsort(place, kind="stable")
    sizes = np.bincount(place, minlength=first[-1])
    maps = containers(np.concatenate(([0], np.cumsum(sizes))), low[order])
    return pairs, pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), maps)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY, digest: bool = True) -> DataFrame:
    """Documents (id, chunk, low, n_a, n_b, n_groups, groups) and postings (chunk, a, b, maps) in one scan, without a shuffle.

    ``a`` is null in a document's row. Document ``low`` of ``chunk`` is the one that the postings of the chunk speak of.
    """
    import pyarrow as pa

    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.binary())]

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        aligner = Aligner(byte_vocabulary, piece_vocabulary, digest)
        chunk, held, entries, kept = TaskContext.get().partitionId() << 32, 0, 0, []

        def close() -> pa.RecordBatch:
            pairs, maps = _postings(*(np.concatenate(x) for x in zip(*kept, strict=True)))
            a, b = (pa.array(x.astype(np.int32)) for x in np.divmod(pairs, len(aligner.b.bytes)))
            return rows(len(a), chunk=pa.array(np.full(len(a), chunk)), a=a, b=b, maps=maps)

        for batch in batches:
            for part in slices_by_bytes(batch, "text", CHUNK_BYTES):
                for start in range(0, part.num_rows, CHUNK_DOCS):
                    some = part.slice(start, CHUNK_DOCS)
                    n = some.num_rows
                    if kept and (held + n > CHUNK_DOCS or entries >= CHUNK_ENTRIES):
                        yield close()
                        chunk, held, entries, kept = chunk + 1, 0, 0, []
                    n_a, n_b, n_groups, groups, (text, a, b) = aligner.align([t or "" for t in some.column("text").to_pylist()])
                    links, times = np.unique((a * len(aligner.b.bytes) + b) * n + text, return_counts=True)
                    kept.append((links // n, links % n + held, times))
                    low = pa.array(np.arange(held, held + n, dtype=np.int32))
                    plain = {"n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "groups": pa.array(groups, pa.string())}
                    yield rows(n, id=some.column("id"), chunk=pa.array(np.full(n, chunk)), low=low, **plain)
                    held, entries = held + n, entries + len(times)
        if kept:
            yield close()

    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(run, _SCHEMA)


def popcount(container: Column) -> Column:
    """Documents of a container."""
    return F.when(F.octet_length(container) == BITMAP_BYTES, F.bitmap_count(container)).otherwise(F.octet_length(container) / 2).cast("long")


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, documents, links, best) of every linked pair: best if no other first id has more links with the second."""
    documents = popcount(F.element_at("maps", 1))
    digits = F.transform("maps", lambda m, j: popcount(m) * F.pow(F.lit(2), F.greatest(j - 1, F.lit(0))).cast("long"))
    links = F.aggregate(digits, F.lit(0).cast("long"), lambda x, y: x + y)
    counts = postings.groupBy("a", "b").agg(F.sum(documents).alias("documents"), F.sum(links).alias("links"))
    counts = stored(counts, "pair_counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("a", "b", "documents", "links", (F.col("links") == F.col("most")).alias("best"))


def _with_scores(postings: DataFrame, scores: DataFrame) -> DataFrame:
    """(chunk, maps, links, best) of every posting. The postings of a hot pair are dealt over many tasks."""
    if scores.count() <= BROADCAST_ROWS:
        return postings.join(F.broadcast(scores), ["a", "b"]).select("chunk", "maps", "links", "best")
    rows = postings.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    least = max(1, postings.count() // HOT_SHARE)
    hot = rows.where(F.col("n") > least).select("a", "b", F.lit(True).alias("hot"))  # at most HOT_SHARE pairs
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = scores.join(F.broadcast(hot), ["a", "b"], "left").select("a", "b", "links", "best", F.explode(salts).alias("salt"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("chunk"), F.lit(SALTS))).otherwise(0).cast("int")
    salted = postings.join(F.broadcast(hot), ["a", "b"], "left").withColumn("salt", salt)
    return salted.join(dealt, ["a", "b", "salt"]).select("chunk", "maps", "links", "best")


def _returned(scored: DataFrame) -> DataFrame:
    """(chunk, low, n_best, count_sum): what the postings of a chunk give its documents, chunk by chunk in sorted order."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        chunk, sums = None, np.zeros((2, CHUNK_DOCS), dtype=np.int64)

        def close() -> pa.RecordBatch:
            low = np.flatnonzero(sums[1])  # every link counts itself
            columns = [np.full(len(low), chunk), low.astype(np.int32), sums[0, low], sums[1, low]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "low", "n_best", "count_sum"])

        for batch in batches:
            chunks = batch.column("chunk").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(chunks[1:] != chunks[:-1]) + 1), len(chunks)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if chunk is not None and chunks[a] != chunk:
                    yield close()
                    sums[:] = 0
                chunk = chunks[a]
                part = batch.slice(a, b - a)
                lists = part.column("maps")
                maps = lists.flatten()
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(sizes)), sizes)
                plane = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                times = np.left_shift(1, np.maximum(plane, 1) - 1)
                owner, docs = opened(maps)
                links = part.column("links").to_numpy(zero_copy_only=False)[row] * times
                best = part.column("best").to_numpy(zero_copy_only=False)[row] * times
                np.add.at(sums[0], docs, best[owner])
                np.add.at(sums[1], docs, links[owner])
        if chunk is not None:
            yield close()

    return scored.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, "chunk long, low int, n_best long, count_sum long")


def align(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY, digest: bool = True) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    A text is encoded as space and text by both vocabularies, without special tokens. n_best counts the links whose pair has
    the most links that its second id has in the corpus, ties included; count_sum adds up the links of the pair over the
    links. groups is ``a1,a2|b1;a3|b2,b3`` in decimal ids, or its SHA-256 in lower-case hexadecimal (``digest``). Null and
    empty texts, and those whose tokens of a side do not give the bytes back, have no tokens: zeros and an empty string.
    Repeated rows count again, null ids like others; an empty table gives no rows; other columns are ignored.
    """
    found = stored(scan(docs, id_column, text_column, byte_vocabulary, piece_vocabulary, digest), "alignment")
    postings = found.where("a is not null").select("chunk", "a", "b", "maps")
    scores = stored(pair_counts(postings).drop("documents"), "pair_scores")
    returned = _returned(_with_scores(postings, scores))
    kept = found.where("a is null").select("id", "chunk", "low", "n_a", "n_b", "n_groups", "groups")
    given = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return kept.join(returned, ["chunk", "low"], "left").select("id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), *given, "groups")
