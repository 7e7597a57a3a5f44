"""Benchmark decontamination by q-gram counts in diagonal bands.

Texts are compared with the case of all scripts folded and runs of white space as one space. A benchmark item is cut into overlapping pieces,
so that a passage is found also when the rest of the item is missing. If a piece of m bytes occurs with at most k edits,
it shares at least m - q + 1 - kq q-grams with the place (the q-gram lemma), and these lie within k + 1 neighbouring
diagonals (position in the text minus position in the piece). So shared q-grams are counted in bands of 2(k + 1)
diagonals that overlap by half; a band that reaches the bound is a region, and a banded alignment decides it.

Documents are scanned in place, without a shuffle. The benchmark travels to them in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.llm.common import row_key, slices_by_bytes

Q = 12
PIECE = 120
EDITS = 0.05
MIN_BYTES = 32
#: Benchmark bytes that travel to the tasks at once; a larger benchmark takes more passes.
BLOCK_BYTES = 4_000_000
CHUNK_BYTES = 1_000_000
_PAIRS = 1_000_000
_TABLE_BITS = 22
#: Characters whose folded form has another number of bytes. No letter beyond has a case.
_UNEVEN = re.compile("([%s])" % "".join(c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x20000)]) if len(c.casefold().encode()) != len(c.encode())))


def _folded(text: bytes):
    """The text with its case folded and, if some character changes its length, the position in the text of each byte."""
    import numpy as np

    if text.isascii():
        return text.lower(), None
    chars = text.decode("utf-8", "surrogateescape")
    folded = chars.casefold().encode("utf-8", "surrogateescape")
    if not _UNEVEN.search(chars):
        return folded, None
    where, at = [], 0
    for i, part in enumerate(_UNEVEN.split(chars)):
        size = len(part.encode("utf-8", "surrogateescape"))
        if i % 2:  # one such character: its last byte stands for its end
            places = np.full(len(part.casefold().encode()), at)
            places[-1] = at + size - 1
        else:
            places = np.arange(at, at + size)
        where.append(places)
        at += size
    return folded, np.concatenate(where)


def normal(text: bytes) -> bytes:
    return b" ".join(_folded(text)[0].split())


def _budget(size: int, edits: float) -> int:
    return int(size * edits)


def pieces_of(text: bytes, piece: int = PIECE) -> list[bytes]:
    """Overlapping pieces of a normalised item: from every half piece on, and the last one up to its end."""
    starts = sorted({*range(0, max(1, len(text) - piece), piece // 2), max(0, len(text) - piece)})
    return [text[s : s + piece] for s in starts]


def _codes(data):
    """A 64-bit code of the q-gram at every position, mixed from its first eight and last four bytes."""
    import numpy as np

    two = data[:-1].astype(np.uint64) | data[1:].astype(np.uint64) << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    eight = four[:-4] | four[4:] << np.uint64(32)
    mixed = eight[: len(data) - Q + 1] * np.uint64(0x9E3779B97F4A7C15) ^ four[8:] * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _slots(codes):
    import numpy as np

    return (codes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Pieces:
    """The q-gram index of a block of pieces."""

    def __init__(self, texts: list[bytes], items: list[int], edits: float):
        import numpy as np

        self.texts, self.items = texts, np.array(items)
        size = np.array([len(t) for t in texts])
        self.k = np.array([_budget(len(t), edits) for t in texts])
        self.bound = np.maximum(1, size - Q + 1 - self.k * Q)
        codes = [_codes(np.frombuffer(t, dtype=np.uint8)) for t in texts]
        flat = np.concatenate(codes)
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes])
        order = np.argsort(flat, kind="stable")
        self.codes, self.first, counts = np.unique(flat[order], return_index=True, return_counts=True)
        self.counts, self.owner, self.place = counts, owner[order], place[order]
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[_slots(self.codes)] = True
        # Of the places that fit any piece, some window of the shortest length holds so many hits:
        self.window = int((size + self.k).min())
        self.least = int(np.ceil(self.bound / -(-(size + self.k) // self.window)).min())
        self.reach = int((size + self.k).max())

    def regions(self, data):
        """(piece, band) pairs that reach the bound; band b covers the diagonals from b(k + 1) on, 2(k + 1) of them."""
        import numpy as np

        if len(data) < Q:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        codes = _codes(data)
        at = np.flatnonzero(self.table[_slots(codes)])
        found = np.searchsorted(self.codes, codes[at])
        real = self.codes[np.minimum(found, len(self.codes) - 1)] == codes[at]
        at, found = at[real], found[real]
        if len(at) < self.least:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        # A place that fits some piece has a run of `least` hits in a window, and all its hits within `reach` of that run.
        near = np.flatnonzero(at[self.least - 1 :] - at[: len(at) - self.least + 1] < self.window)
        delta = np.zeros(len(at) + 1, dtype=np.int64)
        np.add.at(delta, np.searchsorted(at, at[near] - self.reach, side="left"), 1)
        np.add.at(delta, np.searchsorted(at, at[near + self.least - 1] + self.reach, side="right"), -1)
        kept = np.cumsum(delta[:-1]) > 0
        at, found = at[kept], found[kept]
        keys, totals = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        pairs = np.cumsum(self.counts[found])
        cuts = np.searchsorted(pairs, np.arange(_PAIRS, (pairs[-1] if len(pairs) else 0) + _PAIRS, _PAIRS), side="left") + 1
        start = 0
        for end in cuts:
            a, f = at[start:end], found[start:end]
            start = end
            n = self.counts[f]
            entry = np.repeat(self.first[f], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            piece = self.owner[entry]
            band = (np.repeat(a, n) - self.place[entry]) // (self.k[piece] + 1)
            both = np.concatenate([piece * 2**36 + band + 2**20, piece * 2**36 + band + 2**20 - 1, keys])
            keys, inverse = np.unique(both, return_inverse=True)
            totals = np.bincount(inverse, np.concatenate([np.ones(2 * len(piece)), totals])).astype(np.int64)
        piece = keys >> 36
        enough = totals >= self.bound[piece]
        return piece[enough], (keys[enough] & (2**36 - 1)) - 2**20

    def align(self, data, piece, band):
        """Edits and end of the best place of each piece on the diagonals of its band, k more on both sides."""
        import numpy as np

        edits, ends = np.zeros(len(piece), dtype=np.int64), np.zeros(len(piece), dtype=np.int64)
        length = np.array([len(t) for t in self.texts])[piece] if len(piece) else piece
        for size in np.unique(length):
            same = np.flatnonzero(length == size)
            k = int(self.k[piece[same[0]]])
            width = 2 * (k + 1) + 2 * k
            base = band[same] * (k + 1) - k
            index = base[:, None] + np.arange(width + size)
            text = np.where((index >= 0) & (index < len(data)), data[np.clip(index, 0, len(data) - 1)], 0)
            pattern = np.stack([np.frombuffer(self.texts[p], dtype=np.uint8) for p in piece[same]])
            shift = np.arange(width)
            row = np.zeros((len(same), width), dtype=np.int64)
            for i in range(size):
                moved = row + (text[:, i : i + width] != pattern[:, i : i + 1])
                moved[:, :-1] = np.minimum(moved[:, :-1], row[:, 1:] + 1)
                row = np.minimum.accumulate(moved - shift, axis=1) + shift
            best = row.argmin(axis=1)
            edits[same] = row[np.arange(len(same)), best]
            ends[same] = base + best + size
        return edits, ends


def _normal_with_map(text: bytes):
    """The normalised bytes of a text and, for each, its position in the text."""
    import numpy as np

    folded, where = _folded(text)
    data = np.frombuffer(folded, dtype=np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    at = np.flatnonzero(keep)
    return np.where(space[at], np.uint8(32), data[at]), at if where is None else where[at]


class Short:
    """Items too short for edits and q-grams: they match whole and exactly, between spaces or the ends of a text."""

    def __init__(self, texts: list[bytes], items: list[int]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        by_text: dict[bytes, list[int]] = {}
        for text, item in zip(texts, items, strict=True):
            by_text.setdefault(text, []).append(item)
        for text, of in by_text.items():
            self.machine.add_word(" " + text.decode("latin-1") + " ", (len(text), of))
        self.machine.make_automaton()

    def matches(self, texts: list[bytes]):
        """(text index, item, 0, start, end) of the first place of every item in every text; bytes of the text."""
        for t, text in enumerate(texts):
            data, where = _normal_with_map(text)
            seen = set()
            for end, (size, items) in self.machine.iter(" " + data.tobytes().decode("latin-1").strip(" ") + " "):
                first = end - size + int(data[:1].tobytes() == b" ") - 1  # without the space put in front, and one cut off
                for item in items:
                    if item not in seen:
                        seen.add(item)
                        yield t, item, 0, int(where[first]), int(where[first + size - 1]) + 1


def _matches(texts: list[bytes], pieces: Pieces):
    """(text index, item, edits, start, end) of every text and item that match, at the best piece; bytes of the text."""
    import numpy as np

    gap = np.zeros(int(pieces.k.max()) + 1, dtype=np.uint8)
    parts, maps, starts, at = [], [], [], 0
    for t in texts:
        data, where = _normal_with_map(t)
        starts.append(at)
        parts += [data, gap]
        maps.append(where)
        at += len(data) + len(gap)
    data = np.concatenate(parts)
    piece, band = pieces.regions(data)
    edits, ends = pieces.align(data, piece, band)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for p, e, end in zip(piece, edits, ends, strict=True):
        if e <= pieces.k[p]:
            begin = max(0, end - len(pieces.texts[p]))
            t = int(np.searchsorted(starts, begin + len(pieces.texts[p]) // 2, side="right")) - 1
            where = maps[t]
            first = int(np.clip(begin - starts[t], 0, len(where) - 1))
            last = int(np.clip(end - 1 - starts[t], 0, len(where) - 1))
            found = (int(e), int(where[first]), int(where[last]) + 1)
            key = (t, int(pieces.items[p]))
            best[key] = min(found, best.get(key, found))
    return [(*key, *value) for key, value in sorted(best.items())]


def _blocks(benchmark: DataFrame, item_column: str, text_column: str, piece: int, block_bytes: int):
    """The benchmark as blocks of (item ids, piece texts and the item of each, short texts and the item of each), one after the other."""
    ids, texts, owners, short, short_owners, size = [], [], [], [], [], 0
    for row in benchmark.select(item_column, F.col(text_column).cast("string")).toLocalIterator():
        text = normal((row[1] or "").encode())
        if not text:
            continue
        ids.append(row[0])
        if len(text) < MIN_BYTES:
            short, short_owners, size = [*short, text], [*short_owners, len(ids) - 1], size + len(text)
        else:
            cut = pieces_of(text, piece)
            texts += cut
            owners += [len(ids) - 1] * len(cut)
            size += sum(map(len, cut))
        if size >= block_bytes:
            yield ids, texts, owners, short, short_owners
            ids, texts, owners, short, short_owners, size = [], [], [], [], [], 0
    if ids:
        yield ids, texts, owners, short, short_owners


def _finder(block, edits: float):
    """A function from texts to their matches (text index, place of the item, edits, start, end) in a block, in order."""
    _, texts, owners, short, short_owners = block
    pieces = Pieces(texts, owners, edits) if texts else None
    exact = Short(short, short_owners) if short else None
    return lambda raw: sorted([*(_matches(raw, pieces) if pieces else []), *(exact.matches(raw) if exact else [])])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", piece: int = PIECE, edits: float = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, rk, item, edits, start, end): one row per document and benchmark item that it has a passage of.

    A passage is a piece of an item, ``piece`` bytes or the whole of a shorter item, within ``edits`` times its length in
    edits; start and end are code points of the text, at the piece with the fewest edits. Items under 32 bytes
    are too short for edits: they match whole and exactly, between spaces. Null and empty texts match nothing, and so do
    null and empty items; a null item id comes back null. Repeated rows give repeated rows, tied pieces the first one. Empty
    tables give no rows; other columns are ignored.
    """
    import pyarrow as pa

    schema = "id long, rk long, item string, edits long, start long, end long"
    keyed = docs.select(F.col(id_column).cast("long").alias("id"), row_key(id_column, text_column).alias("rk"), F.col(text_column).cast("string").alias("text"))
    spark: SparkSession = docs.sparkSession
    item_type = benchmark.schema[item_column].dataType
    found = []
    for block in _blocks(benchmark, item_column, item_text_column, piece, block_bytes):
        sent = spark.sparkContext.broadcast(([None if i is None else str(i) for i in block[0]], *block[1:]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            find, names = _finder(sent.value, edits), sent.value[0]
            for batch in batches:
                for part in slices_by_bytes(batch, "text", CHUNK_BYTES):
                    raw = [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]
                    rows = [(t, names[i], e, len(raw[t][:a].decode(errors="ignore")), len(raw[t][:b].decode(errors="ignore"))) for t, i, e, a, b in find(raw)]
                    columns = list(zip(*rows, strict=True)) or [()] * 5
                    picked = part.select(["id", "rk"]).take(pa.array(columns[0], pa.int64()))
                    rest = [pa.array(columns[1], pa.string()), *[pa.array(c, pa.int64()) for c in columns[2:]]]
                    yield pa.RecordBatch.from_arrays([*picked.columns, *rest], names=["id", "rk", "item", "edits", "start", "end"])

        found.append(keyed.mapInArrow(run, schema))
    rows = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)
    return rows.withColumn("item", F.col("item").cast(item_type))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", piece: int = PIECE, edits: float = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without a benchmark passage, with the columns of ``docs``. The scan itself drops the others: nothing is shuffled."""
    import pyarrow as pa

    place = docs.columns.index(text_column)
    for block in _blocks(benchmark, item_column, item_text_column, piece, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(([None] * len(block[0]), *block[1:]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            import numpy as np

            find = _finder(sent.value, edits)
            for batch in batches:
                for part in slices_by_bytes(batch, place, CHUNK_BYTES):
                    raw = [t or b"" for t in part.column(place).cast(pa.large_binary()).to_pylist()]
                    clean = np.ones(len(raw), dtype=bool)
                    clean[[t for t, *_ in find(raw)]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
