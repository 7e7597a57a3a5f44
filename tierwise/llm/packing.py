"""Best-fit packing of documents into token sequences, after Martello-Toth dominance reduction.

An instance of bin packing is known by the number of pieces of each length, at most ``capacity`` numbers however many
documents there are. These numbers alone go to the driver. There the reduction fixes sets of lengths that dominate every
other set with the same longest piece (any packing can be changed to use them without more sequences), as often as pieces of
these lengths are left; the rest is packed by best fit in falling order, all bins of one content at a time. The plan is a
table of runs: the pieces of one length, in the order of their numbers, go to these sequences at these offsets.

Pieces never move for the plan. Each scan task numbers its own pieces per length; prefix sums over the tasks make the
numbers global, and every piece looks its place up in the plan, whose size is bounded by ``capacity`` too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tierwise.llm.common import slices_by_bytes, stored
from tierwise.llm.vocabularies import BYTE_VOCABULARY, ByteVocabulary

CAPACITY = 1024
END_ID = 2
CHUNK_BYTES = 4_000_000

_PIECES = "id long, piece int, start long, length long, crc long, chunk long, nth long"

#: Sequences of one content: how many, and the (length, times) of their pieces in order.
Pattern = tuple[int, list[tuple[int, int]]]


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``capacity``."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first), *[(s, capacity) for s in range(first, total, capacity)]]


def pieces(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = BYTE_VOCABULARY) -> DataFrame:
    """(id, piece, start, length, crc, chunk, nth): the pieces of all documents in one scan without a shuffle.

    crc is the CRC-32 of the ids as little-endian 32-bit numbers; chunk numbers the scan task and nth the pieces of one
    length in it.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tokens = ByteVocabulary(vocabulary, special=True)
        chunk, counts = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for part in slices_by_bytes(batch, "text", CHUNK_BYTES):
                rows = []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = np.array([*tokens.ids(text or ""), end_id], dtype="<u4")
                    for n, (start, length) in enumerate(cuts(len(ids), capacity)):
                        rows.append((i, n, start, length, zlib.crc32(ids[start : start + length].tobytes()), counts[length]))
                        counts[length] += 1
                at, n, start, length, crc, nth = zip(*rows, strict=True) if rows else [()] * 6
                ids = part.column("id").take(pa.array(at, pa.int64()))
                longs = [pa.array(c, pa.int64()) for c in (start, length, crc, [chunk] * len(rows), nth)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int32()), *longs], names=["id", "piece", "start", "length", "crc", "chunk", "nth"])

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, _PIECES)


def _dominating(left: list[int], j: int, capacity: int) -> list[int] | None:
    """Lengths of a set with j that dominates all sets with j, by the criterion for up to three pieces; None if there is none.

    ``left`` counts the pieces of each length. A set dominates another if it can be cut so that each of its pieces is at
    least as long as the pieces of the other that it stands for. Dropping pieces only drops sets, so what dominates now
    does so until it runs out itself.
    """
    room = capacity - j
    others = lambda s: left[s] - (s == j)
    most, space = 0, room  # pieces that fit beside j at most, counted to three
    for s in range(1, room + 1):
        n = min(others(s), 3 - most, space // s) if others(s) > 0 else 0
        most, space = most + n, space - n * s
        if most == 3 or (others(s) > n and n < 3):
            break
    if most == 0:
        return [j]
    one = next(s for s in range(room, 0, -1) if others(s) > 0)
    if most == 1 or one == room:
        return [j, one]
    if most > 2:
        return None
    known = [s for s in range(1, room + 1) if others(s) > 0]
    best, low, high = (0, 0, 0), 0, len(known) - 1
    while low <= high:  # the longest pair that fits
        a, b = known[high], known[low]
        if a + b > room:
            high -= 1
        elif low == high and others(a) < 2:
            break
        else:
            best = max(best, (a + b, a, b))
            low += 1
    _, a, b = best
    if one >= a + b:
        return [j, one]
    if one == a:
        # Any other pair has a piece no longer than b, or two between b and a; these must not fit.
        between = [s for s in known if s > b for _ in range(min(2, others(s) - (s == a)))]
        if len(between) < 2 or between[0] + between[1] > room:
            return [j, a, b]
    return None


def reduce_instance(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences fixed by dominance, and the number of pieces of each length that are left."""
    left = [0] * (capacity + 1)
    for s, n in counts.items():
        left[s] = n
    fixed: list[Pattern] = []
    again = True
    while again:
        again = False
        for j in range(capacity, 0, -1):
            while left[j]:
                chosen = _dominating(left, j, capacity)
                if chosen is None:
                    break
                content = [(s, chosen.count(s)) for s in dict.fromkeys(chosen)]
                times = min(left[s] // m for s, m in content)
                for s, m in content:
                    left[s] -= times * m
                fixed.append((times, content))
                again = True
    return fixed, {s: n for s, n in enumerate(left) if n}


def best_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best fit in falling order. Bins with the same content move together: the fullest bins with room for a length take as
    many pieces of it as fit, before the next fullest do."""
    bins: list[list[Pattern]] = [[] for _ in range(capacity + 1)]  # by the room that is left
    for s in sorted(counts, reverse=True):
        n = counts[s]
        room = s
        while n:
            while room <= capacity and not bins[room]:
                room += 1
            size, content = bins[room].pop() if room <= capacity else (n, [])
            space = min(room, capacity)
            each = space // s
            full, last = divmod(min(n, size * each), each)
            n -= full * each + last
            if full:
                bins[space - each * s].append((full, [*content, (s, each)]))
            if last:
                bins[space - last * s].append((1, [*content, (s, last)]))
            if content and size > full + (last > 0):
                bins[space].append((size - full - (last > 0), content))
            room = s
    return [p for by_room in bins for p in by_room]


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """All sequences of an instance: what dominance fixes, then best fit of the rest. Full pieces fill sequences of their own."""
    fixed, left = reduce_instance({s: n for s, n in counts.items() if n}, capacity)
    return fixed + best_fit(left, capacity)


def _runs(patterns: list[Pattern], capacity: int):
    """The plan by length and number: arrays of (length, first number) as one sorted key, first sequence, times, offset."""
    import numpy as np

    used, rows, sequence = [0] * (capacity + 1), [], 0
    for times, content in patterns:
        offset = 0
        for s, m in content:
            rows.append((s, used[s], sequence, m, offset))
            used[s] += times * m
            offset += s * m
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return table[:, 0] << 48 | table[:, 1], table[:, 1], table[:, 2], table[:, 3], table[:, 4]


def pack(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = BYTE_VOCABULARY) -> DataFrame:
    """(id, piece, start, length, crc, sequence_id, offset): one row per piece, with its place in a sequence.

    The tokens of a document are those of its text and then ``end_id``. A document of more than ``capacity`` tokens is cut
    into pieces of ``capacity``, the first of which may be shorter; no other document is cut. The pieces of a sequence
    follow each other from offset 0 without gaps and have at most ``capacity`` tokens. Sequence ids are any distinct
    numbers; sequences of one full piece have negative ones. Null and empty texts are one piece with ``end_id`` alone;
    repeated rows and null ids are packed like any others; an empty table gives no rows; other columns are ignored.
    """
    import pyarrow as pa

    found = stored(pieces(docs, id_column, text_column, capacity, end_id, vocabulary), "pieces")
    short = found.where(F.col("length") < capacity)
    per_chunk = stored(short.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    counts = {r.length: r.n for r in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # under `capacity` rows
    sent = docs.sparkSession.sparkContext.broadcast(_runs(plan(counts, capacity), capacity))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_chunk.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = short.join(bases, ["length", "chunk"]).withColumn("nth", F.col("base") + F.col("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        keys, first, sequence, times, offset = sent.value
        for batch in batches:
            length, nth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "nth"))
            at = np.searchsorted(keys, length << 48 | nth, side="right") - 1
            within = nth - first[at]
            placed = (sequence[at] + within // times[at], offset[at] + within % times[at] * length)
            kept = batch.select(["id", "piece", "start", "length", "crc"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(c, pa.int64()) for c in placed]], names=[*kept.schema.names, "sequence_id", "offset"])

    columns = ["id", "piece", "start", "length", "crc"]
    schema = "id long, piece int, start long, length long, crc long, sequence_id long, offset long"
    full = found.where(F.col("length") == capacity).select(
        *columns, (-F.shiftleft("chunk", 36) - F.col("nth") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return numbered.select(*columns, "nth").mapInArrow(place, schema).unionAll(full)
