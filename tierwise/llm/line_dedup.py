"""Line dedup with a sharded minimal perfect hash.

Distinct line hashes, with the number of documents that have them, are dealt to shards by hash. Each shard builds a
minimal perfect hash: in levels, a hash that is alone at its place sets the bit there, the others go on to the next
level; the rank of its bit is its place in two compact arrays, of fingerprints and of counts. A shard is one small row,
whatever the corpus holds. Documents send their line hashes to the shards, where they probe the arrays as a stream
behind the shard's row: no line is joined with its occurrences. A shard with much traffic, as that of a line which a
third of all documents have, is copied to as many streams as its counts call for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from tierwise.llm.common import LAST_ID, free_name, row_key, slices_by_bytes, stored

MIN_DOCS = 10
MIN_CHARS = 1
SHARD_KEYS = 100_000
STREAM_ROWS = 500_000
CHUNK_BYTES = 8_000_000
_LEVELS = 24
_SPACE = b" \t\n\x0b\x0c\r"
_SHARD_SCHEMA = "shard long, sizes array<long>, bits binary, prints binary, counts binary, rest binary"


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line: stripped of ASCII white space at both ends, A-Z lower-cased."""
    return [line.strip(_SPACE).lower() for line in text.split(b"\n")]


def _level(keys, level: int, size: int):
    import numpy as np

    x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(size)).astype(np.int64)


def build_shard(keys, prints, counts) -> dict:
    """Bits, arrays and the few rows (hash, fingerprint, count) that no level could place."""
    import numpy as np

    left, sizes, bits, order = np.arange(len(keys)), [], [], []
    while len(left) and len(sizes) < _LEVELS:
        size = 64 * max(1, math.ceil(2 * len(left) / 64))
        place = _level(keys[left], len(sizes), size)
        alone = np.bincount(place, minlength=size)[place] == 1
        mask = np.zeros(size, dtype=np.uint8)
        mask[place[alone]] = 1
        sizes.append(size)
        bits.append(np.packbits(mask, bitorder="little"))
        placed = left[alone]
        order.append(placed[np.argsort(place[alone])])
        left = left[~alone]
    order = np.concatenate(order) if order else np.zeros(0, dtype=np.int64)
    rest = np.stack([keys[left], prints[left].astype(np.uint64), counts[left].astype(np.uint64)], axis=1)
    return {
        "sizes": sizes,
        "bits": b"".join(b.tobytes() for b in bits),
        "prints": prints[order].astype("<u4").tobytes(),
        "counts": np.minimum(counts[order], 2**32 - 1).astype("<u4").tobytes(),
        "rest": rest.astype("<u8").tobytes(),
    }


class Shard:
    """Answers how many documents have the lines with given hashes and fingerprints."""

    def __init__(self, row: dict):
        import numpy as np

        self.sizes = row["sizes"]
        self.words = np.frombuffer(row["bits"], dtype="<u8")
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.prints, self.counts = (np.frombuffer(row[c], dtype="<u4") for c in ("prints", "counts"))
        self.rest = {(int(h), int(p)): int(n) for h, p, n in np.frombuffer(row["rest"], dtype="<u8").reshape(-1, 3)}

    def lookup(self, keys, prints):
        import numpy as np

        found, open_, base = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            place = _level(keys[open_], level, size) + base
            word, shift = place >> 6, (place & 63).astype(np.uint64)
            hit = (self.words[word] >> shift) & np.uint64(1) == 1
            rank = self.ranks[word[hit]] + np.bitwise_count(self.words[word[hit]] & ((np.uint64(1) << shift[hit]) - np.uint64(1)))
            at = open_[hit]
            found[at] = np.where(self.prints[rank] == prints[at], self.counts[rank], 0)
            open_, base = open_[~hit], base + size
        for i in open_ if self.rest else ():
            found[i] = self.rest.get((int(keys[i]), int(prints[i])), 0)
        return found


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, rk, pos, h, print): one array entry per line whose key is long enough; ``docs`` has id, rk and text."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        for batch in batches:
            columns = ([], [], [])
            for text in batch.column("text").cast(pa.large_binary()):
                picked = [(i, k) for i, k in enumerate(line_keys(text.as_py() or b"")) if k and (min_chars <= 1 or len(k.decode()) >= min_chars)]
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k) for _, k in picked), dtype="<i8").reshape(-1, 2)
                for column, values in zip(columns, ([i for i, _ in picked], digests[:, 0], digests[:, 1] & 0xFFFFFFFF), strict=True):
                    column.append(values)
            kinds = (pa.int32(), pa.int64(), pa.int64())
            arrays = [pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("rk"), *arrays], names=["id", "rk", "pos", "h", "print"])

    return docs.mapInArrow(run, "id long, rk long, pos array<int>, h array<long>, print array<long>")


def line_index(lines: DataFrame, shard_keys: int = SHARD_KEYS, stream_rows: int = STREAM_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """The shards, (shard, streams) for each, and the number of shards, from the output of ``line_hashes``."""
    import pandas as pd

    own = F.array_distinct(F.arrays_zip("h", "print"))
    counted = lines.select(F.explode(own).alias("x")).groupBy("x.h", "x.print").agg(F.count(F.lit(1)).alias("n"))
    entries = stored(counted, "line_counts")
    n_shards = max(1, math.ceil(entries.count() / shard_keys))
    entries = entries.withColumn("shard", F.pmod(F.shiftrightunsigned("h", 8), F.lit(n_shards)))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        row = build_shard(frame["h"].to_numpy(np.int64).view(np.uint64), frame["print"].to_numpy(), frame["n"].to_numpy())
        return pd.DataFrame([{"shard": frame["shard"].iloc[0]} | row])

    shards = stored(entries.groupBy("shard").applyInPandas(build, _SHARD_SCHEMA), "line_shards")
    streams = entries.groupBy("shard").agg(F.ceil(F.sum("n") / stream_rows).cast("long").alias("streams"))
    return shards, stored(streams, "line_streams"), n_shards


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, stream_rows: int = STREAM_ROWS) -> DataFrame:
    """(id, rk, drops): the positions of lines that at least ``min_docs`` documents have; ``docs`` has id, rk and text."""
    import pyarrow as pa

    lines = stored(line_hashes(docs, min_chars), "line_hashes")
    shards, streams, n_shards = line_index(lines, shard_keys, stream_rows)
    single = lines.select("id", "rk", F.explode(F.arrays_zip("pos", "h", "print")).alias("x")).select("id", "rk", "x.pos", "x.h", "x.print")
    single = single.withColumn("shard", F.pmod(F.shiftrightunsigned("h", 8), F.lit(n_shards)))
    probes = single.join(streams, "shard").withColumn("stream", F.pmod(F.xxhash64("rk", "pos"), F.col("streams"))).drop("streams")
    tables = shards.join(streams, "shard").withColumn("stream", F.explode(F.sequence(F.lit(0).cast("long"), F.col("streams") - 1))).drop("streams")
    dealt = probes.unionByName(tables, allowMissingColumns=True).withColumn("probe", F.col("bits").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        shard = None
        for batch in batches:
            is_probe = batch.column("probe").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(~is_probe)
            for start, end in zip([-1, *cuts], [*cuts, batch.num_rows], strict=True):
                if start >= 0:
                    shard = Shard(batch.select(["sizes", "bits", "prints", "counts", "rest"]).slice(start, 1).to_pylist()[0])
                part = batch.slice(start + 1, end - start - 1)
                if part.num_rows:
                    counts = shard.lookup(part.column("h").to_numpy().view(np.uint64), part.column("print").to_numpy())
                    yield part.filter(pa.array(counts >= min_docs)).select(["id", "rk", "pos"])

    streamed = dealt.repartition("shard", "stream").sortWithinPartitions("shard", "stream", "probe")
    return streamed.mapInArrow(run, "id long, rk long, pos int").groupBy("id", "rk").agg(F.collect_set("pos").alias("drops"))


def drop_frequent_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, stream_rows: int = STREAM_ROWS, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents have, with the columns n_lines and n_dropped.

    Lines are split at newlines and compared by their keys; keys under ``min_chars`` code points are never dropped. A null
    or empty text is one empty line, and comes back empty. Every row is a document, repeated ones too; null ids are
    documents like any other. An empty table gives no rows. Other columns stay; ``n_lines`` and ``n_dropped`` replace
    columns of those names.
    """
    import numpy as np
    import pyarrow as pa

    docs = docs.drop(n_lines, n_dropped)
    id_, rk, drops = (free_name(docs, c) for c in ("line_id", "line_rk", "line_drops"))
    keyed = docs.withColumns({id_: F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID)), rk: row_key(id_column, text_column)})
    found = frequent_lines(keyed.select(F.col(id_).alias("id"), F.col(rk).alias("rk"), F.col(text_column).cast("string").alias("text")), min_docs, min_chars, shard_keys, stream_rows)
    joined = keyed.join(found.select(F.col("id").alias(id_), F.col("rk").alias(rk), F.col("drops").alias(drops)), [id_, rk], "left")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices_by_bytes(batch, text_column, CHUNK_BYTES):
                texts, totals, gone = [], [], []
                for text, drop in zip(part.column(text_column).cast(pa.large_binary()), part.column(drops), strict=True):
                    rows = (text.as_py() or b"").split(b"\n")
                    totals.append(len(rows))
                    gone.append(len(drop) if drop.is_valid else 0)
                    if gone[-1]:
                        keep = np.ones(len(rows), dtype=bool)
                        keep[drop.values.to_numpy()] = False
                        rows = [r for r, k in zip(rows, keep, strict=True) if k]
                    texts.append(b"\n".join(rows))
                columns = [pa.array(texts, pa.binary()).cast(pa.string()) if c == text_column else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], names=[*names, n_lines, n_dropped])

    schema = docs.schema.add(n_lines, "long").add(n_dropped, "long")
    return joined.select(*names, drops).mapInArrow(run, schema)
