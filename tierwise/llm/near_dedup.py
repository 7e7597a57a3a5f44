"""Near duplicates by SimHash fingerprints: pigeonhole blocks bring close pairs together, the Hamming distance decides."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm.common import free_name, row_key, stored
from tierwise.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
#: Shingle hashes unpacked at once.
BIT_ROWS = 4096


def simhash(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text: bit i is set if it is set in over half of the shingles' hashes."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *[end + 1 for end in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    if len(words) < words_per_shingle:
        hashes = np.array([digest(joined, HASH_SEED)], dtype=np.uint64)
    else:
        last = ends[words_per_shingle - 1 :]
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, last, strict=False)], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(octets), BIT_ROWS):
        counts += np.unpackbits(octets[i : i + BIT_ROWS], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(octets), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, rk, fp) of every row, computed in one scan without a shuffle; null and wordless texts get 0."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            found = [simhash(t.as_py() or b"", words_per_shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["id", "rk", "fp"])

    picked = docs.select(F.col(id_column).cast("long").alias("id"), row_key(id_column, text_column).alias("rk"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(run, "id long, rk long, fp long")


def block_tables(distinct: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of the block tables for so many fingerprints.

    64 bits are cut into b blocks; two fingerprints that differ in at most ``max_bits`` bits agree on at least
    b - max_bits whole blocks, hence on one of the C(b, max_bits) choices of that many blocks. b is the smallest
    for which the kept bits tell random fingerprints apart, up to 10 blocks; it changes the cost, never the links.
    """
    for blocks in range(max_bits + 1, max(11, max_bits + 2)):
        if 64 * (blocks - max_bits) // blocks >= max(1, distinct).bit_length() + 2:
            break
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(kept) for kept in itertools.combinations(single, blocks - max_bits)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _distance(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(node, root) over the distinct fingerprints ``classes.fp``: those within ``max_bits`` bits are connected.

    Each fingerprint goes to every block table; the rows of a (table, key) bucket share those blocks. First every member
    within reach of its bucket's pivot links to it, which costs one row per member however dense the bucket is. What
    the stars have not yet connected then joins its bucket, and a pair is kept once, in the first table it shares,
    when its distance holds and its two stars differ. So no link is lost, and pairs inside a star are never formed.
    """
    masks = block_tables(classes.count(), max_bits)
    table = F.explode(F.array([F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]))
    keyed = classes.select("fp", table.alias("b")).select("fp", "b.t", "b.key")
    buckets = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("pivot")).where("n > 1")
    members = stored(keyed.join(buckets, ["t", "key"]), "block_members")
    near_pivot = members.where((F.col("fp") != F.col("pivot")) & (_distance("fp", "pivot") <= max_bits))
    stars = stored(components(near_pivot.select("pivot", "fp")), "stars")
    root = stars.select(F.col("node").alias("fp"), "root")
    open_members = members.where("n > 2").join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    pivot_root = stars.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    open_members = open_members.join(pivot_root, "pivot", "left").withColumn("core", F.col("root") == F.coalesce("pivot_root", "pivot"))
    open_members = stored(open_members.select("t", "key", "fp", "root", "core"), "open_members")
    apart = open_members.where("not core")
    other = open_members.select("t", "key", *[F.col(c).alias(f"o_{c}") for c in ("fp", "root", "core")])
    differ = F.col("fp").bitwiseXOR(F.col("o_fp"))
    first = F.lit(None).cast("int")
    for i in reversed(range(len(masks))):
        first = F.when(differ.bitwiseAND(F.lit(_signed(masks[i]))) == 0, i).otherwise(first)
    condition = (
        (apart.t == other.t) & (apart.key == other.key) & (F.col("root") != F.col("o_root"))
        & (F.col("o_core") | (F.col("fp") < F.col("o_fp"))) & (F.bit_count(differ) <= max_bits) & (first == apart.t)
    )
    across = stored(apart.join(other, condition).select("root", "o_root").distinct(), "across")
    if across.isEmpty():
        return stars
    merged = components(across).select(F.col("node").alias("root"), F.col("root").alias("top"))
    lone = across.select(F.explode(F.array("root", "o_root")).alias("node")).distinct()
    nodes = stars.unionAll(lone.join(stars, "node", "left_anti").select("node", F.col("node").alias("root")))
    return nodes.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, rk (row key), fp, component_id, keep_rk.

    component_id is the smallest id reachable over links of at most ``max_bits`` bits, and keep_rk the key of its row
    (of several rows with that id, the smallest key). Copies share a fingerprint, which enters the search once. Null and
    empty texts have fingerprint 0 and link like any other; repeated rows give repeated rows; a null id comes after all
    others (a component of null ids alone has a null component_id). An empty table gives no rows. Other columns are
    ignored.
    """
    found = stored(fingerprints(docs, id_column, text_column, words_per_shingle), "fingerprints")
    classes = _classes(found, "fp")
    return _named(found, classes, "fp", links(classes.select("fp"), max_bits))


def _classes(found: DataFrame, key: str) -> DataFrame:
    """The first row of each value of ``key``."""
    least = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "rk")).alias("least")
    return stored(found.groupBy(key).agg(least), "classes")


def _named(found: DataFrame, classes: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """``found`` with the id and row key of the first row of its component; ``links`` are (node, root)."""
    nodes = stored(links, "near_links")
    rooted = classes.join(nodes.withColumnRenamed("node", key), key, "left").withColumn("root", F.coalesce("root", key))
    rooted = stored(rooted, "rooted")
    tops = rooted.groupBy("root").agg(F.min("least").alias("top"))
    named = rooted.join(tops, "root").select(key, F.col("top.id").alias("component_id"), F.col("top.rk").alias("keep_rk"))
    return found.join(named, key).select("id", "rk", key, "component_id", "keep_rk")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents left when each group of ``near_duplicates`` keeps the one with the smallest id.

    Columns are those of ``docs``. Of repeated rows with that id and text one stays. Only ids and keys travel through the
    search; a row is found again by id and key together, and rows are one only if id and text are equal.
    """
    groups = near_duplicates(docs, id_column, text_column, words_per_shingle, max_bits)
    key, id_ = free_name(docs, "row_key"), free_name(docs, "row_id")
    kept = groups.where("rk = keep_rk and id <=> component_id").select(F.col("rk").alias(key), F.col("id").alias(id_)).distinct()
    keyed = docs.withColumn(key, row_key(id_column, text_column))
    same = (keyed[key] == kept[key]) & F.col(f"`{id_column}`").cast("long").eqNullSafe(kept[id_])
    found = keyed.join(kept, same, "left_semi").dropDuplicates([key, id_column, text_column])
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
