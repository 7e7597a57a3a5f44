"""Exact dedup with an extendible-hash index on shared files, built with DataFrame operations only.

Every text hashes to 64 bits. The directory maps a prefix of the hash to a bucket; a bucket with more links than it may
hold is split by one more bit, which doubles the directory there, until none is overfull. A bucket is a range of hashes.
Links are routed through the directory to the task that owns their bucket, and only there is decided: the owner chains
the links of one hash, compares the bytes of texts that share it, sums up the copies and picks the row that stays. Links
are summed up within the scan tasks before they move, so a text that makes up a third of the corpus reaches its owner as
a few links. The decided chains are the index, written so that a file holds whole buckets in hash order.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm.common import lower_ascii, stored, whole_text

BUCKET_ENTRIES = 16_384
#: Links of one text that reach its owner at most.
SHARES = 8
#: Hashes of copied texts that are broadcast at most, to keep texts without a copy out of the byte comparison.
BROADCAST_HASHES = 2_000_000


def _prefix(depth: int) -> Column:
    """The first ``depth`` bits of the hash."""
    return F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """(depth, prefix, n): the buckets over ``entries.h``, each a hash prefix of ``depth`` bits with n entries.

    No bucket holds more than ``bucket_entries`` entries, but for chains of one hash, which no bit can split.
    """
    depth = max(0, math.ceil(math.log2(max(1, entries.count()) / bucket_entries)))
    buckets = None
    while True:
        counted = entries.groupBy(_prefix(depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("a"), F.max("h").alias("b"))
        level = stored(counted.select(F.lit(depth).alias("depth"), "prefix", "n", ((F.col("n") > bucket_entries) & (F.col("a") < F.col("b"))).alias("overfull")), "directory")
        leaves = level.where("not overfull").select("depth", "prefix", "n")
        buckets = leaves if buckets is None else buckets.unionAll(leaves)
        overfull = level.where("overfull").select(F.col("prefix").alias("_prefix"))
        if depth == 64 or overfull.isEmpty():
            return buckets
        entries = entries.join(overfull, _prefix(depth) == F.col("_prefix"), "left_semi")
        depth += 1


def routed(entries: DataFrame, buckets: DataFrame) -> DataFrame:
    """``entries`` with ``bucket``, the first hash of the bucket that the directory ``buckets`` names for them."""
    least = buckets.agg(F.min("depth")).first()[0]
    if least is None:
        return entries.withColumn("bucket", F.lit(0).cast("long"))
    start = F.when(F.col("depth") > 0, F.expr("shiftleft(prefix, 64 - depth)")).otherwise(F.lit(0).cast("long"))
    named = buckets.select("depth", "prefix", start.alias("bucket"), F.expr(f"shiftrightunsigned(prefix, depth - {least})").alias("least"))
    own_prefix = F.when(F.col("depth") > 0, F.expr("shiftrightunsigned(h, 64 - depth)")).otherwise(F.lit(0).cast("long"))
    return entries.withColumn("least", _prefix(least)).join(named, "least").where(own_prefix == F.col("prefix")).drop("least", "depth", "prefix")


def write_index(entries: DataFrame, bucket_entries: int = BUCKET_ENTRIES, buckets: DataFrame | None = None, decide: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``entries`` with the first hash of their bucket, written so that each file holds whole buckets in hash order.

    ``decide`` works on the entries where they lie with the owners of their buckets, and may group by ``bucket``.
    """
    owned = routed(entries, directory(entries, bucket_entries) if buckets is None else buckets).repartition("bucket")
    return stored((decide(owned) if decide else owned).sortWithinPartitions("bucket", "h"), "hash_index")


def _chained(owned: DataFrame) -> DataFrame:
    """(bucket, h, sha, n, top) of every text: an owner chains the links of a hash and compares the bytes that came along.

    A digest that stands for two texts, or for other numbers of rows than its text, is an error.
    """
    sums = [F.sum("n").alias("n"), F.max("top").alias("top"), F.sum("same_bytes").alias("same_bytes")]
    texts = owned.groupBy("bucket", "h", "sha", "text").agg(*sums)
    chains = texts.groupBy("bucket", "h", "sha").agg(*sums, F.count("text").alias("ways"))
    right = (F.col("ways") == 0) | ((F.col("ways") == 1) & (F.col("n") == F.col("same_bytes")))
    size = F.when(right, F.col("n")).otherwise(F.raise_error(F.lit("two texts share a hash and a digest")).cast("long"))
    return chains.select("bucket", "h", "sha", size.alias("n"), "top")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket_entries: int = BUCKET_ENTRIES, key_bits: int = 64) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest
    id stays; of repeated rows with that id, one. A null id is smaller than any other. An empty table gives no rows;
    other columns are ignored. ``key_bits`` below 64 shortens the hash, which lengthens the chains and changes nothing
    else.
    """
    text = lower_ascii(whole_text(F.col(text_column)))
    h = F.xxhash64("text") if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(F.xxhash64("text"), 64 - key_bits), 64 - key_bits)
    texts = docs.select(F.col(id_column).alias("id"), text.alias("text")).select("id", "text", h.alias("h"))
    keyed = texts.select("id", "h", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), F.monotonically_increasing_id().alias("tag"))
    rows = stored(keyed, "hash_rows")
    share = F.pmod(F.xxhash64("tag"), F.lit(SHARES)).alias("share")
    one_text = rows.groupBy("h", "sha", share).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "tag")).alias("top"))
    links = stored(one_text.drop("share"), "links")
    copied = stored(links.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h"), "copied_hashes")
    compared = texts.select("h", "text", F.pmod(F.xxhash64("id"), F.lit(SHARES)).alias("share"))
    if copied.count() <= BROADCAST_HASHES:
        copied = F.broadcast(copied)
    same = compared.join(copied, "h", "left_semi").groupBy("h", "text", "share").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None)
    narrow = links.select("*", none.cast("string").alias("text"), F.lit(0).cast("long").alias("same_bytes"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    wide = same.select("h", digest.alias("sha"), F.lit(0).cast("long").alias("n"), none.cast(links.schema["top"].dataType).alias("top"), "text", F.col("n").alias("same_bytes"))
    index = write_index(narrow.unionAll(wide), buckets=directory(links, bucket_entries), decide=_chained)
    groups = index.where("n > 1").select("h", "sha", F.col("n").alias("group_size"), "top")
    joined = rows.join(groups, ["h", "sha"], "left")
    return joined.select(
        "id",
        F.when(F.col("top").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("tag") == F.col("top.tag"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
