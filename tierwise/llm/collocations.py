"""Frequent phrases and how strongly their words belong together, by set-oriented (SETM) mining.

The occurrences of frequent words are a relation (block, position, word), written in buckets by block and sorted by block and
position. Phrases of k words are found from those of k - 1: the relation is merge-joined with itself on block and next
position, the joined pairs are counted in groups, and a semi-join keeps the occurrences of frequent groups, which are
written in the same buckets and give the next length. Buckets of both sides hold the same blocks, so the merge join
moves no rows.

A block is a stretch of one text, with the few words after it: positions from ``_TAIL`` on belong to the next block and are not
counted. Pieces of a text are set apart by a gap in the positions. So no group of the joins grows with a text or a piece.
"""

from __future__ import annotations

import contextlib
import itertools
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierwise.llm.common import slices_by_bytes, stored
from tierwise.llm.substring_dedup import _BASE, _mix, _Rolling
from tierwise.sources.shared_folder import scratch_path

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: A candidate goes when a longer one that holds it has at least so many hundredths of its count.
COVER_PERCENT = 100
UNKNOWN_LANG = "und"
#: Words of a block.
BLOCK = 4096
_TAIL = 2 * BLOCK
CHUNK_BYTES = 2_000_000
#: Words of a bucket of the relation.
BUCKET_WORDS = 4_000_000
MAX_BUCKETS = 100_000
#: A table of groups is broadcast up to so many rows; beyond it is joined by shuffle, hot groups in parts.
BROADCAST_ROWS = 200_000
HOT_SHARE, SALTS = 1000, 64
TOP_PARTS = 64

# Bytes between words of a piece, and bytes between pieces.
_SPACES, _ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"


class _Words:
    """The words of some texts: their codes, places and blocks."""

    def __init__(self, texts: list[bytes], langs: list[str], attempt: int, part_bytes: int = CHUNK_BYTES):
        import numpy as np
        import xxhash

        self.data = b"\n".join(texts).lower() + b"\n"  # bytes: A-Z only
        kind = np.zeros(256, dtype=np.uint8)
        kind[list(_SPACES)], kind[list(_ENDS)] = 1, 2
        kinds = kind[np.frombuffer(self.data, dtype=np.uint8)]
        before = np.concatenate(([1], kinds[:-1]))
        self.starts, self.ends = np.flatnonzero((kinds == 0) & (before > 0)), np.flatnonzero((kinds > 0) & (before == 0))
        n = len(self.starts)
        piece = np.cumsum(kinds == 2)[self.starts]
        self.place = np.arange(n) + np.cumsum(np.concatenate(([0], piece[1:] != piece[:-1]))[:n])
        offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.firsts = np.searchsorted(self.starts, offsets)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.firsts))
        codes = np.empty(n, dtype=np.uint64)
        if attempt:  # another kind of hash, word by word
            codes[:] = [xxhash.xxh64_intdigest(self.data[a:b], attempt) for a, b in zip(self.starts, self.ends, strict=True)]
        i = n if attempt else 0
        while i < n:  # a long text goes in parts, cut between words
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + part_bytes)))
            a, b = self.starts[i], self.ends[j - 1]
            rolling = _Rolling(np.frombuffer(self.data, dtype=np.uint8)[a:b].astype(np.uint64) + np.uint64(1), _BASE)
            codes[i:j] = rolling.of(self.starts[i:j] - a, self.ends[i:j] - a)
            i = j
        by_lang = np.array([xxhash.xxh64_intdigest(x.encode(), attempt) for x in langs], dtype=np.uint64)
        self.codes = _mix(codes ^ by_lang[self.text]).view(np.int64)

    def counts(self):
        """(code, a word with it, its text, occurrences) of every code."""
        import numpy as np

        codes, at, n = np.unique(self.codes, return_index=True, return_counts=True)
        return codes, [self.data[a:b] for a, b in zip(self.starts[at], self.ends[at], strict=True)], self.text[at], n

    def blocks(self, tail: int):
        """(words of each block, place in its block and code of each word); the words after a block come in it again."""
        import numpy as np

        first, last = self.firsts[:-1], self.firsts[1:]
        per_text = -(-(last - first) // BLOCK)
        text = np.repeat(np.arange(len(first)), per_text)
        start = first[text] + BLOCK * (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text))
        end = np.minimum(start + BLOCK, last[text])
        size = np.minimum(end + tail, last[text]) - start
        # A word after the last one of a text would stand one place on.
        zero = self.place[end - 1] + np.where(end < last[text], self.place[np.minimum(end, len(self.place) - 1)] - self.place[end - 1], 1)
        word = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return size, (self.place[word] - np.repeat(zero, size) + _TAIL).astype(np.int32), self.codes[word]


def _picked(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN_LANG))
    return docs.select(F.col(text_column).cast("string").alias("text"), lang.alias("lang")).where("text is not null and text <> ''")


def _slices(batches, attempt: int):
    import pyarrow as pa

    for batch in batches:
        for part in slices_by_bytes(batch, "text", CHUNK_BYTES):
            langs = part.column("lang").to_pylist()
            words = _Words(part.column("text").cast(pa.large_binary()).to_pylist(), langs, attempt)
            if len(words.codes):
                yield words, langs


def _vocabulary(docs: DataFrame, attempt: int) -> DataFrame:
    """(code, lang, word, n, twice): how often each word occurs; ``twice`` marks a code that two words share."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in _slices(batches, attempt):
            codes, found, text, n = words.counts()
            columns = [pa.array(codes), pa.array([langs[t] for t in text], pa.string()), pa.array(found, pa.binary()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["code", "lang", "word", "n"])

    named = F.struct("lang", "word")
    counted = docs.mapInArrow(run, "code long, lang string, word binary, n long").groupBy("code")
    counted = counted.agg(F.min(named).alias("least"), F.max(named).alias("most"), F.sum("n").alias("n"))
    return counted.select("code", "least.lang", F.col("least.word").cast("string").alias("word"), "n", (F.col("least") != F.col("most")).alias("twice"))


def _occurrences(docs: DataFrame, attempt: int, tail: int) -> DataFrame:
    """(block, place, code) of every word."""
    import pyarrow as pa
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        block = TaskContext.get().partitionId() << 36
        for words, _ in _slices(batches, attempt):
            size, place, code = words.blocks(tail)
            rows = pa.StructArray.from_arrays([pa.array(place), pa.array(code)], names=["place", "code"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(block, block + len(size))), lists], names=["block", "rows"])
            block += len(size)

    lists = docs.mapInArrow(run, "block long, rows array<struct<place int, code long>>")
    return lists.select("block", F.inline("rows"))


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with an ``id`` from 0 on, nearly without gaps."""
    rows = stored(df.withColumn("_at", F.monotonically_increasing_id()), name)
    parts = (rows.agg(F.max(F.shiftright("_at", 33))).first()[0] or 0) + 1
    number = F.col("_at").bitwiseAND(F.lit(2**33 - 1)) * parts + F.shiftright("_at", 33)
    return rows.withColumn("id", number).drop("_at")


def _found(rows: DataFrame, groups: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``rows`` (with a block) whose keys are in ``groups`` (keys, id, n), with the id. A hot group is dealt over many tasks."""
    if size <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups.drop("n")), keys)
    least = F.lit(max(1, groups.agg(F.sum("n")).first()[0] // HOT_SHARE))
    hot = groups.where(F.col("n") > least).select(*keys, F.lit(True).alias("_hot"))  # at most HOT_SHARE groups
    salt = F.when(F.col("_hot"), F.pmod(F.col("block"), F.lit(SALTS))).otherwise(0).cast("int")
    salts = F.when(F.col("n") > least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt)
    return salted.join(groups.select(*keys, "id", F.explode(salts).alias("_salt")), [*keys, "_salt"]).drop("_salt", "_hot")


@contextlib.contextmanager
def _joined_in_place(spark: SparkSession):
    """Tables bucketed by block meet on block and place without a shuffle."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    past = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, past) if past is not None else spark.conf.unset(name)


class _Relations:
    """Occurrence relations (block, place, id) as sorted, bucketed tables; their files outlive the names."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, rows: DataFrame) -> DataFrame:
        name = f"occurrences_{uuid.uuid4().hex}"
        self.names.append(name)
        writer = rows.select("block", "place", "id").repartition(self.buckets, "block").write.format("parquet")
        writer.bucketBy(self.buckets, "block").sortBy("block", "place").option("path", scratch_path(self.spark, "occurrences")).saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _score(n):
    """The lowest-scoring cut as (score, cut, l, r), of several the shortest first part. Products fit 38 digits."""
    cuts = F.sequence(F.lit(1), F.size("pre"))

    def cut(k):
        left, right = F.element_at("pre", k), F.element_at("suf", F.size("suf") - k + 1)
        top = F.lit(1000).cast("decimal(4,0)") * (F.col("a").cast("decimal(16,0)") * F.col(n).cast("decimal(16,0)")).cast("decimal(33,0)")
        below = left.cast("decimal(16,0)") * right.cast("decimal(16,0)")
        return F.struct(F.call_function("div", top.cast("decimal(38,0)"), below.cast("decimal(38,0)")).alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(cuts, cut))


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    cover_percent: int = COVER_PERCENT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at . , ; : ! ? and line ends, pieces into words at spaces and tabs. A
    candidate has 2 to ``max_words`` words and occurs a >= ``min_count`` times inside pieces, overlaps counted. Of its cuts
    into two parts, which occur l and r times, the one with the lowest floor(1000 a n / (l r)) counts (n: words of the
    language), the shortest first part among equals. Candidates that a longer one covers are dropped. Order: score and a
    falling, phrase by bytes. A null language is ``und``; null and empty texts hold no words; repeated rows count
    again; an empty table gives no rows; other columns are ignored.

    ``docs`` is read three times and must give the same rows each time, as a table of files does. Word codes that two words share
    are found and made anew.
    """
    spark, picked = docs.sparkSession, _picked(docs, text_column, lang_column)
    for attempt in itertools.count():
        vocabulary = stored(_vocabulary(picked, attempt), "vocabulary")
        if vocabulary.where("twice").isEmpty():
            break
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    words = vocabulary.agg(F.sum("n")).first()[0] or 0
    none = F.array().cast("array<bigint>")
    level = _numbered(vocabulary.where(F.col("n") >= min_count).drop("twice"), "frequent_words")
    level = level.select("code", "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n", none.alias("pre"), none.alias("suf"))
    buckets = min(MAX_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // BUCKET_WORDS)))
    relations = _Relations(spark, buckets)
    levels = []
    with _joined_in_place(spark):
        try:
            rows = _found(_occurrences(picked, attempt, max_words - 1), level.select("code", "id", "n"), ["code"], level.count())
            relation = relations.write(rows)
            for k in range(2, max_words + 1):
                left = relation.select("block", "place", F.col("id").alias("p"))
                right = relation.select(F.col("block").alias("_block"), F.col("place").alias("_place"), F.col("id").alias("q"))
                pairs = left.hint("merge").join(right, (F.col("block") == F.col("_block")) & (F.col("place") + 1 == F.col("_place"))).select("block", "place", "p", "q")
                groups = pairs.where(F.col("place") < _TAIL).groupBy("p", "q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
                groups = _numbered(groups, f"phrases_{k}")
                size = groups.count()
                first = level.select(F.col("id").alias("p"), "lang", "phrase", "pre", F.col("n").alias("pn"))
                second = level.select(F.col("id").alias("q"), "last", "suf", F.col("n").alias("qn"))
                level = groups.join(first, "p").join(second, "q").select(
                    "id", "p", "q", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "n",
                    F.concat("pre", F.array("pn")).alias("pre"), F.concat("suf", F.array("qn")).alias("suf"),
                )
                level = stored(level, f"candidates_{k}")
                levels.append(level)
                if not size:
                    break
                if k < max_words:
                    relation = relations.write(_found(pairs, groups.select("p", "q", "id", "n"), ["p", "q"], size))
        finally:
            relations.drop()

    # A phrase inside a longer one is also inside one a word longer, with at least that count.
    left = []
    for this, longer in itertools.zip_longest(levels, levels[1:]):
        rows = this.withColumnRenamed("n", "a")
        if longer is not None:
            inside = longer.select(F.explode(F.array("p", "q")).alias("id"), "n").groupBy("id").agg(F.max("n").alias("within"))
            rows = rows.join(inside, "id", "left").where(F.coalesce(F.col("within"), F.lit(0)) * 100 < F.col("a") * cover_percent)
        left.append(rows.select("lang", "phrase", "a", "pre", "suf"))
    scored = reduce(DataFrame.unionAll, left).join(F.broadcast(totals) if totals.count() <= BROADCAST_ROWS else totals, "lang").withColumn("cut", _score("n"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    best = scored.withColumn("_at", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("_at") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
