"""Mixing sources to target weights, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.llm.common import SPACE_CLASS, stored, whole_text

SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
#: Characters that lower a document's quality weight, and the least weight a document may have.
NOISE = "!\"#$%&*+<=>@[\\]^_{|}~0123456789"
LEAST_QUALITY = 0.05


def word_count(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(f"[^{SPACE_CLASS}]+")).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of characters that are no noise, 0.05 at least; 1 for an empty text."""
    text = whole_text(text)
    clean = F.length(F.translate(text, NOISE, "")).cast("double")
    return F.greatest(F.lit(LEAST_QUALITY), F.when(F.length(text) == 0, F.lit(1.0)).otherwise(clean / F.length(text)))


def uniform(key: Column, seed: int = 0) -> Column:
    """A number in (0, 1] from the digest of a key: reruns agree, and no two keys do."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / float(2**52)


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows of the group that come earlier in ``order``.

    Rows are dealt to chunks by range and written once, chunk totals are summed up per group, and rows are summed up
    within their chunk: a group of any size spreads over many tasks. Dealing by range reads ``df`` twice.
    """
    keys = [F.col(c).asc_nulls_last() for c in group]
    chunks = stored(df.repartitionByRange(*keys, *order).withColumn("chunk", F.spark_partition_id()), name)
    totals = chunks.groupBy(*group, "chunk").agg(F.sum(value).alias("total"))
    earlier = Window.partitionBy(*group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0).cast("long"))).drop("total")
    within = Window.partitionBy("chunk", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = chunks.withColumn("inner", F.coalesce(F.sum(value).over(within), F.lit(0).cast("long")))
    renamed = totals.select(F.col("chunk").alias("_chunk"), F.col("base").alias("_base"), *[F.col(c).alias(f"_{c}") for c in group])
    match = F.col("chunk") == F.col("_chunk")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return summed.join(renamed, match).select(*df.columns, (F.col("inner") + F.col("_base")).alias("before"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = SOURCE_WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn. They share ``share`` times all sizes by weight; a
    target stops at ``max_epochs`` times the source's size, and the excess goes to the others by weight until none is
    above. The loop carries one number, the words per unit of weight.
    """
    ranked = running_totals(sizes.withColumn("one", F.lit(1).cast("long")), [], [F.col("source").asc_nulls_last()], "one", "source_order")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * max_epochs).cast("double")
    table = stored(ranked.select("source", "source_size", weight.alias("w"), limit.alias("most")), "source_weights")
    total, all_weights = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(1.0))).first()
    goal, level = share * total, share * total / all_weights
    while True:
        held = F.col("most") <= F.col("w") * level
        above, open_weight = table.agg(F.sum(F.when(held, F.col("most")).otherwise(0.0)), F.sum(F.when(held, 0.0).otherwise(F.col("w")))).first()
        raised = (goal - above) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least(F.col("most"), F.col("w") * level).alias("target"))


def mix(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text", seed: int = 0, weights: Sequence[float] = SOURCE_WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: id, size, source_size, target, taken.

    A source is taken whole as often as its target allows; the rest of the target is a fraction of one more pass, drawn
    without replacement by the Efraimidis-Spirakis scheme: each document gets an exponential key over its quality weight,
    documents are taken from the smallest key until the words are used up, and the last one is taken in part. Null texts
    have size 0. A null source is a source of its own; null ids share one random number. Ties of keys go by id, then by
    size, so repeated rows are interchangeable. An empty table gives no rows; other columns are ignored.
    """
    picked = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size"), (-F.log(uniform(F.col(id_column), seed)) / quality_weight(F.col(text_column))).alias("key"))
    picked = stored(picked, "mix_sizes")  # reads the texts once
    rows = running_totals(picked, ["source"], [F.col("key").asc(), F.col("id").asc_nulls_last(), F.col("size").asc()], "size", "mix_rows")
    rows = stored(rows, "mix_totals")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target")
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor("target").cast("long") - epochs * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before")))
    return joined.select("id", "size", "source_size", "target", (epochs * F.col("size") + part).alias("taken"))
