"""Rows in an order: nearest earlier rows of a key, frames of neighbours.

A window without a partition, or one whose partition holds a third of the rows, is a single task. Here the rows are dealt
to chunks by range of (key, order) or to blocks of equal size by position; what a chunk needs of its neighbours travels
to it: one carried row per chunk, or the rows of a halo.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.operators.ranking import _chunks, _positions
from tierwise.sources.shared_folder import cut_lineage

#: Rows of a block of neighbours.
BLOCK_ROWS = 100_000


def last_before(points: DataFrame, order: Sequence[str], value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``_last``: the newest non-null ``value`` of an earlier row with the same keys, by ``order``.

    Rows are dealt to chunks by range of keys and order, and written once: range bounds come from a sample and would differ
    in a second run. Within a chunk a window carries the value on. Only the first key of a chunk can go on from the
    chunks before; it gets the newest value that the nearest earlier chunk has for its own last key, if that is the
    same key. A key that holds any share of the rows runs over as many chunks as it fills.
    """
    dealt = cut_lineage(points.repartitionByRange(*keys, *order).withColumn("_chunk", F.spark_partition_id()))
    key = F.struct(*[F.col(k) for k in keys], F.lit(0).alias("_same"))
    known = F.col(value).isNotNull()
    chunks = dealt.groupBy("_chunk").agg(
        F.max(key).alias("_end"),
        F.max_by(F.when(known, F.struct(key.alias("key"), F.col(value).alias("value"))), F.when(known, F.struct(key, *order))).alias("_tail"),
    )
    # One row per chunk from here on.
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tail = F.when(F.col("_tail.key").eqNullSafe(F.col("_end")), F.col("_tail"))
    carried = chunks.select("_chunk", F.last(tail, ignorenulls=True).over(before).alias("_carried"))
    earlier = Window.partitionBy("_chunk", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_near", F.last(value, ignorenulls=True).over(earlier)).join(carried, "_chunk")
    from_before = F.when(F.col("_carried.key").eqNullSafe(key), F.col("_carried.value"))
    return inside.select(*points.columns, F.coalesce("_near", from_before).alias("_last"))


def as_of_join(
    rows: DataFrame,
    facts: DataFrame,
    on: Mapping[str, str],
    moment: str,
    fact_moment: str,
    columns: Mapping[str, str],
    ties: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Left join of each row to the newest fact of its key at or before ``moment`` (``strict``: before it).

    ``on`` maps row columns to fact columns (none: one order for all), ``columns`` output names to fact columns. Of several
    facts of a key at one moment the one that is last by ``ties`` counts. Rows without a key or a moment, or without an
    earlier fact, keep NULL; facts without a key or a moment match nothing. Rows and facts are sorted together by range,
    so a key may hold any share of either side.
    """
    keep, keys = rows.columns, [f"_k{i}" for i in range(len(on))]
    known = F.lit(True)
    for c in (*on, moment):
        known = known & F.col(f"`{c}`").isNotNull()
    payload = F.struct(*[F.col(c).alias(f"_out_{name}") for name, c in columns.items()])
    named = [F.col(c).alias(k) for k, c in zip(keys, on.values(), strict=True)]
    newest = facts.na.drop(subset=[*on.values(), fact_moment]).groupBy(*named, F.col(fact_moment).alias("_at"))
    fact_points = newest.agg(F.max_by(payload, F.struct(*ties, *([] if ties else [F.lit(0)]))).alias("_fact"))
    fact_points = fact_points.withColumns({"_side": F.lit(1 if strict else 0), "_tie": F.lit(0).cast("long")})
    # Rows of one key and moment are told apart, so that a range may be cut between them.
    own = rows.where(known).select(
        *[F.col(f"`{c}`").alias(k) for k, c in zip(keys, on, strict=True)], F.col(f"`{moment}`").alias("_at"),
        F.lit(0 if strict else 1).alias("_side"), F.xxhash64(*[F.col(f"`{c}`") for c in keep]).alias("_tie"),
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
    )
    found = last_before(own.unionByName(fact_points, allowMissingColumns=True), ["_at", "_side", "_tie"], "_fact", keys)
    joined = found.where("_row is not null").select("_row.*", *[F.col(f"_last._out_{name}").alias(name) for name in columns])
    return joined.unionByName(rows.where(~known), allowMissingColumns=True)


def framed(
    df: DataFrame,
    identity: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, tuple[Column, int, int]],
    partition: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add columns over frames of neighbouring rows, such as moving sums, LEAD and LAG.

    ``values`` maps a name to (aggregate, first, last): the frame goes from ``first`` to ``last`` rows behind the row itself,
    negative for rows before it. ``F.first("x"), 1, 1`` is LEAD. Order is ascending by ``order``, NULL first, then
    by ``identity``, which must tell all rows apart; frames stay inside of ``partition``, where NULL is a group.

    Rows get exact positions by range and go to blocks of ``block_rows`` positions; a block also gets the rows of its
    neighbours that its frames reach. So every task has equal work, whatever share of the rows a partition holds.
    """
    before = max([0, *[-first for _, first, _ in values.values()]])
    behind = max([0, *[last for _, _, last in values.values()]])
    size = max(block_rows, before, behind, 1)
    at = F.col("_pos") - 1
    home, place = F.call_function("div", at, F.lit(size).cast("long")), at % size
    blocks = F.array(home, F.when(place >= size - before, home + 1), F.when(place < behind, home - 1))
    placed = _positions(df, partition, order, identity, _chunks(df.count()))
    copies = placed.select(*df.columns, "_pos", home.alias("_home"), F.explode(F.array_compact(blocks)).alias("_block"))
    along = Window.partitionBy(*partition, "_block").orderBy("_pos")
    added = [value.over(along.rowsBetween(first, last)).alias(name) for name, (value, first, last) in values.items()]
    return copies.select(*df.columns, "_home", "_block", *added).where("_block = _home").drop("_home", "_block")
