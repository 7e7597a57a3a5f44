"""Ranks, deciles, medians and lags.

``Window.orderBy`` without a partition sends the whole table to one task, and a partition that holds
a third of the rows does the same to that third. The operators here range-partition the sort keys
instead, number the rows inside each chunk, and shift each chunk by the totals of the chunks before
it. Ties may run over many chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierwise.sources.shared_folder import cut_lineage

KINDS = ("row_number", "rank", "dense_rank", "percent_rank", "ntile")


@dataclass(frozen=True)
class Key:
    """One sort key (a number, date, time, flag or text), ascending with NULLs first unless said otherwise."""

    column: str
    descending: bool = False
    nulls_last: bool = False

    def column_order(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()


@dataclass(frozen=True)
class Rank:
    """One output column. ``row_number`` and ``ntile`` settle ties by the lowest identity."""

    name: str
    kind: str
    order: tuple[Key, ...]
    partition: tuple[str, ...] = ()
    buckets: int = 10
    places: int | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown rank kind {self.kind!r}")


def _null_safe_join(rows: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns in which NULL equals NULL. Adaptive execution broadcasts the small side when it turns out small."""
    renamed = small.select(*[F.col(c).alias(f"_by_{c}") if c in on else F.col(c) for c in small.columns])
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return rows.join(renamed, condition, how).drop(*[f"_by_{c}" for c in on])


# Rows that a task sorts and numbers. Up to 200 partitions a shuffle writes without sorting, so larger chunks come before
# more of them.
CHUNK_ROWS, MOST_CHUNK_ROWS, CHUNKS = 100_000, 2_000_000, 200


def _chunks(rows: int) -> int:
    """How many chunks ``rows`` rows are dealt to, so that the memory of a task does not grow with the table."""
    return max(2, min(-(-rows // CHUNK_ROWS), CHUNKS), -(-rows // MOST_CHUNK_ROWS))


def _positions(rows: DataFrame, group: Sequence[str], keys: Sequence[str], ties: Sequence[str], chunks: int) -> DataFrame:
    """Add ``_pos``, ``_rank``, ``_dense``, ``_rows`` (group size), ``_keys`` (different keys of the group) and ``_least`` (the
    lowest of them) by ascending ``keys``.

    ``ties`` make every row distinct, so range partitioning can also cut through a run of equal keys
    that is larger than a task should hold. ``chunks`` is said outright: adaptive execution merges partitions by their
    compressed bytes, which may be many times as much in memory.
    """
    chunked = rows.repartitionByRange(chunks, *group, *keys, *ties).withColumn("_chunk", F.spark_partition_id())
    chunked = chunked.repartition(chunks, "_chunk")
    here = Window.partitionBy("_chunk", *group)
    local = chunked.select(
        "*",
        F.row_number().over(here.orderBy(*keys, *ties)).alias("_row"),
        F.rank().over(here.orderBy(*keys)).alias("_first"),
        F.dense_rank().over(here.orderBy(*keys)).alias("_nth"),
        F.lead(F.lit(False), 1, True).over(here.orderBy(*keys, *ties)).alias("_end"),
    )
    # Range bounds come from a sample and differ between runs. The numbers are read twice below and
    # must agree, also after a lost executor, so the numbered rows are written out here.
    local = cut_lineage(local)
    # All that is known of a chunk stands in its first and last row.
    key = F.struct(*keys)
    chunks = local.where((F.col("_row") == 1) | F.col("_end")).groupBy("_chunk", *group).agg(
        F.max("_row").alias("n"),
        F.max("_nth").alias("d"),
        F.max("_first").alias("last_start"),
        F.min_by(key, "_row").alias("head"),
        F.max_by(key, "_row").alias("tail"),
    )
    # One row per chunk and group from here on.
    along = Window.partitionBy(*group).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        chunks.withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("runs_on", F.coalesce(F.col("head").eqNullSafe(F.lag("tail").over(along)), F.lit(False)))
        .withColumn("new_keys", F.col("d") - F.col("runs_on").cast("int"))
        .withColumn("keys_before", F.coalesce(F.sum("new_keys").over(before), F.lit(0)))
        .withColumn(
            "tail_start",
            F.when(~(F.col("runs_on") & (F.col("d") == 1)), F.col("rows_before") + F.col("last_start")),
        )
        .withColumn("head_start", F.last("tail_start", ignorenulls=True).over(before))
        .withColumn("_rows", F.sum("n").over(Window.partitionBy(*group)))
        .withColumn("_keys", F.sum("new_keys").over(Window.partitionBy(*group)))
        .withColumn("_least", F.min_by("head", "_chunk").over(Window.partitionBy(*group)))
        .select(*group, "_chunk", "rows_before", "keys_before", "runs_on", "head_start", "_rows", "_keys", "_least")
    )
    # Written out, its size is known: a small one is broadcast and the rows stay where they are.
    placed = _null_safe_join(local, cut_lineage(chunks), ["_chunk", *group])
    return placed.select(
        *rows.columns,
        (F.col("rows_before") + F.col("_row")).alias("_pos"),
        F.when(F.col("runs_on") & (F.col("_first") == 1), F.col("head_start"))
        .otherwise(F.col("rows_before") + F.col("_first"))
        .alias("_rank"),
        (F.col("keys_before") - F.col("runs_on").cast("int") + F.col("_nth")).alias("_dense"),
        "_rows",
        "_keys",
        "_least",
    )


def _slot_type(dtype: T.DataType) -> str:
    """The column type in which a sort key is compared."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "double"
    if isinstance(dtype, T.IntegralType):
        return "bigint"
    if isinstance(dtype, T.DecimalType):
        return dtype.simpleString()
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
        return "bigint"
    if isinstance(dtype, T.StringType):
        return "string"
    raise TypeError(f"no order of {dtype.simpleString()} keys")


def _comparable(column: Column, dtype: T.DataType) -> Column:
    """The key as a number or a text in the same order."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(column)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(column.cast("timestamp"), F.current_timezone()))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.BooleanType):
        return column.cast("int")
    return column


def _backwards(value: Column, slot_type: str) -> Column:
    """The key in the opposite order: negated, or a text with complemented bytes and an end mark above them all."""
    if slot_type != "string":
        return -value
    return F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("Z"))


def _sort_columns(
    keys: Sequence[Key], schema: T.StructType, types: dict[str, str], layout: Sequence[Sequence[str]]
) -> list[Column]:
    """The keys of one order as columns whose plain ascending order is the wanted order.

    Each slot of ``layout`` has a flag, which places NULL and NaN, and one value column per type that
    any order needs there. Values are turned round for descending order. So measures of different types
    can be sorted in one pass, and narrow types stay narrow.
    """
    columns = []
    for slot, slot_types in enumerate(layout):
        key = keys[slot] if slot < len(keys) else None
        flag, value, own = F.lit(2), None, None
        if key is not None:
            value, own = _comparable(F.col(key.column), schema[key.column].dataType), types[key.column]
            if own == "double":
                flag = F.when(F.isnan(value), F.lit(1 if key.descending else 3)).otherwise(flag)
                value = F.when(~F.isnan(value), value)
            flag = F.when(F.col(key.column).isNull(), F.lit(4 if key.nulls_last else 0)).otherwise(flag)
            value = _backwards(value, own) if key.descending else value
        columns.append(flag.cast("tinyint").alias(f"_f{slot}"))
        for n, slot_type in enumerate(slot_types):
            here = value if slot_type == own else F.lit(None)
            columns.append(here.cast(slot_type).alias(f"_v{slot}_{n}"))
    return columns


def _value(rank: Rank) -> Column:
    position, size = F.col("_pos"), F.col("_rows")
    if rank.kind == "row_number":
        return position
    if rank.kind == "rank":
        return F.col("_rank")
    if rank.kind == "dense_rank":
        return F.col("_dense")
    if rank.kind == "percent_rank":
        share = F.when(size > 1, (F.col("_rank") - 1) / (size - 1)).otherwise(F.lit(0.0))
        return F.round(share, rank.places) if rank.places is not None else share
    # The first size % buckets buckets hold one row more than the rest.
    small = F.floor(size / rank.buckets)
    large_rows = (size - small * rank.buckets) * (small + 1)
    return F.when(
        position <= large_rows, F.floor((position - 1) / (small + 1)) + 1
    ).otherwise(F.floor((position - 1 - (size - small * rank.buckets)) / F.greatest(small, F.lit(1))) + 1)


def _mirrored(order: Sequence[Key]) -> tuple[Key, ...]:
    """The same order from its other end."""
    return tuple(Key(k.column, not k.descending, not k.nulls_last) for k in order)


def _read_backwards(rank: Rank, orders: Sequence[tuple]) -> tuple[int, Column] | None:
    """The number of an order that has a dense rank's keys the other way round, and the rank as it is worked out there.

    The keys of a group are counted from its end. Where NULL comes first both ways, it stays the first.
    """
    from_end = F.col("_keys") + 1 - F.col("_dense")
    mirror = (rank.partition, _mirrored(rank.order))
    if mirror in orders:
        return orders.index(mirror), from_end
    turned = (rank.partition, tuple(Key(k.column, not k.descending, k.nulls_last) for k in rank.order))
    if len(rank.order) == 1 and not rank.order[0].nulls_last and turned in orders:
        return orders.index(turned), F.when(F.col("_null"), 1).otherwise(from_end + F.col("_nulls").cast("int"))
    return None


def _placed_orders(ranks: Sequence[Rank]) -> tuple[list[tuple], list[tuple[int, Column]]]:
    """The orders that rows must be sorted in and, for each rank, the number of one of them and the rank's value there."""
    orders = list(dict.fromkeys((r.partition, r.order) for r in ranks if r.kind != "dense_rank"))
    for r in ranks:
        if (r.partition, r.order) not in orders and _read_backwards(r, orders) is None:
            orders.append((r.partition, r.order))
    values = []
    for r in ranks:
        own = (r.partition, r.order)
        values.append((orders.index(own), _value(r)) if own in orders else _read_backwards(r, orders))
    return orders, values


def global_ranks(df: DataFrame, identity: Sequence[str], ranks: Sequence[Rank]) -> DataFrame:
    """``identity`` columns plus one column per rank, over all rows of ``df``.

    ``identity`` must be unique and known. All sort orders are stacked into narrow rows and
    range-partitioned together, so any number of ranks costs one range shuffle and one regrouping by
    identity. A dense rank whose keys another rank sorts the other way round is read off that one's order. Join the result
    back on ``identity`` for the other columns.
    """
    orders, found = _placed_orders(ranks)
    used = {key.column for _, order in orders for key in order}
    types = {f.name: _slot_type(f.dataType) for f in df.schema.fields if f.name in used}
    layout = [
        sorted({types[order[slot].column] for _, order in orders if slot < len(order)})
        for slot in range(max(len(order) for _, order in orders))
    ]
    stacked = []
    for number, (partition, order) in enumerate(orders):
        part = F.to_json(F.struct(*partition)) if partition else F.lit("")
        columns = [F.lit(number).cast("tinyint").alias("_order"), part.alias("_part")]
        stacked.append(F.struct(*columns, *_sort_columns(order, df.schema, types, layout)))
    rows = df.select(*identity, F.inline(F.array(*stacked)))
    keys = [c for c in rows.columns if c.startswith(("_f", "_v"))]
    chunks = _chunks(df.count() * len(orders))
    placed = _positions(rows, ["_order", "_part"], keys, identity, chunks)
    values = [F.max(F.when(F.col("_order") == n, value)).alias(r.name) for r, (n, value) in zip(ranks, found, strict=True)]
    nulls = {"_null": F.col("_f0") == 0, "_nulls": F.col("_least._f0") == 0}
    placed = placed.withColumns(nulls).drop("_least")
    # The rows of one identity lie far apart, so nothing is gained by grouping before the shuffle.
    return placed.repartition(chunks, *identity).groupBy(*identity).agg(*values)


def window_ranks(df: DataFrame, identity: Sequence[str], ranks: Sequence[Rank]) -> DataFrame:
    """The same columns by plain windows, added to ``df``.

    For tables with a proven small bound (one row per year or per genre), where a single sorting task
    is the cheapest plan.
    """
    for r in ranks:
        order = [k.column_order() for k in r.order]
        if r.kind in ("row_number", "ntile"):
            order += [F.col(c).asc() for c in identity]
        function = F.ntile(r.buckets) if r.kind == "ntile" else getattr(F, r.kind)()
        value = function.over(Window.partitionBy(*r.partition).orderBy(*order))
        if r.places is not None:
            value = F.round(value, r.places)
        df = df.withColumn(r.name, value)
    return df


# Share of a group kept on each side of its approximate median, and the sketch's accuracy. The share
# is well above the sketch's error of 1 / accuracy; a group that it still misses is taken whole.
MEDIAN_MARGIN = 0.002
MEDIAN_ACCURACY = 10_000


def group_medians(
    df: DataFrame, group: Sequence[str], values: Sequence[str], identity: Sequence[str]
) -> DataFrame:
    """Exact median of each value column per group, NULLs skipped.

    The built-in exact median keeps all distinct values of a group in one task; here a group may be
    any share of the table. A quantile sketch (combined on the map side) brackets the middle of each
    group, one more pass counts what lies below and on the bracket, and only the few rows strictly
    inside it are sorted. A value that fills the middle of a group is a bracket end, and its rows are
    only counted.

    ``identity`` columns tell rows apart. Values of one call must share a type. A NULL key is a group like any other.
    The narrow rows are written once and read by each pass.
    """
    rows = cut_lineage(df.select(*group, *identity, *values))
    every = list(enumerate(values))
    ends = [0.5 - MEDIAN_MARGIN, 0.5 + MEDIAN_MARGIN]
    sketches = [F.percentile_approx(v, ends, MEDIAN_ACCURACY).alias(f"b{i}") for i, v in every]
    bracket = rows.groupBy(*group).agg(*sketches)
    lows_highs = [F.col(f"b{i}")[k].alias(f"{end}{i}") for i, _ in every for k, end in enumerate(("lo", "hi"))]
    # Written out, its size is known: a small one is broadcast, else all rows of a group would meet in one task.
    bracket = cut_lineage(bracket.select(*group, *lows_highs))

    counts = []
    for i, name in every:
        v, lo, hi = F.col(name), F.col(f"lo{i}"), F.col(f"hi{i}")
        counts += [
            F.first(lo).alias(f"lo{i}"),
            F.first(hi).alias(f"hi{i}"),
            F.count(v).alias(f"n{i}"),
            F.count_if(v < lo).alias(f"below{i}"),
            F.count_if(v == lo).alias(f"at{i}"),
            F.count_if((v > lo) & (v < hi)).alias(f"inside{i}"),
            F.count_if((v == hi) & (lo < hi)).alias(f"top{i}"),
        ]
    sizes = _null_safe_join(rows, bracket, group).groupBy(*group).agg(*counts)
    kept = list(group)
    for i, _ in every:
        n, below, at, inside = (F.col(f"{c}{i}") for c in ("n", "below", "at", "inside"))
        first, last = F.floor((n + 1) / 2), F.floor(n / 2) + 1
        missed = (first <= below) | (last > below + at + inside + F.col(f"top{i}"))
        skipped = F.when(missed, 0).otherwise(below + at)
        kept += [
            F.when(~missed, F.col(f"lo{i}")).alias(f"lo{i}"),
            F.when(~missed, F.col(f"hi{i}")).alias(f"hi{i}"),
            F.when(missed, n).otherwise(inside).alias(f"inside{i}"),
            (first - skipped).alias(f"first{i}"),
            (last - skipped).alias(f"last{i}"),
        ]
    sizes = cut_lineage(sizes.select(*kept))

    inner = []
    for i, name in every:
        v, lo, hi = F.col(name), F.col(f"lo{i}"), F.col(f"hi{i}")
        taken = F.when(lo.isNull() | ((v > lo) & (v < hi)), v)
        inner.append(F.struct(F.lit(i).alias("_m"), taken.alias("_v")))
    middle = _null_safe_join(rows, sizes, group).select(*group, *identity, F.inline(F.array(*inner)))
    inside = sizes.agg(*[F.sum(f"inside{i}") for i, _ in every]).first()
    placed = _positions(middle.filter("_v is not null"), ["_m", *group], ["_v"], identity, _chunks(sum(n or 0 for n in inside)))
    picks = [
        F.max(F.when((F.col("_m") == i) & (F.col("_pos") == F.col(f"{p}{i}")), F.col("_v"))).alias(f"_{p}{i}")
        for i, _ in every
        for p in ("first", "last")
    ]
    picked = _null_safe_join(placed, sizes, group).groupBy(*group).agg(*picks)

    def found(p: str, i: int) -> Column:
        """The value at one middle position: on the low end, on the high end, or between them."""
        at = F.col(f"{p}{i}")
        on_high = F.when(at > F.col(f"inside{i}"), F.col(f"hi{i}")).otherwise(F.col(f"_{p}{i}"))
        return F.when(at <= 0, F.col(f"lo{i}")).otherwise(on_high)

    medians = [((found("first", i) + found("last", i)) / 2).alias(name) for i, name in every]
    return _null_safe_join(sizes, picked, group, "left").select(*group, *medians)


def change_from_previous(df: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """Add ``previous_<column>`` from the row before by ``order``.

    It is the previous row, so a gap in ``order`` gives a change over several steps. For aggregated
    tables with a small bound only: the window has no partition.
    """
    before = Window.orderBy(order)
    return df.withColumns({f"previous_{c}": F.lag(c, 1).over(before) for c in columns})
