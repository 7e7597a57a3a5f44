"""Dimension lookups, range joins and point-in-time joins.

Nothing is broadcast by hint but intervals that were counted. Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond, and adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierwise.sources.shared_folder import cut_lineage

#: Intervals that a range join compares one by one at most; more are joined through a tree of slots.
MAX_INTERVALS = 1_000
#: Parts of the line in a range join, and tree nodes that are broadcast at most; beyond, probes are dealt over so many tasks.
MAX_PARTS = 2048
BROADCAST_ROWS = 200_000
PROBE_WAYS = 8
_NULL_WAYS = 4096


def _nulls_apart(rows: DataFrame, on: Sequence[str], by: Sequence[str] | None) -> tuple[DataFrame, Column]:
    """Deal rows without a key over many partitions: they match nothing, and must not meet in one task."""
    if not by:
        return rows, F.lit(True)
    unknown = F.lit(False)
    for key in on:
        unknown = unknown | F.col(key).isNull()
    ways = F.when(unknown, F.pmod(F.xxhash64(*by), F.lit(_NULL_WAYS))).otherwise(-1)
    return rows.withColumn("_ways", ways), F.col("_ways") == F.col("_matched")


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
    how: str = "left",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``rows`` to a dimension that is unique on its key.

    ``on`` maps row columns to dimension columns and ``columns`` output names to dimension columns.
    Unmatched rows keep NULL, or the unknown member in ``defaults``. Set ``spread_by`` (columns that
    differ between rows) when a large share of the rows may have no key: these are then dealt
    over many tasks. Hot keys are split by adaptive execution.
    """
    keep, defaults = rows.columns, defaults or {}
    side = dimension.select(
        *[F.col(d).alias(f"_on_{i}") for i, d in enumerate(on.values())],
        *[F.col(d).alias(f"_out_{name}") for name, d in columns.items()],
        F.lit(-1).cast("long").alias("_matched"),
    )
    left, condition = _nulls_apart(rows, list(on), spread_by)
    for i, key in enumerate(on):
        condition = condition & (F.col(key) == F.col(f"_on_{i}"))
    joined = left.join(side, condition, how)
    found = []
    for name in columns:
        value = F.col(f"_out_{name}")
        found.append((F.coalesce(value, F.lit(defaults[name])) if name in defaults else value).alias(name))
    return joined.select(*keep, *found)


def _cuts(points: DataFrame, column: str, parts: int) -> list[str]:
    """Ascending values, as text, that cut the points into about equal parts; a value that fills several parts comes as often."""
    kind = points.schema[column].dataType
    if isinstance(kind, T.StringType):
        # A sample of the different values, those with the smallest hashes.
        some = points.select(column).distinct().orderBy(F.xxhash64(column)).limit(parts - 1)
        return sorted((r[0] for r in some.collect()), key=str.encode)
    shares = [i / parts for i in range(1, parts)]
    plain = points.where(~F.isnan(column)) if isinstance(kind, (T.DoubleType, T.FloatType)) else points
    found = plain.agg(F.percentile_approx(column, shares, 10 * parts).alias("cuts"))
    return found.select(F.transform("cuts", lambda x: x.cast("string")).alias("cuts")).first()["cuts"] or []


def _part(column: str, cuts: Sequence[str], kind: T.DataType) -> str:
    """SQL for the number of ``cuts`` at or below a value, by halving."""
    literals = ["CAST('" + c.replace("\\", "\\\\").replace("'", "\\'") + f"' AS {kind.simpleString()})" for c in cuts]

    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"if({column} >= {literals[mid]}, {tree(mid + 1, high)}, {tree(low, mid)})"

    return tree(0, len(literals))


def _segments(placed: DataFrame, levels: int) -> DataFrame:
    """The nodes (level, node) that cover the slots from ``_i`` up to ``_j``: at most two of each level of a binary tree."""
    left, right = "shiftright(_i + shiftleft(1L, k) - 1, k)", "shiftright(_j, k)"
    odd_left = f"if({left} < {right} and {left} % 2 = 1, {left}, -1L)"
    odd_right = f"if({left} < {right} and {right} % 2 = 1, {right} - 1, -1L)"
    nodes = f"flatten(transform(sequence(0, {levels - 1}), k -> array(struct(k as level, {odd_left} as node), struct(k as level, {odd_right} as node))))"
    return placed.select(F.expr(f"inline(filter({nodes}, x -> x.node >= 0))"), "_out")


def range_lookup(
    rows: DataFrame,
    value: str,
    intervals: DataFrame,
    low: str,
    high: str | None,
    columns: Mapping[str, str],
    max_intervals: int = MAX_INTERVALS,
) -> DataFrame:
    """Left join on ``low <= value < high``; a NULL ``high`` is open, and without ``high`` an interval ends where the next begins.

    Intervals may overlap, in any number; a row gets one output row for each that holds its value, or one with NULLs.
    Up to ``max_intervals`` intervals (counted here) are broadcast and compared one by one. Beyond, the bounds cut the line
    into slots. An interval is written as the few nodes of a binary tree over the slots that cover it exactly, and a row
    whose slot is s meets the node s >> level on every level that some interval uses, by an equi-join. A row's slot
    comes from a window over parts of the line, which hold equal shares of rows and bounds; a value that fills several
    parts is dealt over as many tasks.
    """
    keep = rows.columns
    outs = [F.col(c).alias(name) for name, c in columns.items()]
    side = intervals.select(F.col(low).alias("_low"), (F.col(high) if high else F.lit(None)).alias("_high"), F.struct(*outs).alias("_out"))
    if high and intervals.limit(max_intervals + 1).count() <= max_intervals:
        inside = (F.col(value) >= F.col("_low")) & ((F.col(value) < F.col("_high")) | F.col("_high").isNull())
        return rows.join(F.broadcast(side), inside, "left").select(*keep, *[F.col(f"_out.{name}").alias(name) for name in columns])
    side = side.where("_low is not null and (_high is null or _high > _low)")

    # All values that matter in one type; starts and ends of intervals at each bound.
    at = rows.select(F.col(value).alias("_at"))
    bounds = side.select(F.col("_low").alias("_at"), F.lit(1).alias("_starts"))
    if high:
        bounds = bounds.unionByName(side.where("_high is not null").select(F.col("_high").alias("_at"), F.lit(-1).alias("_starts")))
    bounds = cut_lineage(bounds.groupBy("_at").agg(F.sum("_starts").alias("_starts")))
    points = at.unionAll(bounds.select("_at")).where("_at is not null")
    kind = points.schema["_at"].dataType
    parts = min(MAX_PARTS, max(16, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = _cuts(points, "_at", parts)
    cuts = list(dict.fromkeys(found))
    part = F.expr(_part("_at", cuts, kind)).alias("_part")

    # Slots and open intervals at every bound: numbered in each part, shifted by the totals of the parts before.
    bounds = bounds.select(F.col("_at").cast(kind).alias("_at"), "_starts").select("*", part)
    totals = {r._part: r for r in bounds.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum("_starts").alias("d")).collect()}
    table, slots, cover = [], 0, 0
    for p in range(len(cuts) + 1):
        table.append((p, slots, cover, found.count(cuts[p - 1]) if p else 1))
        slots, cover = (slots + totals[p].n, cover + totals[p].d) if p in totals else (slots, cover)
    by_part = F.broadcast(rows.sparkSession.createDataFrame(table, "_part int, _slots long, _cover long, _ways int"))
    along = Window.partitionBy("_part").orderBy("_at")
    bounds = bounds.join(by_part, "_part").select(
        "_part", "_at", "_ways", (F.col("_slots") + F.row_number().over(along) - 1).alias("_slot"),
        (F.col("_cover") + F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, 0))).alias("_open"),
    )
    bounds = cut_lineage(bounds)

    first = bounds.select(F.col("_at").alias("_low_at"), F.col("_slot").alias("_i"))
    placed = side.join(first, F.col("_low").cast(kind) == F.col("_low_at"))
    if high:
        last = bounds.select(F.col("_at").alias("_high_at"), F.col("_slot").alias("_end"))
        placed = placed.join(last, F.col("_high").cast(kind) == F.col("_high_at"), "left").withColumn("_j", F.coalesce("_end", F.lit(slots)))
    else:
        placed = placed.withColumn("_j", F.col("_i") + 1)
    nodes = cut_lineage(_segments(placed, slots.bit_length() + 1))
    per_level = {r.level: r["count"] for r in nodes.groupBy("level").count().collect()}  # as many as the tree has at most
    levels = sorted(per_level)

    # Rows and bounds of a part in one order: a row's slot is that of the last bound at or below it.
    own = rows.where(F.col(value).isNotNull()).select(F.col(value).cast(kind).alias("_at"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"))
    own = own.select("*", part).join(by_part, "_part")
    own = own.select("_part", "_at", "_row", F.pmod(F.xxhash64("_row"), "_ways").cast("int").alias("_way"), "_slots", "_cover", F.lit(1).alias("_side"))
    marks = bounds.select("_part", "_at", F.explode(F.sequence(F.lit(0), F.col("_ways") - 1)).alias("_way"), F.struct("_slot", "_open").alias("_mark"), F.lit(0).alias("_side"))
    here = Window.partitionBy("_part", "_way").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    joined = own.unionByName(marks, allowMissingColumns=True).withColumn("_mark", F.last("_mark", ignorenulls=True).over(here)).where("_side = 1")
    joined = joined.select("_row", F.coalesce("_mark._slot", F.col("_slots") - 1).alias("_slot"), (F.coalesce("_mark._open", "_cover") > 0).alias("_covered"))

    # A row outside of all intervals keeps one copy, with a node that no interval has.
    wanted = F.when(F.col("_covered"), F.array(*[F.lit(x) for x in levels])).otherwise(F.array(F.lit(-1)))
    probes = joined.select("_row", "_covered", "_slot", F.explode(wanted).alias("level"))
    node = F.when(F.col("_covered"), F.expr("shiftright(_slot, greatest(level, 0))")).otherwise(-1 - F.pmod(F.xxhash64("_row"), F.lit(_NULL_WAYS)))
    probes = probes.withColumn("node", node)
    if sum(per_level.values()) <= BROADCAST_ROWS:
        met = probes.join(F.broadcast(nodes), ["level", "node"], "left")
    else:  # slots that hold many rows are dealt over several tasks
        probes = probes.withColumn("_way", F.pmod(F.xxhash64("_row", F.lit(1)), F.lit(PROBE_WAYS)).cast("int"))
        dealt = nodes.withColumn("_way", F.explode(F.sequence(F.lit(0), F.lit(PROBE_WAYS - 1))))
        met = probes.join(dealt, ["level", "node", "_way"], "left")
    met = met.where("_out is not null or not _covered").select("_row.*", *[F.col(f"_out.{name}").alias(name) for name in columns])
    return met.unionByName(rows.where(F.col(value).isNull()), allowMissingColumns=True)


def point_in_time(
    rows: DataFrame,
    history: DataFrame,
    on: Mapping[str, str],
    moment: str,
    columns: Mapping[str, str],
    prefix: str = "",
    how: str = "left",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join each row to the version in force at ``moment``.

    Version intervals are half open, so a row on a boundary meets exactly one version.
    """
    keep = rows.columns
    side = history.select(
        *[F.col(d).alias(f"_on_{i}") for i, d in enumerate(on.values())],
        F.col(f"{prefix}valid_from").alias("_from"),
        F.col(f"{prefix}valid_to").alias("_to"),
        *[F.col(d).alias(f"_out_{name}") for name, d in columns.items()],
        F.lit(-1).cast("long").alias("_matched"),
    )
    left, condition = _nulls_apart(rows, list(on), spread_by)
    for i, key in enumerate(on):
        condition = condition & (F.col(key) == F.col(f"_on_{i}"))
    t = F.col(moment)
    condition = condition & (t >= F.col("_from")) & ((t < F.col("_to")) | F.col("_to").isNull())
    return left.join(side, condition, how).select(
        *keep, *[F.col(f"_out_{name}").alias(name) for name in columns]
    )


def unmatched(rows: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with a known key that the parent table does not hold."""
    side = parent.select(*[F.col(p).alias(f"_on_{i}") for i, p in enumerate(on.values())])
    condition = F.lit(True)
    for i, key in enumerate(on):
        condition = condition & (F.col(key) == F.col(f"_on_{i}"))
    return rows.na.drop(subset=list(on)).join(side, condition, "left_anti")
