"""Totals over several groupings at once, and counts of distinct values that can be merged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

#: Aggregates whose parts can be put together again, by the one that does it.
COMBINED_BY = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
#: Registers of a distinct-count state, as a power of two: a standard error of 0.8 %.
LG_REGISTERS = 14


def rollup_sets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    """All columns, then one less from the end each time, down to the grand total."""
    return [tuple(columns[:n]) for n in range(len(columns), -1, -1)]


def cube_sets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    """Every subset of the columns."""
    return [c for n in range(len(columns), -1, -1) for c in combinations(columns, n)]


def grouped_sets(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    values: Mapping[str, tuple[str, Column]],
    having: Column | None = None,
    grouping_id: str = "grouping_id",
) -> DataFrame:
    """Aggregates per group of every set of columns, with the number of the set in ``grouping_id``.

    ``values`` maps output names to (sum, count, min or max; column). A column outside of a set is NULL and has its bit set in
    ``grouping_id`` (the last column has the lowest bit), so a group whose own value is NULL is told from a total.
    ``having`` filters the groups. Sets that occur twice count once.

    The rows are grouped once, by all columns; only these groups are multiplied by the sets.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    unknown = {kind for kind, _ in values.values()} - set(COMBINED_BY)
    if unknown:
        raise ValueError(f"no parts of {sorted(unknown)} can be put together")
    parts = df.groupBy(*columns).agg(*[getattr(F, kind)(column).alias(f"_part_{name}") for name, (kind, column) in values.items()])
    whole = [COMBINED_BY[kind](f"_part_{name}").alias(name) for name, (kind, _) in values.items()]
    # A count of no rows at all is 0 and not NULL.
    whole = [F.coalesce(w, F.lit(0)).alias(name) if kind == "count" else w for w, (name, (kind, _)) in zip(whole, values.items(), strict=True)]
    distinct = list(dict.fromkeys(tuple(sorted(s, key=columns.index)) for s in sets))
    if not columns:
        out = parts.agg(*whole).withColumn(grouping_id, F.lit(0).cast("bigint"))
    else:
        grouped = parts.groupingSets([[F.col(c) for c in s] for s in distinct], *[F.col(c) for c in columns])
        out = grouped.agg(F.grouping_id().cast("bigint").alias(grouping_id), *whole)
    return out if having is None else out.where(having)


def distinct_states(df: DataFrame, group: Sequence[str], column: str, state: str = "state", lg_registers: int = LG_REGISTERS) -> DataFrame:
    """One state per group, from which the number of distinct non-null values can be told, alone or merged with others.

    A state has a fixed size; states of any groups, also of overlapping rows, can be merged.
    """
    return df.where(F.col(column).isNotNull()).groupBy(*group).agg(F.hll_sketch_agg(column, F.lit(lg_registers)).alias(state))


def merge_states(states: DataFrame, group: Sequence[str], state: str = "state") -> DataFrame:
    """The states of coarser groups, or of stored states and those of new rows, without the rows."""
    return states.groupBy(*group).agg(F.hll_union_agg(state, F.lit(True)).alias(state))


def distinct_estimate(state: Column | str) -> Column:
    return F.hll_sketch_estimate(state)
