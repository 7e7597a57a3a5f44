"""Incremental windows, upserts and rewrites of keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.operators.dedup import keep_latest
from tierwise.operators.ranking import _chunks


def high_water_mark(target: DataFrame, stamp: str) -> str | None:
    """Newest load time in ``target`` as text: one aggregated row."""
    return target.agg(F.max(stamp).cast("string").alias("newest")).first()["newest"]


def since_lookback(source: DataFrame, stamp: str, mark: str | None, days: int = 3) -> DataFrame:
    """Source rows no older than ``days`` before the mark.

    The bound folds to a literal of the column's own type, so it reaches the file scan. No mark (an
    absent or empty target) keeps every row; a plain comparison with a NULL maximum would load
    nothing, for ever.
    """
    if mark is None:
        return source
    bound = F.lit(mark).cast(source.schema[stamp].dataType) - F.make_dt_interval(F.lit(days))
    return source.filter(F.col(stamp) >= bound)


def repeated_key(df: DataFrame, keys: Sequence[str]) -> list:
    """One key that occurs twice, if there is any. Of the rows only the key columns are read."""
    return df.groupBy(*keys).count().filter("count > 1").limit(1).collect()


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice: a merge must not pick a row at random."""
    twice = repeated_key(df, keys)
    if twice:
        raise ValueError(f"duplicate merge key {twice[0].asDict()}")


def add_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both sides by column name. Columns new to the table are kept, NULL in its old rows; a column that the incoming rows
    lack is an error."""
    missing = set(existing.columns) - set(incoming.columns)
    if missing:
        raise ValueError(f"the incoming rows lack the columns {sorted(missing)}")
    return existing.unionByName(incoming, allowMissingColumns=True)


def merge_upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], newest: str | None = None, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """Replace matched rows, add new ones, keep the rest.

    With ``newest`` the incoming side is first reduced to its newest row per key, ties settled by ``ties``; without it the
    caller vouches for unique keys, see :func:`require_unique`.
    """
    if newest is not None:
        incoming = keep_latest(incoming, keys, newest, ties)
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti").select(*existing.columns)
    return add_rows(kept, incoming)


def replace_children(existing: DataFrame, incoming: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Replace all children of every incoming parent.

    A merge on (parent, child) leaves children that the parent no longer lists; this does not. A
    parent that now has no children must be passed through :func:`purge_keys`.
    """
    parents = incoming.select(*parent).distinct()
    kept = existing.join(parents, list(parent), "left_anti").select(*existing.columns)
    return add_rows(kept, incoming)


def purge_keys(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``doomed``."""
    return df.join(doomed.select(*keys).distinct(), list(keys), "left_anti").select(*df.columns)


def incremental(
    build: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    source_stamp: str,
    target: DataFrame | None,
    target_stamp: str,
    keys: Sequence[str],
    lookback_days: int = 3,
    full_refresh: bool = False,
    children_of: Sequence[str] | None = None,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    """Build a keyed table from the recent part of ``source`` and merge it into ``target``.

    The first run and ``full_refresh`` build from everything. ``children_of`` names the parent key
    of a bridge table: every parent in the window then loses its old children, also when its new
    array is empty, instead of a merge on ``keys``. A table of aggregates must rebuild whole groups: pass ``group_by``,
    and ``build`` gets all source rows of the groups that have a row in the window.
    """
    if target is None or full_refresh:
        return build(source)
    recent = since_lookback(source, source_stamp, high_water_mark(target, target_stamp), lookback_days)
    if group_by:
        # Said outright: adaptive execution merges partitions by their compressed bytes, which may be many times as much
        # in memory, and whole groups are joined, sorted and rebuilt in them. A semi join would be moved before the
        # repartition, into merged partitions again; the groups are distinct, so an inner one gives the same rows.
        parts = max(_chunks(source.count()), int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        groups = recent.select(*group_by).distinct().repartition(parts, *group_by)
        recent = source.repartition(parts, *group_by).join(groups, list(group_by)).select(*source.columns)
    incoming = build(recent)
    if children_of:
        return add_rows(purge_keys(target, recent, children_of), incoming)
    return merge_upsert(target, incoming, keys)
