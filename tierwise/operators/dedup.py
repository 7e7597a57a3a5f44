"""Keep-one-row operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark turns "row_number() = 1" into a group limit below the shuffle, so each map task sends at
    # most one row per key and a key that holds a third of the table does not pile up in one task.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def keep_latest(df: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the newest, ties settled by the highest ``ties`` values (names or expressions)."""
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in (newest, *ties)]
    return _first_per_key(df, keys, order)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the lowest by ``order``. Drops ids repeated across listing pages."""
    return _first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def lowest_child(df: DataFrame, parent: str, child: str) -> DataFrame:
    """The lowest child value of each parent, as a plain pre-aggregated minimum."""
    return df.groupBy(parent).agg(F.min(child).alias(child)).filter(F.col(child).isNotNull())


def latest_row(df: DataFrame, newest: str, ties: Sequence[str] = ()) -> DataFrame:
    """The single newest row of a table, as a top-1 that never sorts the table in one task."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in (newest, *ties)]).limit(1)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all known."""
    return df.na.drop(subset=list(keys))
