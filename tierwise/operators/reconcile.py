"""Two states of a table against each other, as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def row_counts(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every different row of either side with ``n_left`` and ``n_right``; NULL equals NULL.

    Both sides are counted in one grouping with partial counts, so a row that occurs any number of times travels once
    per task.
    """
    columns = list(columns or left.columns)
    marked = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return marked.groupBy(*columns).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))


def differences(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that the two sides do not have equally often, with both counts."""
    return row_counts(left, right, columns).where("n_left <> n_right")


def _times(rows: DataFrame, n) -> DataFrame:
    kept = [c for c in rows.columns if c not in ("n_left", "n_right")]
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), n.cast("bigint")))
    return rows.where(n > 0).select(*kept, copies.alias("_copy")).drop("_copy")


def except_rows(left: DataFrame, right: DataFrame, all_copies: bool = False) -> DataFrame:
    """EXCEPT [ALL]: rows of ``left`` that ``right`` does not have, or their surplus copies."""
    counts = row_counts(left, right)
    if all_copies:
        return _times(counts, F.col("n_left") - F.col("n_right"))
    return counts.where("n_left > 0 and n_right = 0").drop("n_left", "n_right")


def intersect_rows(left: DataFrame, right: DataFrame, all_copies: bool = False) -> DataFrame:
    """INTERSECT [ALL]: rows of both sides, once or as often as the rarer side has them."""
    counts = row_counts(left, right)
    if all_copies:
        return _times(counts, F.least("n_left", "n_right"))
    return counts.where("n_left > 0 and n_right > 0").drop("n_left", "n_right")


def union_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION DISTINCT."""
    return row_counts(left, right).drop("n_left", "n_right")
