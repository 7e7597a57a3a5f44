"""Versioned (slowly changing, type 2) tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.functions.keys import version_id
from tierwise.operators.sequences import framed

VERSION_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def open_versions(current: DataFrame, key: str, as_of: Column, prefix: str = "") -> DataFrame:
    """First snapshot: one open version per row of ``current``."""
    stamp = as_of.cast("timestamp_ntz")
    return current.select(
        "*",
        version_id(F.col(key), stamp).alias(f"{prefix}scd_id"),
        stamp.alias(f"{prefix}updated_at"),
        stamp.alias(f"{prefix}valid_from"),
        F.lit(None).cast("timestamp_ntz").alias(f"{prefix}valid_to"),
    )


def snapshot(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: Column,
    hard_deletes: bool = True,
    prefix: str = "",
) -> DataFrame:
    """Next state of a version table.

    A new key opens a version; a changed ``check`` column (NULL-safe) closes the old one and opens
    another; a key gone from ``current`` is closed when ``hard_deletes``; a key that returns opens
    again. Other columns are stored but never open a version. A column new in ``current`` is kept,
    NULL in older versions. Taken twice at one moment, the second changes the version that the first
    opened, instead of opening another.
    """
    if history is None:
        return open_versions(current, key, as_of, prefix)
    is_open = F.col(f"{prefix}valid_to").isNull()
    moved = next_versions(history.filter(is_open), current, key, check, as_of, hard_deletes, prefix)
    return history.filter(~is_open).unionByName(moved, allowMissingColumns=True)


def next_versions(
    opened: DataFrame,
    current: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: Column,
    hard_deletes: bool = True,
    prefix: str = "",
) -> DataFrame:
    """The open versions after a snapshot, and those it closes; closed versions of before play no part.

    Open versions and current rows meet in one full outer join on the unique key, and each pair
    yields its one or two rows there, so both sides are read and shuffled once.
    """
    valid_from, valid_to = f"{prefix}valid_from", f"{prefix}valid_to"
    fresh = open_versions(current, key, as_of, prefix)
    missing = set(opened.columns) - set(fresh.columns)
    if missing:
        raise ValueError(f"the current rows lack the columns {sorted(missing)}")
    columns = [*opened.columns, *[c for c in fresh.columns if c not in opened.columns]]
    types = {f.name: f.dataType for f in (*fresh.schema.fields, *opened.schema.fields)}
    old_columns = [(F.col(c) if c in opened.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns]
    new_columns = [F.col(c).cast(types[c]).alias(c) for c in columns]
    old = opened.select(F.col(key).alias("_old_key"), F.struct(*old_columns).alias("_old"))
    new = fresh.select(F.col(key).alias("_new_key"), F.struct(*new_columns).alias("_new"))
    pairs = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    has_old, has_new = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    changed = reduce(
        lambda a, b: a | b, [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check]
    )
    stamp = as_of.cast("timestamp_ntz")
    same_moment = F.col(f"_old.{valid_from}") == stamp
    expire = has_old & ((has_new & changed) | (~has_new & F.lit(hard_deletes)))
    expired = F.when(~same_moment, F.col("_old").withField(valid_to, stamp))
    versions = F.array(
        F.when(has_old, F.when(expire, expired).otherwise(F.col("_old"))),
        F.when(has_new & (~has_old | changed), F.col("_new")),
    )
    return pairs.select(F.explode(versions).alias("v")).filter("v is not null").select("v.*")


def as_of_rows(history: DataFrame, moment: Column, prefix: str = "") -> DataFrame:
    """The versions in force at ``moment``; intervals are half open."""
    start, end = F.col(f"{prefix}valid_from"), F.col(f"{prefix}valid_to")
    return history.filter((start <= moment) & ((end > moment) | end.isNull()))


def version_status(history: DataFrame, prefix: str = "", column: str = "version_status") -> DataFrame:
    """Add ACTIVE or EXPIRED to every version."""
    is_open = F.col(f"{prefix}valid_to").isNull()
    return history.withColumn(column, F.when(is_open, F.lit("ACTIVE")).otherwise(F.lit("EXPIRED")))


def dated_versions(history: DataFrame | None, arrived: DataFrame, key: str, moment: str, prefix: str = "") -> DataFrame:
    """Next state of a version table whose rows carry the moment of their change; rows may arrive late.

    Each different moment of a key is a version from then on until the key's next one. A row that arrives late splits the
    version in force at its moment; a row older than all becomes the first. Of several rows of a key with one moment the
    one that is last by its values stays, so the history does not depend on the order or number of arrivals. Rows without a
    key or a moment are left out. Keys that did not arrive keep their versions untouched.

    Intervals are repaired per key along (key, moment) in blocks of equal size, so a key may have any share of the versions.
    """
    added = ("scd_id", "updated_at", "valid_from", "valid_to")
    values = [c for c in arrived.columns]
    fresh = arrived.where(F.col(key).isNotNull() & F.col(moment).isNotNull())
    kept = None
    if history is not None:
        missing = set(history.columns) - {f"{prefix}{c}" for c in added} - set(values)
        if missing:
            raise ValueError(f"the arrived rows lack the columns {sorted(missing)}")
        keys = fresh.select(F.col(key).alias("_key")).distinct()
        touched = history.join(keys, F.col(key) == F.col("_key"), "left_semi")
        kept = history.join(keys, F.col(key) == F.col("_key"), "left_anti")
        old = [c for c in values if c in history.columns]
        fresh = fresh.unionByName(touched.select(*old), allowMissingColumns=True)
    rest = [c for c in values if c not in (key, moment)]
    one = fresh.groupBy(key, moment).agg(F.max(F.struct(*rest, F.lit(0).alias("_one"))).alias("_rest"))
    one = one.select(key, moment, *[F.col(f"_rest.`{c}`").alias(c) for c in rest]).select(*values)
    stamp = F.col(moment).cast("timestamp_ntz")
    dated = one.select(
        "*", version_id(F.col(key), stamp).alias(f"{prefix}scd_id"), stamp.alias(f"{prefix}updated_at"), stamp.alias(f"{prefix}valid_from")
    )
    start, end = f"{prefix}valid_from", f"{prefix}valid_to"
    repaired = framed(dated, [key, moment], [start], {end: (F.first(start), 1, 1)}, partition=[key])
    return repaired if kept is None else kept.unionByName(repaired, allowMissingColumns=True)
