"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the text hashed in place of NULL.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: Column) -> Column:
    """MD5 hex key of one or more columns, NULL-safe."""
    if not columns:
        raise ValueError("surrogate_key needs at least one column")
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def document_hash(doc: Column) -> Column:
    """MD5 of a VARIANT's JSON text. Object keys are sorted in it, so key order does not matter."""
    return F.md5(F.to_json(doc))


def version_id(*columns: Column) -> Column:
    """MD5 id of one row version, from its key and start time."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))
