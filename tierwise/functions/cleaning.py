"""Typed extraction, NULL clean-up and labelling of single columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

WHOLE_NUMBERS = {"byte", "short", "int", "integer", "long", "bigint"}


def variant_field(doc: Column, path: str, dtype: str, strict: bool = True) -> Column:
    """Read one path of a VARIANT as ``dtype``; missing paths and JSON null give NULL.

    A value that cannot be cast raises, or gives NULL with ``strict=False``. Whole-number types go
    through DECIMAL(38,0), which rounds 1.6 to 2; a direct integer cast would cut it to 1.
    """
    get = F.variant_get if strict else F.try_variant_get
    if dtype in WHOLE_NUMBERS:
        return get(doc, path, "decimal(38,0)").cast(dtype)
    return get(doc, path, dtype)


def blank_to_null(text: Column) -> Column:
    """Trim, then turn the empty string into NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def standard_upper(text: Column) -> Column:
    """Trim and upper-case."""
    return F.upper(F.trim(text))


def zero_to_null(number: Column) -> Column:
    """Treat zero as "not reported"."""
    return F.nullif(number, F.lit(0).cast("int"))


def or_unknown(value: Column, default: object = "UNKNOWN") -> Column:
    """Replace NULL by the unknown member."""
    return F.coalesce(value, F.lit(default))


def map_labels(value: Column, labels: Mapping, default: object) -> Column:
    """Look ``value`` up in a literal mapping; anything else, NULL included, gives ``default``."""
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    return F.coalesce(F.create_map(*pairs)[value], F.lit(default))


def compare_flag(
    left: Column,
    right: Column,
    above: str = "PROFITABLE",
    equal: str = "BREAK_EVEN",
    below: str = "LOSS",
    unknown: str = "UNKNOWN",
) -> Column:
    """Label ``left`` against ``right``; ``unknown`` when either is NULL."""
    return (
        F.when(left > right, F.lit(above))
        .when(left == right, F.lit(equal))
        .when(left < right, F.lit(below))
        .otherwise(F.lit(unknown))
    )
