"""Arrays inside VARIANT documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tierwise.functions.cleaning import WHOLE_NUMBERS


def explode_array(
    df: DataFrame,
    doc: str,
    path: str,
    fields: Mapping[str, tuple[str, str]],
    keep: Sequence[str] = (),
    position: str | None = None,
    once_per: str | None = None,
    outer: bool = False,
) -> DataFrame:
    """One row per object of the array at ``path``.

    ``fields`` maps an output column to the object's ``(field, type)``; whole-number types round as
    :func:`~tierwise.functions.cleaning.variant_field` does. ``keep`` names the parent columns to
    carry along and ``position`` the output column for the 0-based index. ``once_per`` keeps only
    the first object with each value of that output column, inside the array, so no shuffle is
    needed where the parent key is unique; objects without the value are dropped then. A parent
    whose array is missing or empty gives no row, unless ``outer``.
    """
    read = {name: "decimal(38,0)" if t in WHOLE_NUMBERS else t for name, (_, t) in fields.items()}
    members = ",".join(f"`{f}`:{read[name]}" for name, (f, _) in fields.items())
    objects = F.variant_get(F.col(doc), path, f"array<struct<{members}>>")

    def flat(item, index):
        columns = [item[f].cast(t).alias(name) for name, (f, t) in fields.items()]
        return F.struct(index.alias("_at"), *columns)

    rows = F.transform(objects, flat)
    if once_per:
        # Sorted by value and place, the first of each value is the one whose predecessor differs. The sorted array is a
        # column of its own, so that it is built once per document and not per object.
        keyed = F.transform(rows, lambda row: F.struct(row[once_per].alias("_key"), row["_at"].alias("_place"), row.alias("_row")))
        known = F.array_sort(F.filter(keyed, lambda k: k["_key"].isNotNull()))
        df = df.select(*keep, known.alias("_sorted"))
        before = lambda i: F.get(F.col("_sorted"), i - 1)["_key"]
        firsts = F.filter("_sorted", lambda k, i: (i == 0) | (before(i) != k["_key"]))
        rows = F.array_sort(F.transform(firsts, lambda k: k["_row"]))
    explode = F.explode_outer if outer else F.explode
    out = df.select(*keep, explode(rows).alias("_item"))
    at = [F.col("_item._at").alias(position)] if position else []
    return out.select(*keep, *at, *[F.col(f"_item.{name}").alias(name) for name in fields])
