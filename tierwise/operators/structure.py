"""Which paths and types documents have, and how that differs between two sets of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.sources.shared_folder import cut_lineage

#: Levels of nesting that are opened in one pass over the documents.
LEVELS = 4
# Kinds by the type that Spark gives a VARIANT without members or items.
_KINDS = {"STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}
_NODE = "array<struct<path string, value variant>>"


def _kind(node: Column) -> Column:
    """The kind of one opened node. Numbers go by their value, not by how they are written: 1, 1.0 and 1e0 are whole."""
    schema = node["schema"]
    real = F.try_variant_get(node["value"], "$", "double")
    number = lambda whole: F.when(whole, F.lit("whole")).otherwise(F.lit("fraction"))
    kind = F.when(node["members"].isNotNull(), "object").when(node["items"].isNotNull(), "array").when(schema == "BIGINT", "whole")
    for name, known in _KINDS.items():
        kind = kind.when(schema == name, known)
    kind = kind.when(schema.isin("DOUBLE", "FLOAT"), number(real == F.rint(real)))
    kind = kind.when(schema.startswith("DECIMAL"), number(schema.rlike(r"^DECIMAL\(\d+,0\)")))
    return kind.otherwise(F.lower(F.regexp_extract(schema, "^[A-Z_]+", 0)))


def _children(node: Column) -> Column:
    """The members of an object by key, the items of an array under one path, nothing of anything else."""
    path = node["path"]
    members = F.transform(
        F.map_entries(node["members"]),
        lambda e: F.struct(F.concat(path, F.lit("."), e["key"]).alias("path"), e["value"].alias("value")),
    )
    items = F.transform(node["items"], lambda v: F.struct(F.concat(path, F.lit("[]")).alias("path"), v.alias("value")))
    return F.coalesce(members, items, F.array().cast(_NODE))


def _with_kinds(nodes: Column) -> Column:
    """The nodes with their kinds and what is below them. Objects and arrays are told by opening them: the type of one
    would be put together from all that it holds, on each level again."""
    below = lambda n, kind: F.try_variant_get(n["value"], "$", kind)
    opened = F.transform(
        nodes, lambda n: F.struct(n["path"].alias("path"), below(n, "map<string,variant>").alias("members"), below(n, "array<variant>").alias("items"), n["value"].alias("value"))
    )
    single = lambda n: n["members"].isNull() & n["items"].isNull()
    typed = F.transform(
        opened, lambda n: F.struct(n["path"].alias("path"), n["members"].alias("members"), n["items"].alias("items"), n["value"].alias("value"), F.when(single(n), F.schema_of_variant(n["value"])).alias("schema"))
    )
    return F.transform(typed, lambda n: F.struct(n["path"].alias("path"), _kind(n).alias("kind"), n["members"].alias("members"), n["items"].alias("items")))


def path_types(df: DataFrame, doc: str, by: Sequence[str] = ()) -> DataFrame:
    """(``by`` …, path, kind, n_documents, n_values): one row per path and kind of value in the VARIANT ``doc``.

    ``$`` is the document, ``.name`` a member, ``[]`` any item of an array. Kinds are object, array, string, boolean,
    whole, fraction, null, or the name of another VARIANT type. ``n_documents`` counts the documents that have the path
    with that kind, ``n_values`` how often it occurs. Each row is a document of its own, so repeated rows count each time.
    Documents that are NULL are not counted, and a NULL in ``by`` is a group like any other.

    The nodes of a document are opened level by level inside its row and told apart there, so only counts are shuffled,
    summed per task first, and stored. What is nested deeper than LEVELS goes to another pass, a row per document again, until
    nothing is left; a path has one depth, so it is counted by one pass.
    """
    keys = [*by, "path", "kind"]
    root = F.array(F.struct(F.lit("$").alias("path"), F.col(doc).alias("value")))
    # A filter of rows would be pushed below the parsing of the documents and parse them once more.
    pending = df.select(*by, F.filter(root, lambda n: n["value"].isNotNull()).alias("_open"))
    counted = []
    while True:
        levels = pending.withColumn("_n0", _with_kinds(F.col("_open")))
        for level in range(1, LEVELS + 1):
            below = F.flatten(F.transform(f"_n{level - 1}", _children))
            levels = levels.withColumn(f"_n{level}", _with_kinds(below) if level < LEVELS else below)
        seen = F.flatten(F.array(*[F.transform(f"_n{i}", lambda n: F.struct(n["path"].alias("path"), n["kind"].alias("kind"))) for i in range(LEVELS)]))
        opened = levels.select(*by, F.array_sort(seen).alias("_seen"), F.col(f"_n{LEVELS}").alias("_open"))
        # In sorted order the first value of a path and kind is the one that differs from the value before it. Documents
        # that go on below are counted on the way, under no path; only their open nodes are ever written out.
        first = F.transform(
            "_seen", lambda n, i: F.struct(n["path"].alias("path"), n["kind"].alias("kind"), ((i == 0) | (F.get(F.col("_seen"), i - 1) != n)).cast("long").alias("first"))
        )
        deeper = F.when(F.size("_open") > 0, F.array(F.struct(F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("kind"), F.lit(0).cast("long").alias("first"))))
        nodes = opened.select(*by, F.inline(F.concat(first, F.coalesce(deeper, F.array().cast("array<struct<path string, kind string, first bigint>>")))))
        counts = cut_lineage(nodes.groupBy(*keys).agg(F.sum("first").alias("n_documents"), F.count(F.lit(1)).alias("n_values")))
        counted.append(counts.where("path is not null"))
        if counts.where("path is null").isEmpty():
            break
        pending = cut_lineage(opened.where(F.size("_open") > 0).select(*by, "_open"))
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out


def structure_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, kind, change, n_before, n_after) for two results of :func:`path_types` without groups.

    ``change`` is ``added`` or ``lost`` for a path that only one side has, ``retyped`` for a kind that only one side has
    of a path of both, and ``kept`` otherwise; the numbers are documents. Both sides hold one row per path and kind.
    """

    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select("path", "kind", F.col("n_documents").alias(name))

    both = side(before, "n_before").join(side(after, "n_after"), ["path", "kind"], "full")
    per_path = both.groupBy("path").agg(F.max("n_before").isNotNull().alias("was"), F.max("n_after").isNotNull().alias("is"))
    change = (
        F.when(~F.col("was"), "added").when(~F.col("is"), "lost")
        .when(F.col("n_before").isNull() | F.col("n_after").isNull(), "retyped").otherwise("kept")
    )
    number = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return both.join(per_path, "path").select("path", "kind", change.alias("change"), number("n_before"), number("n_after"))
