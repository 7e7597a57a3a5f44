"""Paths and types inside documents, by group and before and after a change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.operators.structure import path_types, structure_drift
from tierwise.registry.catalog import query, read


def _walk(documents: str, group: str = "") -> str:
    """SQL that counts every path and kind of the JSON column ``doc`` of a query."""
    more = f"{group}, " if group else ""
    return f"""SELECT {more}regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path,
  CASE WHEN t.type IN ('BIGINT', 'UBIGINT') THEN 'whole' WHEN t.type = 'DOUBLE' THEN
      CASE WHEN CAST(t.atom AS DOUBLE) = floor(CAST(t.atom AS DOUBLE)) THEN 'whole' ELSE 'fraction' END
    WHEN t.type = 'VARCHAR' THEN 'string' ELSE lower(t.type) END AS kind,
  count(DISTINCT d.number) AS n_documents, count(*) AS n_values
FROM (SELECT *, row_number() OVER () AS number FROM ({documents})) d, json_tree(d.doc) t GROUP BY ALL"""


@query(_walk("SELECT event_type, CAST(props AS JSON) AS doc FROM events", "event_type"))
def event_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the properties of each type of event hold."""
    events = read(spark, sf_dir, "events").select("event_type", F.try_parse_json("props").alias("doc"))
    return path_types(events, "doc", by=["event_type"])


def _orders(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    """One document per order; from 1996 on lines have a tax, discounts are text and the status is a part of its own."""
    lines = read(spark, sf_dir, "lineitem").where("l_orderkey is not null")
    day = F.col("o_orderdate") >= "1996-01-01"
    orders = read(spark, sf_dir, "orders").where(day if late else ~day)
    discount = F.format_string("%d %%", F.round(F.col("l_discount") * 100).cast("int")) if late else F.col("l_discount")
    fields: list[Column] = [F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"), discount.alias("discount")]
    if late:
        fields.append(F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("tax"))
    per_order = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct(*fields)).alias("lines"))
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    status = F.struct(known.alias("code"), (F.col("o_orderstatus") == "F").alias("final")) if late else known
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    whole = F.struct(F.col("o_orderkey").alias("key"), status.alias("status"), F.col("o_totalprice").alias("total"), "lines")
    return joined.select(F.parse_json(F.to_json(whole, {"ignoreNullFields": "false"})).alias("doc"))


def _orders_sql(late: bool) -> str:
    discount = "printf('%d %%', CAST(round(l_discount * 100) AS INT))" if late else "l_discount"
    tax = ", tax := CASE WHEN l_returnflag = 'R' THEN l_tax END" if late else ""
    known = "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END"
    status = f"struct_pack(code := {known}, final := o_orderstatus = 'F')" if late else known
    return f"""SELECT to_json(struct_pack(key := o_orderkey, status := {status}, total := o_totalprice, lines := lines)) AS doc
FROM orders LEFT JOIN (SELECT l_orderkey, list(struct_pack(part := l_partkey, quantity := l_quantity, discount := {discount}{tax})) AS lines
  FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE o_orderdate {'>=' if late else '<'} TIMESTAMP '1996-01-01'"""


@query(_walk(_orders_sql(late=True)))
def order_document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents: members of objects in arrays, NULL members and missing arrays."""
    return path_types(_orders(spark, sf_dir, late=True), "doc")


@query(
    f"""WITH b AS ({_walk(_orders_sql(late=False))}), a AS ({_walk(_orders_sql(late=True))})
SELECT path, kind, CASE WHEN path NOT IN (SELECT path FROM b) THEN 'added' WHEN path NOT IN (SELECT path FROM a) THEN 'lost'
    WHEN b.n_documents IS NULL OR a.n_documents IS NULL THEN 'retyped' ELSE 'kept' END AS change,
  coalesce(b.n_documents, 0) AS n_before, coalesce(a.n_documents, 0) AS n_after
FROM b FULL JOIN a USING (path, kind)"""
)
def order_document_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How documents of orders changed with the year 1996."""
    before, after = (path_types(_orders(spark, sf_dir, late), "doc") for late in (False, True))
    return structure_drift(before, after)
