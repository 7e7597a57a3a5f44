"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierwise.llm.common import stored


def _towards(links: DataFrame) -> DataFrame:
    """Each link in both directions."""
    return links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of u moves to the smallest neighbour of u, or u itself. May repeat links."""
    both = _towards(links)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u, move to the smallest neighbour of u. Links point down and occur once."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _is_done(links: DataFrame) -> bool:
    """Whether each node has one link, and to a node without any."""
    per_node = links.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    if not per_node.where("n > 1").isEmpty():
        return False
    return links.select("v").distinct().join(per_node.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: root is the smallest node of its component.

    ``links`` has two long columns. No links give no rows. Stars grow by joins and partial minima only, so a node with
    many neighbours never sits in one task; each round is written to the shared folder. The number of rounds grows with
    the logarithm of the longest path, not with the rows.
    """
    u, v = links.columns
    now = stored(links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v"), "links")
    if not now.isEmpty():
        now = stored(_small_star(now), "links")
        while not _is_done(now):
            now = stored(_small_star(_large_star(now)), "links")
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
