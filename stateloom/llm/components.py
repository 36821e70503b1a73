"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateloom.llm.shared import kept


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One round. `edges` hold (u, v) with v < u.

    Large: every larger neighbour of a node is linked to the least node around it. Small: the node and its
    smaller neighbours are linked to the least of them. A hub is one row per neighbour in a join that
    adaptive execution may split, never a collected group.
    """
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = around.join(least, F.col("u") == F.col("w"))
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return moved.filter(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (two columns of one orderable type); root is the least node reached.

    Self links and repeated links change nothing; an empty table gives an empty one.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col("u") > F.col("v")).distinct()
    edges, before = kept(edges, "links"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            break
        before, edges = now, kept(star(star(edges, True), False), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
