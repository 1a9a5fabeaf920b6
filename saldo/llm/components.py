"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.session import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node to the least node seen: the larger neighbours (large star), or
    the node and its smaller neighbours (small star). The least neighbour combines on the map side; it is
    staged, so that the join with a hot node's links can be split."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).where("m < u"), "star")
    linked = both.join(least, "u")
    if large:
        kept = both.join(least, "u", "left").select(
            F.col("v").alias("u"), F.least(F.col("m"), F.col("v"), F.col("u")).alias("v"), F.col("u").alias("old")
        ).where("u > old").drop("old")
        return kept.where("u > v").distinct()
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return out.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, least): every linked node with the least node of its component.

    Null ends and self-links are left out; an empty table gives an empty result. The rounds end when a
    pass changes no link, after about log(nodes) rounds, and each is written to the shared folder."""
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = staged(ends.where("u > v").distinct(), "links")
    seen = None
    while True:
        edges = staged(_star(_star(edges, True), False), "links")
        mark = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(mark) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("least")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("least")).distinct()
            )
        seen = tuple(mark)
