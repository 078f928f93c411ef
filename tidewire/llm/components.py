"""Connected components by alternating large and small stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each larger neighbour of a node to the least node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of them; ``edges`` point downwards."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, root) of every node that has an edge; ``root`` is the least node of its component.

    Neighbour lists are never gathered: a round takes minima, which combine
    before the shuffle, and joins them back to the edges, where adaptive
    execution splits the edges of a hot node. The rounds grow with the logarithm
    of the longest path; each is written to the shared folder. Self loops and
    edges with a null end are dropped; repeated edges count once.
    """
    x, y = F.col(a), F.col(b)
    current = cut_lineage(
        edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        current = cut_lineage(_small_star(_large_star(current)), "stars")
