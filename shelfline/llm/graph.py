"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.session import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour (the larger ones, or the smaller ones and the node itself) to the least in reach."""
    low = F.least("u", F.col("least"))
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        linked = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), low.alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("least"))
        linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        linked = linked.unionByName(least.select("u", F.col("least").alias("v")))
    return linked.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node of the component) of every node that occurs in ``edges`` (u, v).

    Each round is stored in the shared folder, which cuts the lineage and survives lost executors; rounds end when a round
    changes nothing. Keys are combined before they move, and joins on a hot node are split at run time.
    """
    edges = written(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "links")
    state = None
    while True:
        edges = written(_star(_star(edges, True), False), "stars")
        # Equal sums mean that nothing moved: every link leads to a node that is at most as large as before.
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
