"""Connected components of a graph given as an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

MAX_ROUNDS = 100


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to each node's smallest neighbour: the larger ones, or the others."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(least.select("a", F.col("m").alias("b"))))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of its component for each node with an edge.

    ``edges`` has two long columns. Each round is written to the shared folder, so a lost executor
    costs one round at most. No node's neighbours meet in one task: minima are combined before
    they are shuffled, and the joins can be split.
    """
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b")
    now = cut_lineage(now.distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        now = cut_lineage(_star(_star(now, large=True), large=False))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")),
                       F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
