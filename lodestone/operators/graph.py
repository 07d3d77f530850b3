"""Weighted undirected graphs as edge frames: pagerank, degrees, subgraphs.

An edge frame has one row (``a``, ``b``, ``n``) per undirected edge.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

# Edges of one node that are kept together; a node with more is dealt into parts.
HUB_EDGES = 100_000


def both_ways(edges: DataFrame) -> DataFrame:
    """Directed form: every edge in both directions, self loops once."""
    forth = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("n").alias("w"))
    back = edges.filter(F.col("a") != F.col("b")).select(
        F.col("b").alias("src"), F.col("a").alias("dst"), F.col("n").alias("w"))
    return forth.unionByName(back)


def nodes_of(edges: DataFrame) -> DataFrame:
    """Distinct nodes."""
    return edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def heavy_edges(edges: DataFrame, min_weight: float | None = None) -> DataFrame:
    """Edges of at least ``min_weight``, or, without one, above the mean weight."""
    if min_weight is not None:
        return edges.filter(F.col("n") >= min_weight)
    return edges.filter(F.col("n") > edges.agg(F.avg("n")).scalar())


def degree_centrality(edges: DataFrame, k: int | None = 20) -> DataFrame:
    """Degree over (number of nodes - 1)."""
    directed = both_ways(edges)
    total = nodes_of(edges).agg(F.count(F.lit(1))).scalar()
    out = (directed.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
           .withColumn("centrality", F.round(F.try_divide(F.col("degree"), total - 1), 4)))
    return out if k is None else out.orderBy(F.desc("degree"), F.asc("node")).limit(k)


def graph_size(edges: DataFrame) -> DataFrame:
    """One row: number of nodes and of edges."""
    nodes = nodes_of(edges).agg(F.count(F.lit(1))).scalar()
    return edges.agg(F.count(F.lit(1)).alias("edges")).withColumn("nodes", nodes)


def induced_subgraph(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with both ends among ``nodes``."""
    return (edges.join(nodes.select(F.col("node").alias("a")), "a", "left_semi")
            .join(nodes.select(F.col("node").alias("b")), "b", "left_semi"))


def pagerank(edges: DataFrame, damping: float = 0.85, max_rounds: int = 100,
             tolerance: float | None = 1e-6) -> DataFrame:
    """Weighted PageRank of an undirected graph (Page & Brin 1998): ``node``, ``score``.

    Runs ``max_rounds`` rounds, or until the L1 change falls below nodes * ``tolerance``. The
    transition weights are kept partitioned by source, those of a node with more than
    :data:`HUB_EDGES` edges in several parts, each met by a copy of the node's score; a round is
    one join on that partitioning and one partially aggregated sum. Nodes whose edges carry no weight spread their score evenly. Scores go
    through a reliable checkpoint every round, which keeps the plan of a round small and means
    that a lost executor costs no more than one round.
    """
    edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
    directed = both_ways(edges).filter(F.col("w") > 0)
    out_weight = directed.groupBy("src").agg(
        F.sum("w").alias("_out"),
        F.ceil(F.count(F.lit(1)) / F.lit(HUB_EDGES)).cast("int").alias("_parts"))
    links = (directed.join(out_weight, "src")
             .select("src", "dst", (F.col("w") / F.col("_out")).alias("p"),
                     F.pmod(F.xxhash64("dst"), F.col("_parts")).cast("int").alias("part"))
             .repartition("src", "part").persist(StorageLevel.MEMORY_AND_DISK))
    try:
        nodes = nodes_of(edges).join(out_weight, F.col("node") == F.col("src"), "left")
        start = cut_lineage(nodes.select("node", F.col("_out").isNull().alias("idle"), "_parts"))
        n, idle = start.agg(F.count(F.lit(1)), F.count_if("idle")).first()
        ranks = start.select("node", "idle", "_parts", F.lit(1.0 / max(n, 1)).alias("score"),
                             F.lit(0.0).alias("_step"))
        for _ in range(max_rounds if n else 0):
            copies = ranks.select(F.col("node").alias("src"), "score", F.explode(F.sequence(
                F.lit(0), F.col("_parts") - 1)).alias("part"))
            arrived = (links.join(copies, ["src", "part"])
                       .groupBy("dst").agg(F.sum(F.col("p") * F.col("score")).alias("_in")))
            spread = F.lit((1.0 - damping) / n)
            if idle:
                resting = ranks.filter("idle").agg(F.sum("score")).first()[0]
                spread = spread + F.lit(resting * damping / n)
            fresh = F.coalesce("_in", F.lit(0.0)) * damping + spread
            ranks = cut_lineage(
                ranks.join(arrived, F.col("node") == F.col("dst"), "left")
                .select("node", "idle", "_parts", fresh.alias("score"),
                        F.abs(fresh - F.col("score")).alias("_step")))
            if tolerance is not None and ranks.agg(F.sum("_step")).first()[0] < n * tolerance:
                break
        return ranks.select("node", "score")
    finally:
        links.unpersist()
        edges.unpersist()


def top_nodes(scores: DataFrame, k: int = 20, digits: int = 4) -> DataFrame:
    """The ``k`` best nodes."""
    return (scores.orderBy(F.desc("score"), F.asc("node")).limit(k)
            .withColumn("score", F.round("score", digits)))
