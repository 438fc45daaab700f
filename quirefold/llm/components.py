"""Connected components of links between numbers, by alternating star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.llm.common import checkpointed


def _digest(edges: DataFrame) -> tuple:
    """What identifies a set of edges: their count and a sum of hashes that no order changes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node on the smallest of them: the larger ones for a large star, else the smaller ones.

    The minimum is aggregated before it is shuffled. It is written down before it is joined back: the join then has
    plain shuffles on both sides, and the links of a node that has very many are split over several tasks.
    """
    if large:
        arcs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        arcs = edges
    least = checkpointed(arcs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
    joined = arcs.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): the root is the smallest node that can be reached.

    Each round is written to the checkpoint folder; rounds go on until nothing changes, about the logarithm of the
    longest chain.
    """
    edges = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while (now := _digest(edges)) != before:
        before = now
        edges = checkpointed(_star(_star(edges, True), False))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
