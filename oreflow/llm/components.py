"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.session import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node it reaches, for every node of the links (a, b).

    Alternates large-star and small-star: each node hands its smallest neighbour to its larger, then
    to its smaller neighbours, until all links lead to the smallest node of their component. Each
    round is stored in the shared folder. A node with very many links costs one combined minimum. Links
    that already are stars around their smallest node end it after one round.
    """
    edges = staged(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        edges = staged(small, "links")
        state = _state(edges)
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        before = state
