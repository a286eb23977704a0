"""Connected components of a graph of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstrata.llm.common import checkpoint


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node it is linked with, over any number of links) of every linked node.

    `links` holds a and b. Large-star and small-star steps alternate: each node's larger neighbours are
    linked with its smallest neighbour, then each node's smaller ones. Every step is one grouping and one
    join over the links, whose number never grows; it takes about log(length of the longest chain) rounds.
    A hub with many links is only ever pre-aggregated, or the large side of a join that can be split.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("small"), F.greatest("a", "b").alias("large"))
    edges = checkpoint(edges.distinct())
    before = None
    while True:
        edges = checkpoint(_small_star(_large_star(edges)))
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("small", "large").cast("decimal(38,0)"))).first()
        if after == before:
            return edges.select(F.col("large").alias("node"), F.col("small").alias("component")).union(
                edges.select("small", "small").distinct()
            )
        before = after


def _smallest(edges: DataFrame) -> DataFrame:
    """The smallest smaller neighbour of each node that has one.

    Grouped by the node in a struct: grouped by the node itself, the join that follows would keep that
    partitioning, and the rows of a hub could not be split.
    """
    found = edges.groupBy(F.struct("large").alias("key")).agg(F.min("small").alias("least"))
    return found.select(F.col("key.large").alias("node"), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked with the smallest of the node and its neighbours."""
    smallest = _smallest(edges)
    joined = edges.join(smallest, edges.small == smallest.node, "left")
    return joined.select(F.coalesce("least", "small").alias("small"), "large").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked with the smallest of them."""
    smallest = _smallest(edges)
    joined = edges.join(smallest, edges.large == smallest.node)
    moved = joined.where("small <> least").select(F.col("least").alias("small"), F.col("small").alias("large"))
    return moved.union(smallest.select(F.col("least").alias("small"), F.col("node").alias("large"))).distinct()
