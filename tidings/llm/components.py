"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.session import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and no larger neighbour of its own."""
    ends = edges.select(F.col("v").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select(F.col("u").alias("n"), F.lit(0), F.lit(1)))
    per_node = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per_node.where((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node of ``edges`` (u, v) but the labels: label is
    the smallest node it reaches.

    Alternates large-star and small-star steps: every node links its larger,
    then its smaller neighbours to the least one it knows, until each
    component is a star.  The number of rounds grows with the logarithm of
    the longest path; edges that are stars already take none.  Least
    neighbours are aggregates that combine before the shuffle and are written,
    so both sides of each join are plain scans and a node with very many
    neighbours is split by adaptive execution.
    """
    low, high = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    edges = materialize(edges.where(F.col("u") != F.col("v")).select(low, high).distinct(), "edges")
    while not _stars(edges):
        near = _both(edges)
        least = materialize(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = materialize(near.where(F.col("v") > F.col("u")).join(least, "u").where(F.col("v") != F.col("m"))
                            .select(F.col("m").alias("u"), "v").distinct(), "large")
        # each (u, v) has u < v; now the least smaller neighbour of each v
        down = materialize(large.groupBy("v").agg(F.min("u").alias("m")), "down")
        small = large.join(down, "v")
        edges = materialize(small.where(F.col("u") != F.col("m")).select(F.col("m").alias("u"), F.col("u").alias("v"))
                            .union(small.select(F.col("m").alias("u"), "v")).distinct(), "small")
    return edges.select(F.col("v").alias("node"), F.col("u").alias("label"))
