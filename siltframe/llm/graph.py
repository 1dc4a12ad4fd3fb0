"""Connected components by alternating large-star and small-star rounds, which keep the number of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest of it and its neighbours.

    The smallest neighbour is aggregated before it is joined back, so a node with very many edges is combined on the
    map side and its join partition can be split. The same holds for the small star.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one centre, and no centre on another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("centre"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("centre").alias("centre"))
    return node.where("up + centre > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``edges`` (a, b); the component is its smallest node.

    Loops and edges with a null end are ignored; nodes without another edge are not returned.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges", narrow=True)
    while not _settled(edges):
        edges = stored(_small_star(_large_star(edges)), "edges", narrow=True)
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
