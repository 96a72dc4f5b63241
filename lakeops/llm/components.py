"""Connected components of an undirected graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(neighbours: DataFrame) -> DataFrame:
    """Each ``a`` with the least of itself and its ``b``."""
    found = neighbours.groupBy(F.col("a").alias("_of")).agg(F.min("b").alias("_least"))
    return found.select("_of", F.least("_of", "_least").alias("_least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node go to the least of its neighbourhood."""
    ways = _both_ways(edges)
    joined = ways.join(_least(ways), F.col("a") == F.col("_of"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(_least(down), F.col("a") == F.col("_of"))
    return joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).unionByName(joined.select("a", F.col("_least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node reachable, for all nodes of ``edges`` (a, b); runs jobs.

    Rounds grow with the logarithm of the longest path. Self-links are ignored; an empty graph has none.
    """
    proper = lambda found: written(found.where("a != b").distinct(), "edges")
    mark = lambda found: found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()
    edges = proper(edges.select("a", "b"))
    before = None
    while (now := mark(edges)) != before:
        before = now
        edges = proper(_small_star(proper(_large_star(edges))))
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
