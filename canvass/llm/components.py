"""Connected components of a table of links, by alternating large and small stars; no link reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import written


def _large(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    rest = down.join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return own.union(rest).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: long); the root is the least node of its component.

    Each round is written to the shared folder, so a lost executor costs one round. Links of a node with itself and
    rows with a NULL are left out.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = written(edges, "links"), None
    while (now := _state(edges)) != before:
        before = now
        edges = written(_small(_large(edges)), "links")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select("b", "b").distinct())
