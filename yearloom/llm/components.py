"""Connected components of links, by alternating large and small stars.

Each round links every vertex more directly to the smallest one it can reach; only counts
reach the driver.  A vertex with very many links is grouped with partial aggregation, and
the joins are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.session import store


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "least").alias("least"))
    joined = both.where(F.col("b") > F.col("a")).join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    moved = edges.join(least, "a").where(F.col("b") != F.col("least"))
    moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest vertex that each vertex reaches (``vertex``, ``component``).

    ``links`` has two columns of whole numbers, in any order and repeated at will; links with a
    null end and from a vertex to itself don't count.  Vertices that are the smallest of
    their component, and those without links, have no row.
    """
    a, b = (F.col(f"`{c}`").cast("long") for c in links.columns)
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).distinct()
    edges = store(edges, "links")
    before, now = None, _state(edges)
    while now != before:
        edges = store(_small_star(_large_star(edges)), "links")
        before, now = now, _state(edges)
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
