"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, numbers): root is the smallest node reachable.

    Alternating large-star and small-star steps: every node hands its larger,
    then its smaller neighbours to the smallest node it knows, until all edges
    point to roots. Rounds grow with the logarithm of the longest chain. A hub of
    many neighbours is only ever reduced by min, which is combined before the
    shuffle, and joined with the edges, where Spark splits skewed partitions.
    Null nodes and loops are ignored.
    """
    clean = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    now = stored(clean.filter("hi is not null and lo is not null and hi <> lo").distinct(), "edges")
    state = _state(now)
    while state[0]:
        following = stored(_small_star(_large_star(now)), "edges")
        drop_stored(now)
        now, before = following, state
        state = _state(now)
        if state == before:
            break
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def _state(edges: DataFrame) -> tuple:
    """Number and order-free sum of the edges; equal sets have equal states."""
    digest = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(digest)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbours and itself."""
    # a node's smallest neighbour lies in its own edges to smaller ones, or is itself
    least = edges.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "node")
    joined = edges.join(least, F.col("lo") == F.col("node"), "left")
    return joined.select("hi", F.coalesce("m", "lo").alias("lo")).union(least.select(F.col("node").alias("hi"), F.col("m").alias("lo"))).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "node")
    others = edges.join(least, F.col("hi") == F.col("node")).filter(F.col("lo") != F.col("m"))
    return others.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(least.select(F.col("node").alias("hi"), F.col("m").alias("lo"))).distinct()
