"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.session import materialize


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (hi, lo), hi > lo.

    Minima are hash aggregates (combined map-side); the joins bring a node's
    minimum to its edges, so a node with many edges is never collected.
    """
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # large star: neighbours above a node go to the node's minimum
    large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    # small star: neighbours below a node, and the node, go to its minimum
    below = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = large.join(below, "hi").filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return small.unionByName(below.select("hi", F.col("m").alias("lo"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every linked node; the component is its smallest id.

    ``links`` holds pairs of ids in any order and may repeat them.  The link
    table is written between steps (no long lineage); the steps needed grow
    with the logarithm of the longest chain.
    """
    edges = materialize(links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        edges = materialize(_star(edges), "links")
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
