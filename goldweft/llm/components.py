"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweft.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node in ``links``
    (columns a and b, undirected, repeats and self links allowed; nulls are ignored).

    Alternates two steps: each node hands its smallest neighbour to its greater ones, then
    to its smaller ones.  Links shrink to stars around the smallest nodes, in rounds that
    grow with the logarithm of the longest path.  Every step is one aggregation of minima
    and one join; each round is written to the shared folder, which cuts the lineage.
    """
    edges = (
        links.filter("a IS NOT NULL AND b IS NOT NULL")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges = stage(edges, "links")
    before = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.filter("u <> v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its greater neighbours to the smallest of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u OR v = u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    turned = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = turned.groupBy("u").agg(F.min("v").alias("m"))
    near = turned.join(least, "u")
    return (
        near.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
