"""Connected components of a graph given as pairs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweft.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node that it reaches.

    Each round points a node's larger neighbours and then its smaller ones at
    the smallest of them all. Every step is an aggregation (pre-aggregated) and
    a join with one row per node, so a node with very many edges is never
    gathered. The edges of each round are written to the shared folder. Loops,
    repeated pairs and either direction are fine; pairs with a null are left
    out.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    known = materialize(edges.filter("a is not null and b is not null and a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    state = None
    while True:
        now = known.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if now == state:
            break
        state = now
        known = materialize(small_star(large_star(known)), "edges")
    return known.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        known.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))  # of each node, the larger neighbours
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    pointed = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return pointed.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
