"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join, store

MOST_ROUNDS = 60


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: every larger neighbour of u goes to u's least neighbour (or
    u). Small star: u and its smaller neighbours go to the least of them."""
    if small:
        e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = store(e.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("m")), "stars-least")
    m = F.least("least", "u")
    x = spread_join(e, low.select("u", "least"), ["u"], F.xxhash64("v"), low.select("u", "m"))  # u may be a hub
    moved = x.where("v > least" if small else "v > u").select(m.alias("a"), F.col("v").alias("b"))
    if small:
        moved = moved.unionByName(low.select(m.alias("a"), F.col("u").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node in a link.

    Alternating large and small stars: rounds grow with the logarithm of the
    longest chain. ``links``: a, b (long). Neighbours are never gathered; each
    star is an aggregate and a join that splits hubs, written to the shared folder. Fails
    rather than return unfinished components.
    """
    edges = store(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    sign = None
    for _ in range(MOST_ROUNDS):
        edges = store(_stars(edges, small=False), "stars")
        edges = store(_stars(edges, small=True), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sign:
            roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
            return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        sign = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
