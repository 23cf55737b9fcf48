"""Connected components over links between integers, by alternating large-star and small-star rounds in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import materialise

ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """links(a, b): nodes as bigint. Returns (node, component) for every node with a link to another one; component is the smallest node
    reachable.

    Each round hangs every neighbour on the smallest node around (large star), then flattens towards smaller nodes (small star), until
    nothing changes; the number of rounds grows with the logarithm of the nodes. Groups are aggregated by min() with partial sums,
    so a node with very many links never gathers in one task.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = materialise(edges, "links")
    for _ in range(ROUNDS):
        before = _print_of(edges)
        if before[0] == 0:
            break
        # Large star: neighbours larger than u join the smallest of u and its neighbours.
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        edges = larger.filter("hi <> lo").distinct()
        # Small star: u and its smaller neighbours join the smallest of them.
        least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = edges.join(least, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo"))
        edges = materialise(moved.filter("hi <> lo").distinct(), "links")
        if _print_of(edges) == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    leaves = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return leaves.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def _print_of(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges."""
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).alias("s"), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)")).alias("t")).first()
    return r["n"], r["s"], r["t"]
