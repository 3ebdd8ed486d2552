"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours on to the smallest node it knows."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, both["u"] == least["w"]).filter("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = edges.join(least, edges["u"] == least["w"]).filter("v > m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; the root is the smallest node.

    Rounds go on until the edges no longer change; each is written to the shared folder.
    Roots themselves are rows as well. No edges give no rows.
    """
    u, v = edges.columns
    current = stage(edges.filter(F.col(u) != F.col(v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if not state["n"] or (state["n"], state["x"]) == before:
            break
        before = (state["n"], state["x"])
        current = stage(_small_star(_large_star(current)), "edges")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
