"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emergent.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node points at the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all point at the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)`` (longs); component = smallest node.

    Loops, repeated edges and both directions are allowed; an edge with a null
    end is ignored; an empty table gives an empty one.  Each round is written to
    the shared folder, so lineage stays short and a lost executor costs a task,
    not the loop.  Minima are combined before every shuffle, and the joins are
    plain equi-joins that AQE may split, so a hub is no single task's work.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v").distinct()
    edges, mark, k = scratch.save(edges, "edges-0"), None, 0
    while True:
        nxt = scratch.save(_small_star(_large_star(edges)), f"edges-{k + 1}")
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"edges-{k}")
        edges, k = nxt, k + 1
        if now == mark or now[0] == 0:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
