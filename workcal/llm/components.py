"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stage


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) for every id that has an edge ``a, b``.

    Alternating large-star and small-star steps: every step points neighbours at the
    smallest one, until only stars are left. Edges never multiply and never leave the
    cluster; each round is a table of its own in the shared folder, so a lost executor
    repeats one round at most.
    """
    current = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges", narrow=True)
    before = None
    while True:
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return current.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("component")).unionByName(
                current.select(F.least("a", "b").alias("id"), F.least("a", "b").alias("component"))
            ).distinct()
        before = state
        current = stage(_small_star(_large_star(current)), "edges", narrow=True)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(lowest, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
