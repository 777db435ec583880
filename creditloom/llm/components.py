"""Connected components of an edge table by alternating star contraction.

Each round first ties every node's larger neighbours to its smallest one, then every node's smaller
neighbours; the edges shrink to stars in a number of rounds that grows with the logarithm of the
longest path. A round is aggregates and equi-joins over the edges only: a hub is pre-aggregated
before the shuffle and its join is dealt over many tasks. Each round is staged, so a lost executor
costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creditloom.llm.common import stage


def _digest(edges: DataFrame) -> tuple:
    """Count and order-free hash of the edges."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
    return row.n, row.h


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
    return tied.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root): each node of an edge with the smallest node that it reaches.

    Loops and null ends are left out, repeated edges count once; no edges give no rows.
    """
    now = stage(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct(), "edges")
    seen = _digest(now)
    while seen[0]:
        now = stage(_small_star(_large_star(now)), "stars")
        if (then := _digest(now)) == seen:
            break
        seen = then
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()
