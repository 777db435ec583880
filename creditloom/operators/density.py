"""Kernel density of a column by class: linear binning on a grid, then a sum over the grid."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi, sqrt

from pyspark.sql import Column, DataFrame, functions as F

#: Points of a class's grid, and bandwidths that it reaches beyond the least and largest value.
GRID, BEYOND = 200, 3.0


def _same(left: str, right: str, by: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in by:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def kernel_density(df: DataFrame, column: str, by: Sequence[str] = (), grid: int = GRID, width: float = 1.0) -> DataFrame:
    """(by, point, x, density): the Gaussian kernel density of every class at ``grid`` evenly spaced points.

    The bandwidth is Scott's, n^(-1/5) times the class's standard deviation, times ``width``. Each value gives its weight to the
    two grid points beside it (linear binning), so the rows are read once for the range and once for the grid, and what is summed per
    point is the grid alone. Missing and NaN values take no part; a class with fewer than two different values has no density.
    A missing class is a class.
    """
    by = list(by)
    keys = by or ["_all"]
    rows = (df if by else df.withColumn("_all", F.lit(0))).select(*keys, F.nanvl(F.col(column).cast("double"), F.lit(None)).alias("_v")).where("_v is not null")
    n = F.col("_n")
    facts = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.stddev_samp("_v").alias("_s"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    facts = facts.where("_s > 0").withColumn("_h", F.col("_s") * F.pow(n, F.lit(-0.2)) * width)
    facts = facts.withColumn("_low", F.col("_a") - BEYOND * F.col("_h"))
    facts = facts.withColumn("_step", (F.col("_b") + BEYOND * F.col("_h") - F.col("_low")) / (grid - 1)).drop("_a", "_b", "_s")
    placed = rows.alias("r").join(facts.alias("f"), _same("r", "f", keys)).select(*[F.col(f"r.{c}") for c in keys], ((F.col("_v") - F.col("_low")) / F.col("_step")).alias("_p"))
    cell = F.least(F.floor("_p"), F.lit(grid - 2)).cast("int")
    sides = F.explode(F.array(F.struct(cell.alias("at"), (1 - (F.col("_p") - cell)).alias("w")), F.struct((cell + 1).alias("at"), (F.col("_p") - cell).alias("w"))))
    mass = placed.select(*keys, sides.alias("_c")).groupBy(*keys, F.col("_c.at").alias("_at")).agg(F.sum("_c.w").alias("_w"))
    points = facts.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))  # ``grid`` rows a class
    gap = (F.col("point") - F.col("_at")) * F.col("_step") / F.col("_h")
    met = points.alias("p").join(mass.alias("m"), _same("p", "m", keys))
    summed = met.groupBy(*[F.col(f"p.{c}").alias(c) for c in keys], "point", "_low", "_step", "_n", "_h").agg(F.sum(F.col("_w") * F.exp(-0.5 * gap * gap)).alias("_t"))
    return summed.select(*by, "point", (F.col("_low") + F.col("point") * F.col("_step")).alias("x"), (F.col("_t") / (n * F.col("_h") * sqrt(2 * pi))).alias("density"))
