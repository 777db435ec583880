"""Data profiles: missing shares, distinct counts, duplicates, category rates, boxes, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from creditloom.operators.ordered import percentiles


def _stack(row: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Turn the one-row table with columns ``c<i>_<name>`` into one row per column."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"c{i}_{n}").alias(n) for n in names])
                      for i, c in enumerate(columns)])
    return row.select(F.inline(items))


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, percent)`` of missing cells; one pass over the table."""
    row = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100).alias(f"c{i}_percent")
                   for i, c in enumerate(df.columns)])
    return _stack(row, df.columns, ["percent"])


def distinct_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_values)``, a missing value counting as one value.

    Every column is its own group of the exploded pairs, so the count is two plain
    map-side combined aggregates whatever the number of columns.
    """
    columns = list(columns or df.columns)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                                for c in columns]))
    return (df.select(pairs.alias("p")).select("p.column", "p.value").distinct()
            .groupBy("column").agg(F.count(F.lit(1)).alias("n_values")))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of rows that repeat an earlier row in all (or the given) columns."""
    copies = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, share)``; the share is of the non-missing rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.col(column)).alias("total"))
    # one row, so a broadcast of known size
    return (counts.withColumn("_one", F.lit(1)).join(F.broadcast(total.withColumn("_one", F.lit(1))), "_one")
            .select("value", "n", (F.col("n") / F.col("total")).alias("share")))


def default_rates(df: DataFrame, column: str, label: str = "TARGET") -> DataFrame:
    """Percent of positives per category; categories without a positive are left out."""
    positives = F.count_if(F.col(label) == 1)
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg((positives * 100.0 / F.count(F.lit(1))).alias("percent"), positives.alias("positives"))
            .where(F.col("positives") > 0).drop("positives"))


def category_profile(df: DataFrame, column: str, label: str = "TARGET") -> DataFrame:
    """Counts, shares and default rates of a category column in one aggregate."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("positives"))
            .withColumn("percent", F.when(F.col("positives") > 0, F.col("positives") * 100.0 / F.col("n"))))


# The percentiles listed when none are asked for.
DEFAULT_PERCENTILES = (0, 25, 50, 75, 90, 92, 94, 96, 98, 100)


def percentile_table(df: DataFrame, column: str, points: Sequence[float] = DEFAULT_PERCENTILES,
                     by: Sequence[str] = ()) -> DataFrame:
    return (percentiles(df, column, [p / 100 for p in points], by)
            .select(*by, F.round(F.col("fraction") * 100, 6).alias("percentile"), "value"))


def box_summary(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, inter-quartile range, whiskers (last value within 1.5 ranges) and outliers per class."""
    quartile = percentiles(df, column, [0.25, 0.5, 0.75], by)
    at = lambda p: F.max(F.when(F.col("fraction") == p, F.col("value")))
    box = quartile.groupBy(*by).agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    box = box.withColumn("_low", F.col("q1") - reach).withColumn("_high", F.col("q3") + reach)
    x = F.col(column)
    inside = (x >= F.col("_low")) & (x <= F.col("_high"))
    # one row per class; AQE broadcasts it once its size is known
    return (df.where(x.isNotNull()).join(box, list(by))
            .groupBy(*by, "q1", "median", "q3")
            .agg(F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
                 F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n")))


def histogram(df: DataFrame, column: str, by: Sequence[str] = (), bins: int = 20) -> DataFrame:
    """Counts and densities in ``bins`` equal-width bins over the whole range, per class."""
    present = df.where(F.col(column).isNotNull())
    low, high = present.agg(F.min(F.col(column).cast("double")), F.max(F.col(column).cast("double"))).first()
    if low is None:
        low = high = 0.0
    width = (high - low) / bins or 1.0
    place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = present.groupBy(*by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("_class")) if by else None
    if by:
        counts = counts.join(sizes, list(by))
    else:
        from pyspark.sql import Window
        counts = counts.withColumn("_class", F.sum("n").over(Window.partitionBy(F.lit(0))))  # at most `bins` rows
    return counts.select(*by, "bin", (F.lit(low) + F.col("bin") * width).alias("bin_start"), "n",
                         (F.col("n") / (F.col("_class") * width)).alias("density"))
