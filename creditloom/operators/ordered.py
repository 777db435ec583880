"""Order-dependent operators: positions, running totals, first / last rows, ECDF, percentiles.

All of them take explicit ordering columns that must form a total order inside a
group, because row order is not a property of a DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from creditloom.operators.slices import SLICE, Order, SlicePlan, as_orders, plan_slices, sort_columns

_FORWARD = (Window.unboundedPreceding, Window.currentRow)


def running_totals(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Order],
                   sums: Mapping[str, Column], totals: Mapping[str, Column] | None = None,
                   limit: int | None = None, plan: SlicePlan | None = None) -> DataFrame:
    """Add inclusive running sums (and whole-group totals) in order.

    An oversized group is summed slice by slice: one small aggregate gives the total
    of each slice, their prefix sums become offsets, and the windows only ever run
    inside a slice. The offsets table has one row per slice, so it is broadcast.
    """
    totals = dict(totals or {})
    plan = plan or plan_slices(df, keys, order_by, limit)
    sliced = plan.assign(df)
    if not plan.hot:
        for name, c in sums.items():
            sliced = sliced.withColumn(name, F.sum(c).over(plan.window().rowsBetween(*_FORWARD)))
        for name, c in totals.items():
            sliced = sliced.withColumn(name, F.sum(c).over(plan.group()))
        return sliced

    names = [*sums, *totals]
    parts = (plan.only_hot(sliced).groupBy(*plan.keys, SLICE)
             .agg(*[F.sum(c).alias(n) for n, c in {**sums, **totals}.items()]))
    kinds = {n: parts.schema[n].dataType for n in names}
    group = Window.partitionBy(*(plan.keys or [F.lit(0)]))
    before = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice of an oversized group; a group that was not cut has none
    offsets = parts.select(*plan.keys, SLICE, *[F.sum(n).over(before).cast(kinds[n]).alias(f"_o_{n}") for n in sums],
                           *[F.sum(n).over(group).cast(kinds[n]).alias(f"_o_{n}") for n in totals])
    out = plan.join_bounded(sliced, offsets, [SLICE])
    for name, c in sums.items():
        inside, offset = F.sum(c).over(plan.window().rowsBetween(*_FORWARD)), F.col(f"_o_{name}")
        # a sum of missing values only is missing, in the slice and before it alike
        out = out.withColumn(name, F.coalesce((offset + inside).cast(kinds[name]), offset, inside))
    for name, c in totals.items():
        # groups that were not cut have no offsets; there the slice is the whole group
        out = out.withColumn(name, F.coalesce(F.col(f"_o_{name}"), F.sum(c).over(plan.group())))
    return out.drop(SLICE, *[f"_o_{n}" for n in names])


def with_positions(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Order],
                   position: str = "_pos", size: str = "_size", limit: int | None = None,
                   plan: SlicePlan | None = None) -> DataFrame:
    """Add the 1-based place of each row in its group and the group size."""
    one = F.lit(1)
    return running_totals(df, keys, order_by, {position: one}, {size: one}, limit, plan)


def first_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Order], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Written as ``row_number() <= n`` so that Spark also limits the groups before the
    shuffle (WindowGroupLimit): a hot key sends at most ``n`` rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def last_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Order], n: int) -> DataFrame:
    """Last ``n`` rows of each group, missing order values counting as the very last."""
    back = [F.col(o.column).asc_nulls_first() if o.descending else F.col(o.column).desc_nulls_first()
            for o in as_orders(order_by)]
    w = Window.partitionBy(*keys).orderBy(*back)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def ecdf(df: DataFrame, column: str, tie_break: Sequence[str], by: Sequence[str] = (),
         name: str = "cdf", limit: int | None = None) -> DataFrame:
    """Empirical CDF ``(place - 1) / (n - 1)`` over the non-missing values, per class of ``by``."""
    present = df.where(F.col(column).isNotNull())
    placed = with_positions(present, by, [column, *tie_break], limit=limit)
    share = F.try_divide((F.col("_pos") - 1).cast("double"), (F.col("_size") - 1).cast("double"))
    return placed.withColumn(name, share).drop("_pos", "_size")


def percentiles(df: DataFrame, column: str, fractions: Sequence[float], by: Sequence[str] = (),
                limit: int | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation: one row per class and fraction.

    Works on the table of distinct values with their counts (map-side combined) and
    finds the two neighbouring ranks of each fraction by running counts, so no task
    holds all values of a class.
    """
    counts = (df.where(F.col(column).isNotNull())
              .groupBy(*by, F.col(column).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    placed = running_totals(counts, by, ["_v"], {"_hi": F.col("_c")}, {"_n": F.col("_c")}, limit)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in fractions])).alias("fraction")
    at = F.col("fraction") * (F.col("_n") - 1)
    low = F.floor(at)
    covers = lambda rank: (rank < F.col("_hi")) & (rank >= F.col("_hi") - F.col("_c"))
    rows = placed.select(*by, "_v", "_hi", "_c", "_n", wanted)
    rows = rows.withColumn("_low", low).withColumn("_up", F.ceil(at)).withColumn("_w", at - low)
    rows = rows.where(covers(F.col("_low")) | covers(F.col("_up")))
    lo = F.max(F.when(covers(F.col("_low")), F.col("_v")))
    hi = F.max(F.when(covers(F.col("_up")), F.col("_v")))
    return rows.groupBy(*by, "fraction").agg((lo + (hi - lo) * F.max("_w")).alias("value"))
