"""Cutting oversized groups into ordered slices.

A window sorts one group in one task. That is fine until a single key holds a large
part of the table. Here the group sizes are measured first (one map-side combined
count over the key columns); groups above the limit are cut into consecutive order
ranges, so that every window runs over ``(keys, slice)`` and no task sees more than
about ``limit`` rows. The cut points come from a sample and only balance the work:
any cut points give the same result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SLICE = "_slice"

#: A group up to this many rows is left whole, whatever the table's size.
ROWS_PER_SLICE = 1_000_000
#: Sampled rows per slice; more gives more even slices.
SAMPLE_PER_SLICE = 40


@dataclass(frozen=True)
class Order:
    """One ordering column. Missing values always come last."""

    column: str
    descending: bool = False


def as_orders(order_by: Sequence[str | Order]) -> list[Order]:
    """Strings mean ascending; a leading ``-`` means descending."""
    orders = []
    for o in order_by:
        if isinstance(o, Order):
            orders.append(o)
        else:
            orders.append(Order(o.lstrip("-"), o.startswith("-")))
    return orders


def sort_columns(order_by: Sequence[str | Order]) -> list[Column]:
    return [F.col(o.column).desc_nulls_last() if o.descending else F.col(o.column).asc_nulls_last()
            for o in as_orders(order_by)]


def ascending(schema: T.StructType, order: Order) -> Column:
    """The ordering column as a value whose ascending order is the wanted one; missing stays missing.

    Descending integers are complemented bit by bit (nothing overflows), other numbers negated, times and dates counted
    first; strings become the complement of their bytes with an end mark, so that a longer string comes before its prefix.
    """
    c, kind = F.col(order.column), schema[order.column].dataType
    if not order.descending:
        return c
    if isinstance(kind, T.BooleanType):
        return ~c
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(c)
    if isinstance(kind, T.DateType):
        return F.bitwise_not(F.unix_date(c))
    if isinstance(kind, T.TimestampType):
        return F.bitwise_not(F.unix_micros(c))
    if isinstance(kind, T.TimestampNTZType):
        return F.bitwise_not(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(float("-inf"))).otherwise(-c)  # NaN counts as the largest number
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    return -c


def order_struct(order_by: Sequence[str | Order], schema: T.StructType) -> Column:
    """The ordering as one comparable value: ascending, missing last."""
    fields = []
    for i, o in enumerate(as_orders(order_by)):
        c = ascending(schema, o)
        fields.append(c.isNull().alias(f"n{i}"))
        fields.append(c.alias(f"v{i}"))
    return F.struct(*fields)


def null_safe_join(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where a missing key equals a missing key; ``df``'s columns, then the others of ``small``."""
    renamed = small.select(*[F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)], *[c for c in small.columns if c not in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_j{i}")) for i, k in enumerate(keys)])
    return df.join(renamed, same, how).drop(*[f"_j{i}" for i in range(len(keys))])


@dataclass(frozen=True)
class SlicePlan:
    """Which groups are cut and where."""

    keys: tuple[str, ...]
    order_by: tuple[str | Order, ...]
    rows: int
    largest: int
    cuts: DataFrame | None  # keys, cuts: array of order structs, blocks: every block-th of them
    block: int = 1
    lead_only: bool = False  # cuts are values of the first ordering column, not whole order structs

    @property
    def hot(self) -> bool:
        return self.cuts is not None

    @property
    def partition_keys(self) -> list[str]:
        """Columns a window must partition by after :meth:`assign`."""
        return [*self.keys, SLICE] if self.hot else list(self.keys)

    def window(self) -> Window:
        """Ordered window over one slice (over the whole group when nothing is cut)."""
        keys = self.partition_keys or [F.lit(0)]
        return Window.partitionBy(*keys).orderBy(*sort_columns(self.order_by))

    def group(self) -> Window:
        return Window.partitionBy(*(self.partition_keys or [F.lit(0)]))

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the slice number; a no-op when no group is oversized."""
        if not self.hot:
            return df
        cuts, blocks, block = F.col("_cuts"), F.col("_blocks"), self.block
        # blocks[i] is the last cut of block i: the number of blocks at or below the row leads
        # to the one block to look into. The row's place in the order is bound as a lambda
        # variable, so that it is built once per row and not once per cut.
        lead = as_orders(self.order_by)[0]
        value = ascending(df.schema, lead)
        coarse = F.transform(F.array(value if self.lead_only else order_struct(self.order_by, df.schema)), lambda here: F.struct(
            here.alias("here"), F.size(F.filter(blocks, lambda cut: cut <= here)).alias("full")))
        place = F.transform(coarse, lambda at: at["full"] * block + F.size(F.filter(
            F.slice(cuts, at["full"] * block + 1, F.lit(block)), lambda cut: cut <= at["here"])))
        number = F.when(cuts.isNull(), 0)
        if self.lead_only:
            number = number.when(value.isNull(), F.size(cuts))  # missing values come last
        return (self.join_bounded(df, self.cuts)
                .withColumn(SLICE, number.otherwise(F.element_at(place, 1)).cast("int"))
                .drop("_cuts", "_blocks"))

    def join_bounded(self, df: DataFrame, small: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        """Left join with a table that has at most one row per slice (size is bounded by the plan)."""
        on = [*self.keys, *extra]
        if on:
            return null_safe_join(df, F.broadcast(small), on)
        # the whole table is one group: a single row of cuts under a constant key
        return (df.withColumn("_all", F.lit(0))
                .join(F.broadcast(small.withColumn("_all", F.lit(0))), "_all", "left").drop("_all"))

    def only_hot(self, df: DataFrame) -> DataFrame:
        """Rows of the groups that were cut."""
        if not self.keys:
            return df
        return null_safe_join(df, F.broadcast(self.cuts.select(*self.keys)), self.keys, "left_semi")


def plan_slices(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Order],
                limit: int | None = None, seed: int = 17) -> SlicePlan:
    """Measure the groups of ``df`` and decide where to cut.

    Runs one counting job over the key columns. Only when a group is above ``limit``
    does it also read a bounded sample of the oversized groups: at most
    ``rows / limit`` groups can be oversized and the slices of all of them together
    are at most twice that, which bounds the sample and everything broadcast later.
    """
    keys, order_by = tuple(keys), tuple(order_by)
    spark = df.sparkSession
    if keys:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
        rows, largest = sizes.agg(F.coalesce(F.sum("_size"), F.lit(0)),
                                  F.coalesce(F.max("_size"), F.lit(0))).first()
    else:
        rows = largest = df.count()
    limit = limit or ROWS_PER_SLICE
    if largest <= limit:
        return SlicePlan(keys, order_by, rows, largest, None)

    if keys:
        hot = sizes.where(F.col("_size") > limit)
        groups = {tuple(r[k] for k in keys): r["_size"] for r in hot.collect()}
        hot_keys = spark.createDataFrame([(*g,) for g in groups],
                                         T.StructType([df.schema[k] for k in keys]))
        rows_of_hot = null_safe_join(df, F.broadcast(hot_keys), keys, "left_semi")
    else:
        groups = {(): rows}
        rows_of_hot = df
    wanted = {g: ceil(size / limit) for g, size in groups.items()}
    fraction = min(1.0, SAMPLE_PER_SLICE * sum(wanted.values()) / sum(groups.values()))
    sample = (rows_of_hot.select(*keys, order_struct(order_by, df.schema).alias("_at"))
              .sample(fraction=fraction, seed=seed).distinct())

    seen: dict[tuple, list] = defaultdict(list)
    for r in sample.collect():
        seen[tuple(r[k] for k in keys)].append(r["_at"])
    found = {}
    for g, points in seen.items():
        points.sort()
        n = min(wanted[g], len(points))
        found[g] = sorted({points[i * len(points) // n] for i in range(1, n)})
    # When no two cuts of a group share the leading value, comparing that value alone gives
    # slices just as even, and much cheaper; a value too frequent for one slice shows up twice.
    lead_only = all(len({c["v0"] for c in cuts}) == len(cuts) and not any(c["n0"] for c in cuts)
                    for cuts in found.values())
    if lead_only:
        found = {g: [c["v0"] for c in cuts] for g, cuts in found.items()}
    # two steps of about sqrt(cuts) comparisons each find a row's slice
    block = max(1, isqrt(max((len(c) for c in found.values()), default=1)))
    lines = [(*g, cuts, cuts[block - 1::block]) for g, cuts in found.items()]
    whole = sample.schema["_at"].dataType
    at = T.ArrayType(whole["v0"].dataType if lead_only else whole)
    schema = T.StructType([*[df.schema[k] for k in keys],
                           T.StructField("_cuts", at), T.StructField("_blocks", at)])
    if not lines:  # the sample came back empty; correct all the same, only less even
        return SlicePlan(keys, order_by, rows, largest, None)
    return SlicePlan(keys, order_by, rows, largest, spark.createDataFrame(lines, schema), block, lead_only)
