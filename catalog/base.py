"""Registration of the checked queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its check."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def f32(c: Column | str) -> Column:
    """A double rounded to 4-byte precision: sums differ in their last bits with the row order."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("float").cast("double")


def f32_all(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.selectExpr(*[f"`{c}`" if c in keep else f"cast(cast(`{c}` as float) as double) as `{c}`" for c in df.columns])


def sql_f32(expression: str, name: str) -> str:
    return f"cast(cast({expression} as float) as double) as \"{name}\""


def forced_limit(df: DataFrame, slices: int = 500) -> int:
    """A group limit low enough to cut the larger groups of the test tables, yet never
    into more than about ``slices`` pieces altogether, however large the table."""
    return max(-(-df.count() // slices), 1)
