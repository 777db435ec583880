"""Reading the input tables: CSV with types known from the column names, or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from creditloom.functions.nulls import nan_to_null
from creditloom.sources.schemas import TABLES, header_schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV table with a header. Types come from ``schema`` or the column names, never from
    a pass over the data."""
    schema = schema if schema is not None else header_schema(spark, path)
    return nan_to_null(spark.read.option("header", True).option("nanValue", "NaN").schema(schema).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def load_tables(spark: SparkSession, directory: str, names: list[str] | None = None,
                fmt: str = "csv") -> dict[str, DataFrame]:
    """All input tables of ``directory`` by name. No row is read until a table is used."""
    read = read_csv if fmt == "csv" else read_parquet
    return {name: read(spark, f"{directory.rstrip('/')}/{name}.{fmt}") for name in names or TABLES}
