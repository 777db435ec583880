"""Column naming: aggregate aliases, safe category names, selection by substring."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame


def spec_alias(column: str, fn: str, suffix: str = "") -> str:
    """``AMT_CREDIT``, ``mean``, ``_ALL`` -> ``AMT_CREDIT_MEAN_ALL``."""
    return f"{column}_{fn}".upper() + suffix


def safe(value: object) -> str:
    """A category value as part of a column name, without blanks or punctuation."""
    return re.sub(r"[^0-9A-Za-z]+", "_", str(value)).strip("_")


def having(columns: Iterable[str], *include: str, without: Iterable[str] = ()) -> list[str]:
    """Columns whose name holds every ``include`` part and no ``without`` part."""
    without = list(without)
    return [c for c in columns
            if all(p in c for p in include) and not any(p in c for p in without)]


def columns_of_type(df: DataFrame, *types: str) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in types]


NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def numeric_columns(df: DataFrame, without: Iterable[str] = ()) -> list[str]:
    without = set(without)
    return [c for c in columns_of_type(df, *NUMERIC) if c not in without]


def assert_unique(df: DataFrame) -> DataFrame:
    """Fail early when two columns differ only in case: Spark would call them ambiguous."""
    seen: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in seen:
            raise ValueError(f"columns {seen[c.lower()]!r} and {c!r} collide")
        seen[c.lower()] = c
    return df
