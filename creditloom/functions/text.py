"""Column expressions as SQL text.

The feature tables are hundreds of columns wide. As text a whole select list reaches
Spark in one call; built from ``Column`` objects the driver would spend longer on
making the plan than the cluster on running it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def name(column: str) -> str:
    return f"`{column}`"


def literal(value) -> str:
    """A value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D" if abs(value) != float("inf") and value == value else f"double('{value}')"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def ratio(a: str, b: str, eps: float = 1e-5) -> str:
    """``a / (b + eps)``, NULL instead of an error or an infinity."""
    denominator = f"({b}) + {eps!r}D" if eps else f"({b})"
    return f"try_divide(cast({a} as double), cast({denominator} as double))"


def row_sum(columns: Iterable[str]) -> str:
    """Sum over a row; missing as soon as one part is missing."""
    return "(" + " + ".join(columns) + ")"


def row_product(columns: Iterable[str]) -> str:
    return "(" + " * ".join(columns) + ")"


def row_mean(columns: Iterable[str]) -> str:
    columns = list(columns)
    return f"({row_sum(columns)} / {float(len(columns))!r}D)"


def row_variance(columns: Iterable[str]) -> str:
    """Population variance over a row."""
    columns = list(columns)
    mean = row_mean(columns)
    return f"({row_sum(f'({c} - {mean}) * ({c} - {mean})' for c in columns)} / {float(len(columns))!r}D)"


def row_missing(columns: Iterable[str]) -> str:
    """Number of missing cells of a row."""
    return row_sum(f"cast({name(c)} is null as int)" for c in columns)


def null_where(column: str, predicate: str) -> str:
    return f"if({predicate}, NULL, {column})"


def coded(column: str, codes: Mapping) -> str:
    """Code of each value by a table of literals; values outside of it become NULL."""
    pairs = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in codes.items())
    return f"try_element_at(map({pairs}), {column})"


def with_text(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add or replace columns given as SQL text, all in one projection."""
    kept = [f"({columns[c]}) as {name(c)}" if c in columns else name(c) for c in df.columns]
    added = [f"({e}) as {name(c)}" for c, e in columns.items() if c not in df.columns]
    return df.selectExpr(*kept, *added)
