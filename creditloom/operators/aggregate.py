"""Wide aggregates declared as specs, optionally restricted to subsets of the rows.

One ``groupBy().agg()`` covers the whole table and every subset (category, period,
first / last rows): a subset is a predicate inside the aggregate, not a filtered copy
of the table that has to be joined back. All functions merge on the map side, so one
key with very many rows does not end up in one task.

Missing values are skipped. ``sum`` over rows that are all missing is 0, but every
aggregate of a subset without rows is NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from creditloom.functions.naming import safe, spec_alias
from creditloom.functions.text import literal, name, with_text

Spec = Sequence[tuple[str, tuple[str, ...]]]


def parse_spec(text: str) -> list[tuple[str, tuple[str, ...]]]:
    """``"A: mean max"`` per line -> ``[("A", ("mean", "max"))]``."""
    spec = []
    for line in text.strip().splitlines():
        column, fns = line.split(":")
        spec.append((column.strip(), tuple(fns.split())))
    return spec


@dataclass(frozen=True)
class Subset:
    """Rows matching ``predicate`` (SQL text); their aggregates get ``suffix``. No predicate: all rows."""

    suffix: str = ""
    predicate: str | None = None


def one(column: str, fn: str, order: str | None = None, within: str | None = None) -> str:
    """A single aggregate as SQL text; ``within`` is a boolean column naming its rows.

    ``first`` / ``last`` skip missing values and need a numeric ``order`` column (with a
    primitive order the state stays a fixed-width row and Spark aggregates by hashing).
    """
    c = name(column)
    x = c if within is None else f"if({within}, {c}, NULL)"
    if fn == "mean":
        return f"avg({x})"
    if fn in ("min", "max", "count"):
        return f"{fn}({x})"
    if fn == "sum":
        total = f"coalesce(sum({x}), 0)"
        return total if within is None else f"if(count_if({within}) > 0, {total}, NULL)"
    if fn in ("first", "last"):
        if order is None:
            raise ValueError(f"{fn} of {column} needs an order column")
        known = f"{c} is not null" + (f" and {within}" if within else "")
        return f"{'min_by' if fn == 'first' else 'max_by'}({c}, if({known}, {name(order)}, NULL))"
    raise ValueError(f"unknown aggregate {fn!r}")


def spec_text(spec: Spec, suffix: str = "", order: str | None = None, within: str | None = None) -> list[str]:
    return [f"{one(c, fn, order, within)} as {name(spec_alias(c, fn, suffix))}" for c, fns in spec for fn in fns]


def spec_names(spec: Spec, suffix: str = "") -> list[str]:
    return [spec_alias(c, fn, suffix) for c, fns in spec for fn in fns]


def grouped(df: DataFrame, keys: Sequence[str], items: Iterable[str]) -> DataFrame:
    """Aggregates given as SQL text; rows with a missing key are left out."""
    listed = ", ".join(name(k) for k in keys)
    known = " and ".join(f"{name(k)} is not null" for k in keys)
    return df.sparkSession.sql(f"select {', '.join([listed, *items])} from {{rows}} where {known} group by {listed}", rows=df)


def aggregate(df: DataFrame, keys: Sequence[str], parts: Iterable[tuple[Spec, Subset]],
              order: str | None = None, extra: Iterable[str] = ()) -> DataFrame:
    """All ``parts`` in one aggregate. Each subset is tested once per row, as a boolean column."""
    parts = list(parts)
    flags = {f"_in{i}": f"coalesce({s.predicate}, false)" for i, (_, s) in enumerate(parts) if s.predicate}
    items = [t for i, (spec, s) in enumerate(parts)
             for t in spec_text(spec, s.suffix, order, f"_in{i}" if s.predicate else None)]
    return grouped(with_text(df, flags) if flags else df, keys, [*items, *extra])


def rest_of(column: str, values: Sequence) -> str:
    """Predicate for the rows in none of the categories; a missing category is one of them."""
    return f"not coalesce({name(column)} in ({', '.join(literal(v) for v in values)}), false)"


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Mean of each column per group."""
    return grouped(df, keys, [f"avg({name(c)}) as {name(c + suffix)}" for c in columns])


def indicators(column: str, values: Sequence, prefix: str) -> dict[str, str]:
    """One 0/1 column per category, as text; a missing value is 0 everywhere."""
    return {f"{prefix}_{safe(v)}": f"cast(coalesce({name(column)} = {literal(v)}, false) as double)" for v in values}


def indicator_shares(column: str, values: Sequence, prefix: str) -> list[str]:
    """Share of the rows of a group in each category."""
    return [f"avg({e}) as {name(n)}" for n, e in indicators(column, values, prefix).items()]
