"""Category encoders: fixed codes, first-seen codes, response rates, group statistics.

A fitted encoder is a vocabulary: a small DataFrame with one row per category. It is
materialised when fitted and its size is checked before it is broadcast; a larger one
is joined by shuffle, where AQE splits a category that holds most of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from creditloom.functions.text import coded, name, with_text
from creditloom.operators.aggregate import Spec, grouped, spec_names, spec_text
from creditloom.operators.ordered import with_positions
from creditloom.operators.slices import Order, order_struct
from creditloom.session import materialise

#: A vocabulary up to this many rows is broadcast.
BROADCAST_ROWS = 100_000
#: Up to this many categories are written into the query as literals: no join at all.
LITERAL_ROWS = 64


def fixed_codes(df: DataFrame, tables: Mapping[str, Mapping]) -> DataFrame:
    """Replace columns by fixed codes; values outside of a table become NULL."""
    return with_text(df, {c: coded(name(c), codes) for c, codes in tables.items()})


def categories(df: DataFrame, column: str, limit: int = 1000) -> list:
    """Sorted distinct values, missing left out; refuses columns that are no category."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values; it is not a category column")
    return sorted(r[0] for r in found)


def lookup(df: DataFrame, vocabulary: DataFrame, on: Sequence[str], rows: int | None = None) -> DataFrame:
    """Left join with a materialised vocabulary, broadcast only when its counted size allows it."""
    rows = vocabulary.count() if rows is None else rows
    return df.join(F.broadcast(vocabulary) if rows <= BROADCAST_ROWS else vocabulary, list(on), "left")


def first_seen_codes(df: DataFrame, columns: Sequence[str], order_by: Sequence[str | Order]) -> DataFrame:
    """Vocabulary ``(column, value, code)``: categories numbered from 1 as they first appear.

    One pass: the least place in the order of each category, combined on the map side.
    """
    at = order_struct(order_by, df.schema)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    long = df.select(at.alias("_at"), pairs.alias("_p")).select("_at", "_p.column", "_p.value").where(F.col("value").isNotNull())
    places = materialise(long.groupBy("column", "value").agg(F.min("_at").alias("_at")))
    numbered = with_positions(places, ["column"], ["_at", "value"], position="code")
    return numbered.select("column", "value", F.col("code").cast("int").alias("code"))


def _by_column(vocabulary: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> tuple[dict, dict]:
    """Small vocabularies as ``{column: {value: fields}}``, and the sizes of the larger ones."""
    sizes = {r["column"]: r["count"] for r in vocabulary.groupBy("column").count().collect()}
    small = [c for c in columns if sizes.get(c, 0) <= LITERAL_ROWS]
    tables: dict[str, dict] = {c: {} for c in small}
    if small:  # at most LITERAL_ROWS rows per column
        for r in vocabulary.where(F.col("column").isin(small)).collect():
            tables[r["column"]][r["value"]] = [r[f] for f in fields]
    return tables, {c: sizes[c] for c in columns if c not in tables}


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by its code from :func:`first_seen_codes`."""
    codes = materialise(codes)
    tables, large = _by_column(codes, columns, ["code"])
    df = with_text(df, {c: coded(name(c), {v: k[0] for v, k in t.items()}) if t else "cast(NULL as int)"
                        for c, t in tables.items()})
    for c, rows in large.items():
        own = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias("_code"))
        df = lookup(df, own, [c], rows).drop(c).withColumnRenamed("_code", c)
    return df


def response_fit(train: DataFrame, columns: Sequence[str], label: str = "TARGET") -> DataFrame:
    """Vocabulary ``(column, value, p0, p1)``: share of each class per category, in one pass."""
    y = F.col(label)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                for c in columns]))
    long = train.select(y.alias("_y"), pairs.alias("_p")).select("_y", "_p.column", "_p.value")
    share = lambda k: F.avg(F.coalesce((F.col("_y") == k).cast("double"), F.lit(0.0)))
    return (long.where(F.col("value").isNotNull()).groupBy("column", "value")
            .agg(share(0).alias("p0"), share(1).alias("p1")))


def response_apply(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str], drop: bool = True) -> DataFrame:
    """Add ``<column>_0`` and ``<column>_1``; unseen categories get NULL."""
    tables, large = _by_column(vocabulary, columns, ["p0", "p1"])
    added = {}
    for c, t in tables.items():
        for k in (0, 1):
            added[f"{c}_{k}"] = (coded(f"cast({name(c)} as string)", {v: p[k] for v, p in t.items()}) if t
                                 else "cast(NULL as double)")
    df = with_text(df, added)
    for c, rows in large.items():
        own = vocabulary.where(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("p0").alias(f"{c}_0"), F.col("p1").alias(f"{c}_1"))
        small = F.broadcast(own) if rows <= BROADCAST_ROWS else own
        df = df.join(small, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")
    return df.drop(*columns) if drop else df


def response_out_of_fold(train: DataFrame, columns: Sequence[str], fold: str, label: str = "TARGET") -> DataFrame:
    """Response shares where a row's own fold is left out of the counts.

    Counts are kept per ``(category, fold)``; the share outside a fold is the category
    total minus that fold, so the table is read once, not once per fold.
    """
    y = F.col(label)
    for c in columns:
        counts = train.groupBy(c, fold).agg(F.count(F.lit(1)).alias("_n"),
                                            F.count_if(y == 0).alias("_n0"), F.count_if(y == 1).alias("_n1"))
        counts = materialise(counts)
        whole = counts.groupBy(c).agg(*[F.sum(k).alias(f"{k}_all") for k in ("_n", "_n0", "_n1")])
        rest = counts.join(whole, c)
        n = F.col("_n_all") - F.col("_n")
        rest = rest.select(c, fold, *[F.try_divide(F.col(f"_n{k}_all") - F.col(f"_n{k}"), n).alias(f"{c}_{k}")
                                      for k in (0, 1)])
        train = lookup(train, rest, [c, fold], counts.count())
    return train


def interactions_fit(train: DataFrame, groups: Sequence[Sequence[str]], spec: Spec) -> dict[tuple[str, ...], DataFrame]:
    """Statistics of ``spec`` per category tuple, named ``<COL>_<FN>_AGG_<tuple>``."""
    return {tuple(g): materialise(grouped(train, g, spec_text(spec, "_AGG_" + "_".join(g)))) for g in groups}


def interactions_apply(df: DataFrame, fitted: Mapping[tuple[str, ...], DataFrame]) -> DataFrame:
    for g, statistics in fitted.items():
        df = lookup(df, statistics, g)
    return df


def interaction_names(groups: Sequence[Sequence[str]], spec: Spec) -> list[str]:
    return [n for g in groups for n in spec_names(spec, "_AGG_" + "_".join(g))]
