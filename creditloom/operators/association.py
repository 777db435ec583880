"""Association between columns: Pearson pairs, contingency tables, chi-square, Cramér's V, phi_K."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from creditloom.session import materialise

#: Correlations computed as plain aggregates; more are blocks of cross-products.
PAIRS_PER_PASS = 300
#: Columns of a block, rows multiplied at once, and parts in which a block is added up first.
BLOCK_COLUMNS, ROWS_PER_PRODUCT, MERGE_PARTS = 128, 4096, 64
#: Grid cells of a table that the phi_K integral takes at once.
BLOCK_CELLS = 100_000


def pearson_pairs(df: DataFrame, columns: Sequence[str], against: str | None = None) -> DataFrame:
    """``(column_a, column_b, r)`` for each pair, over the rows where both are present.

    Up to ``PAIRS_PER_PASS`` pairs are plain aggregates of one scan; more are blocks of cross-products (:func:`pearson_blocks`). A constant
    column, fewer than two shared rows, or a shared row with an infinite or NaN value give no ``r``.
    """
    pairs = [(c, against) for c in columns if c != against] if against else list(combinations(columns, 2))
    if len(pairs) > PAIRS_PER_PASS:
        return pearson_blocks(df, columns, against)
    row = df.agg(*[_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])))


def _block_pairs(columns: Sequence[str], against: str | None, width: int) -> tuple[list[str], list[tuple[slice, slice]]]:
    """Columns in the order they are read, and the pairs of column ranges whose products are wanted."""
    if against:
        names = [c for c in columns if c != against]
        cuts = [slice(i, min(i + width, len(names))) for i in range(0, len(names), width)]
        return [*names, against], [(c, slice(len(names), len(names) + 1)) for c in cuts]
    names = list(columns)
    cuts = [slice(i, min(i + width, len(names))) for i in range(0, len(names), width)]
    return names, [(x, y) for i, x in enumerate(cuts) for y in cuts[i:]]


def _cross_products(centres: np.ndarray, blocks: list[tuple[slice, slice]], batches):
    """A task's sums over its rows, a row a block: counts, sums, squares and products of the rows where both columns are present."""
    sums = [np.zeros((7, x.stop - x.start, y.stop - y.start)) for x, y in blocks]
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_PRODUCT):
            part = batch.slice(start, ROWS_PER_PRODUCT)
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in part.columns])
            value = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns]) - centres
            finite = known & np.isfinite(value)
            v, m, odd = np.where(finite, value, 0.0), known.astype(float), (known & ~finite).astype(float)
            squares = v * v
            for total, (x, y) in zip(sums, blocks):
                total += np.stack([m[:, x].T @ m[:, y], v[:, x].T @ m[:, y], m[:, x].T @ v[:, y], squares[:, x].T @ m[:, y],
                                   m[:, x].T @ squares[:, y], v[:, x].T @ v[:, y], odd[:, x].T @ m[:, y] + m[:, x].T @ odd[:, y]])
    n = len(blocks)
    yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([TaskContext.get().partitionId() % MERGE_PARTS] * n, pa.int32()),
                                      pa.array([t.tobytes() for t in sums], pa.binary())], names=["block", "part", "sums"])


def _total(rows: pd.DataFrame) -> np.ndarray:
    total = np.frombuffer(rows["sums"].iloc[0]).copy()
    for sums in rows["sums"].iloc[1:]:
        total += np.frombuffer(sums)
    return total


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": rows["block"].iloc[:1], "part": rows["part"].iloc[:1], "sums": [_total(rows).tobytes()]})


def pearson_blocks(df: DataFrame, columns: Sequence[str], against: str | None = None, width: int = BLOCK_COLUMNS) -> DataFrame:
    """What :func:`pearson_pairs` gives, for any number of columns from two scans.

    The first scan takes each column's mean, so that products lose no digits; in the second each task adds matrices of products
    for pairs of column blocks, which Spark adds up block by block in two rounds. A task holds 7 numbers a pair of columns, whatever the rows.
    """
    names, blocks = _block_pairs(columns, against, width)
    fields = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]
    wide = df.select(*fields)
    means = wide.agg(*[F.avg(F.when(F.abs(c) < float("inf"), F.col(c))).alias(c) for c in wide.columns]).first()
    centres = np.array([0.0 if v is None or not np.isfinite(v) else v for v in means])
    schema = "block int, part int, sums binary"
    some = wide.mapInArrow(partial(_cross_products, centres, blocks), schema).groupBy("block", "part").applyInPandas(_merge, schema)

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = blocks[int(rows["block"].iloc[0])]
        n, sx, sy, xx, yy, xy, odd = _total(rows).reshape(7, x.stop - x.start, y.stop - y.start)
        with np.errstate(all="ignore"):
            spread = np.maximum(xx - sx * sx / n, 0) * np.maximum(yy - sy * sy / n, 0)
            flat = (xx - sx * sx / n <= 1e-14 * xx) | (yy - sy * sy / n <= 1e-14 * yy)
            r = np.where((odd > 0) | flat | (n < 2), np.nan, (xy - sx * sy / n) / np.sqrt(spread))
        i, j = np.indices(n.shape)
        i, j, r = (i + x.start).ravel(), (j + y.start).ravel(), np.clip(r.ravel(), -1, 1)
        wanted = i < j  # a block beside itself holds each pair twice
        named = np.array(names, dtype=object)
        return pd.DataFrame({"column_a": named[i[wanted]], "column_b": named[j[wanted]],
                             "r": [float(v) if np.isfinite(v) else None for v in r[wanted]]}, dtype=object)

    return some.groupBy("block").applyInPandas(finish, "column_a string, column_b string, r double")


def _corr(a: Column, b: Column) -> Column:
    r = F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b)) * F.sqrt(F.regr_syy(a, b)))  # null for a constant column
    return F.when(~F.isnan(r), r)


def equal_width_bins(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Replace numeric columns by the number of their equal-width bin, missing staying missing."""
    if not columns:
        return df
    r = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.min(F.col(c).cast("double")).alias(f"l{i}"), F.max(F.col(c).cast("double")).alias(f"h{i}"))]).first()
    for i, c in enumerate(columns):
        low, high = r[f"l{i}"], r[f"h{i}"]
        width = ((high - low) / bins) if low is not None and high > low else 1.0
        place = F.floor((F.col(c).cast("double") - F.lit(low)) / F.lit(width))
        df = df.withColumn(c, F.least(place, F.lit(bins - 1)).cast("int"))
    return df


def contingency(df: DataFrame, pairs: Sequence[tuple[str, str]], ordered: bool = False) -> DataFrame:
    """``(column_a, column_b, value_a, value_b, n)`` of all pairs from one pass over the rows.

    ``ordered`` adds ``place_a`` and ``place_b``: the value of a numeric or boolean column as a number, missing for others.
    """
    def place(c: str) -> Column:
        kind = df.schema[c].dataType
        return F.col(c).cast("double") if isinstance(kind, (T.NumericType, T.BooleanType)) else F.lit(None).cast("double")

    items = F.explode(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                 F.col(a).cast("string").alias("value_a"), F.col(b).cast("string").alias("value_b"),
                 *([place(a).alias("place_a"), place(b).alias("place_b")] if ordered else []))
        for a, b in pairs]))
    cells = df.select(items.alias("p")).select("p.*")
    return (cells.where(F.col("value_a").isNotNull() & F.col("value_b").isNotNull())
            .groupBy(*cells.columns).agg(F.count(F.lit(1)).alias("n")))


def chi_square(tables: DataFrame) -> DataFrame:
    """Pearson's chi-square and Cramér's V per pair, from :func:`contingency`.

    Uses chi2 = N * (sum n_ij^2 / (n_i n_j) - 1), so cells without rows need no filling.
    """
    pair = ["column_a", "column_b"]
    rows = tables.groupBy(*pair, "value_a").agg(F.sum("n").alias("n_a"))
    cols = tables.groupBy(*pair, "value_b").agg(F.sum("n").alias("n_b"))
    both = tables.join(rows, [*pair, "value_a"]).join(cols, [*pair, "value_b"])
    n = F.col("n").cast("double")
    sums = both.groupBy(*pair).agg(
        F.sum(n * n / (F.col("n_a").cast("double") * F.col("n_b"))).alias("_s"), F.sum("n").alias("n"),
        F.count_distinct("value_a").alias("k_a"), F.count_distinct("value_b").alias("k_b"))
    chi2 = F.greatest(F.col("n") * (F.col("_s") - 1), F.lit(0.0))
    sums = sums.withColumn("chi2", chi2)
    smaller = F.least("k_a", "k_b") - 1
    return sums.select(*pair, "n", "k_a", "k_b", "chi2",
                       ((F.col("k_a") - 1) * (F.col("k_b") - 1)).alias("dof"),
                       F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * smaller)).alias("cramers_v"))


def phik_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], numeric: Sequence[str] = (),
               bins: int = 10) -> DataFrame:
    """phi_K of each pair (Baak et al., arXiv:1811.11440); numeric columns are cut in equal-width bins.

    Spark counts the tables; each table is then inverted on its own by the bivariate-normal integral, one task per pair,
    in blocks of ``BLOCK_CELLS`` grid cells. Numbers (bins, numeric codes) are ordered as numbers, others by name.
    """
    tables = materialise(contingency(equal_width_bins(df, list(numeric), bins), pairs, ordered=True))

    def axis(values: pd.Series, places: pd.Series) -> np.ndarray:
        """Number of each row's category in order."""
        order = {v: i for i, (_, v) in enumerate(sorted(set(zip(places.fillna(np.inf), values))))}
        return values.map(order).to_numpy()

    def invert(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        a, b = axis(cells["value_a"], cells["place_a"]), axis(cells["value_b"], cells["place_b"])
        n = np.zeros((a.max() + 1, b.max() + 1))
        np.add.at(n, (a, b), cells["n"].to_numpy(float))
        return pd.DataFrame({"column_a": [key[0]], "column_b": [key[1]], "phik": [phik_of_table(n)]})

    return tables.groupBy("column_a", "column_b").applyInPandas(
        invert, "column_a string, column_b string, phik double")


# ---- phi_K of one small table -------------------------------------------------

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(40)


def _normal_quantile(p: np.ndarray) -> np.ndarray:
    from statistics import NormalDist
    inverse = NormalDist().inv_cdf
    return np.array([-np.inf if v <= 0 else np.inf if v >= 1 else inverse(float(v)) for v in p])


def _normal_cells(a: np.ndarray, b: np.ndarray, rho: float) -> np.ndarray:
    """Probability of each cell of the grid with borders ``a`` x ``b`` under correlation ``rho``.

    Uses d/d(rho) P(X<=h, Y<=k) = density(h, k; rho), integrated from 0 by Gauss-Legendre.
    """
    base = np.outer(_cdf(a), _cdf(b))
    h, k = np.clip(a, -40, 40)[:, None, None], np.clip(b, -40, 40)[None, :, None]
    theta = np.arcsin(rho) * (_NODES + 1) / 2  # rho = sin(theta) keeps the integrand smooth
    s, c2 = np.sin(theta), np.cos(theta) ** 2
    step = max(1, BLOCK_CELLS // len(b))
    for start in range(0, len(a), step):
        part = h[start:start + step]
        inside = np.exp(-(part * part - 2 * part * k * s + k * k) / (2 * c2))
        base[start:start + step] += (inside * _WEIGHTS).sum(axis=2) * np.arcsin(rho) / 2 / (2 * np.pi)
    return np.diff(np.diff(base, axis=0), axis=1)


def _cdf(x: np.ndarray) -> np.ndarray:
    from statistics import NormalDist
    f = NormalDist().cdf
    return np.array([f(float(v)) if np.isfinite(v) else float(v > 0) for v in x])


def phik_of_table(n: np.ndarray) -> float | None:
    """phi_K of a contingency table of counts."""
    n = n[n.sum(axis=1) > 0][:, n.sum(axis=0) > 0]
    if min(n.shape) < 2:
        return None
    total = n.sum()
    p_a, p_b = n.sum(axis=1) / total, n.sum(axis=0) / total
    expected = np.outer(p_a, p_b) * total
    chi2 = ((n - expected) ** 2 / expected).sum()
    # pedestal: statistical noise expected of an independent table
    dof = (n.shape[0] - 1) * (n.shape[1] - 1)  # of the rows and columns that are not empty
    pedestal = dof + 1.5 * np.sqrt(2 * dof)
    a = np.concatenate(([-np.inf], _normal_quantile(np.cumsum(p_a)[:-1]), [np.inf]))
    b = np.concatenate(([-np.inf], _normal_quantile(np.cumsum(p_b)[:-1]), [np.inf]))

    def chi2_of(rho: float) -> float:
        """Noise-free chi-square of a binned normal with this correlation, per row."""
        cells = _normal_cells(a, b, rho)
        return float(((cells - np.outer(p_a, p_b)) ** 2 / np.outer(p_a, p_b)).sum())

    ceiling = min(n.shape) - 1.0  # per row
    top = chi2_of(0.9999)
    if chi2 <= pedestal or top <= 0:
        return 0.0
    largest = total * ceiling
    scale = (largest - pedestal) / (total * top) if largest > pedestal else 1.0
    target = (chi2 - pedestal) / (total * scale) if scale > 0 else top
    if target >= top:
        return 1.0
    low, high = 0.0, 0.9999
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_of(mid) < target else (low, mid)
    return (low + high) / 2
