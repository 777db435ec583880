"""Correlations by blocks of cross-products against pandas, with gaps, constants, odd values and no rows."""

import numpy as np
import pandas as pd
import pytest

from creditloom.operators.association import pearson_blocks, pearson_pairs


def _columns(n: int = 400, k: int = 9) -> pd.DataFrame:
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) + 1e6 * np.arange(k)
    x[rng.random((n, k)) < 0.3] = np.nan
    frame = pd.DataFrame(x, columns=[f"x{i}" for i in range(k)])
    frame["same"] = 3.25
    frame["none"] = np.nan
    return frame


def _given(spark, frame: pd.DataFrame):
    fields = ", ".join(f"{c} double" for c in frame)
    rows = [tuple(None if v is None or v != v else float(v) for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, fields).repartition(5)


@pytest.mark.parametrize("width", [1, 4, 128])
def test_blocks_equal_pandas(spark, width):
    frame = _columns()
    found = {(r["column_a"], r["column_b"]): r["r"] for r in pearson_blocks(_given(spark, frame), list(frame), width=width).collect()}
    wanted = frame.corr()
    names = list(frame)
    assert set(found) == {(a, b) for i, a in enumerate(names) for b in names[i + 1:]}
    for (a, b), r in found.items():
        if "same" in (a, b) or "none" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(wanted.loc[a, b], abs=1e-9)


def test_blocks_equal_aggregates_against_one_column(spark):
    frame = _columns()
    df = _given(spark, frame)
    key = lambda r: (r["column_a"], r["column_b"])
    blocks = sorted(pearson_blocks(df, list(frame), "x3", width=3).collect(), key=key)
    plain = sorted(pearson_pairs(df, list(frame), "x3").collect(), key=key)
    assert [key(r) for r in blocks] == [key(r) for r in plain]
    assert [r["r"] is None for r in blocks] == [r["r"] is None for r in plain]
    assert np.allclose([r["r"] or 0 for r in blocks], [r["r"] or 0 for r in plain], atol=1e-9)


def test_odd_values_spoil_only_the_pairs_that_share_their_row(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 1.0, 2.0), (3.0, 5.0, 4.0), (float("inf"), None, 2.0), (4.0, 4.0, 9.0)], "a double, b double, c double")
    found = {(r["column_a"], r["column_b"]): r["r"] for r in pearson_blocks(df, ["a", "b", "c"]).collect()}
    assert found["a", "c"] is None
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 1, 5, 4])[0, 1])
    assert found["b", "c"] == pytest.approx(np.corrcoef([2, 1, 5, 4], [1, 2, 4, 9])[0, 1])


def test_no_rows_give_no_correlation(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [r["r"] for r in pearson_blocks(empty, ["a", "b"]).collect()] in ([None], [])
