"""Kernel density against the direct sum over all values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators.density import kernel_density


def test_against_the_direct_sum(spark):
    rng = np.random.default_rng(2)
    values = {"a": rng.normal(size=400), None: np.r_[rng.normal(size=150), rng.normal(5, 1, 250)], "one": np.ones(30), "single": np.array([3.0])}
    rows = [(k, float(x)) for k, xs in values.items() for x in xs] + [("a", None), ("a", float("nan")), ("gone", None)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("point", F.lit("x"))
    got = {}
    for r in kernel_density(df, "v", ["k"]).collect():
        got.setdefault(r.k, []).append((r.point, r.x, r.density))
    assert set(got) == {"a", None}
    for k, points in got.items():
        xs, h = values[k], values[k].std(ddof=1) * len(values[k]) ** -0.2
        points.sort()
        assert [p for p, _, _ in points] == list(range(200)) and points[0][1] == pytest.approx(xs.min() - 3 * h) and points[-1][1] == pytest.approx(xs.max() + 3 * h)
        direct = [np.exp(-0.5 * ((x - xs) / h) ** 2).sum() / (len(xs) * h * np.sqrt(2 * np.pi)) for _, x, _ in points]
        assert np.allclose([d for _, _, d in points], direct, atol=2e-3 * max(direct))
        assert np.trapezoid([d for _, _, d in points], [x for _, x, _ in points]) == pytest.approx(1, abs=0.01)


def test_whole_column_and_nothing(spark):
    df = spark.range(100).selectExpr("cast(id as double) as v")
    out = kernel_density(df, "v", grid=50)
    assert out.columns == ["point", "x", "density"] and out.count() == 50
    assert kernel_density(df.where("v < 0"), "v").count() == 0
