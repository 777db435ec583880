"""Small hand-written tables, comparisons with pandas, and properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom.functions.nulls import differs, keep_between, nan_to_null, null_where
from creditloom.functions.text import coded, literal, ratio, with_text
from creditloom.operators.aggregate import Subset, aggregate, indicators, parse_spec, rest_of
from creditloom.operators.association import pearson_pairs, phik_of_table
from creditloom.operators.clean import constant_columns, narrow_types
from creditloom.operators.encode import apply_codes, first_seen_codes, response_apply, response_fit
from creditloom.operators.ewm import ewm, ewm_last
from creditloom.operators.folds import class_weights, stratified_folds, with_class_weight
from creditloom.operators.linear import Scaler, draw
from creditloom.operators.metrics import auc, j_threshold
from creditloom.operators.neighbours import neighbour_mean
from creditloom.operators.ordered import ecdf, first_rows, last_rows, percentiles, running_totals, with_positions
from creditloom.operators.slices import plan_slices
from creditloom.plans import bureau, instalments, merge, pos, specs


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- missing values -----------------------------------------------------------

def test_rest_keeps_missing(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "k long, c string")
    assert [r.k for r in df.where(differs("c", "A")).orderBy("k").collect()] == [2, 3]
    assert [r.k for r in df.where(rest_of("c", ["A"])).orderBy("k").collect()] == [2, 3]


def test_zero_division_is_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (6.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.selectExpr(ratio("a", "b", 0)).collect()] == [None, None, 2.0]


def test_null_where_and_limits(spark):
    df = spark.createDataFrame([(1,), (5,), (None,), (9,)], "x int")
    out = df.select(null_where("x", F.col("x") > 6), keep_between("x", 1, 9)).collect()
    assert [tuple(r) for r in out] == [(1, None), (5, 5), (None, None), (None, None)]


def test_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (2.0,)], "x double"))
    assert df.agg(F.avg("x")).first()[0] == 2.0


def test_literals(spark):
    values = ["it's", "back\\slash", 1.5, 3, None]
    got = spark.sql("select " + ", ".join(f"{literal(v)} as c{i}" for i, v in enumerate(values))).first()
    assert list(got) == values
    assert spark.sql(f"select {coded(literal('it' + chr(39) + 's'), {'it' + chr(39) + 's': 4})} as c").first()[0] == 4


# ---- aggregates ---------------------------------------------------------------

def test_absent_subset_is_missing_and_empty_sum_is_zero(spark):
    df = spark.createDataFrame([(1, "A", 2.0), (2, "B", None), (2, "B", None)], "k long, c string, x double")
    spec = parse_spec("x: sum mean")
    out = aggregate(df, ["k"], [(spec, Subset("_A", "c = 'A'")), (spec, Subset("_B", "c = 'B'"))])
    assert rows(out, "k") == [(1, 2.0, 2.0, None, None), (2, None, None, 0.0, None)]


def test_first_last_skip_missing(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (1, 3, None)], "k long, o int, x double")
    assert rows(aggregate(df, ["k"], [(parse_spec("x: first last"), Subset())], order="o")) == [(1, 5.0, 5.0)]


def test_missing_key_is_left_out(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0)], "k long, x double")
    assert rows(aggregate(df, ["k"], [(parse_spec("x: sum"), Subset())])) == [(1, 2.0)]


def test_one_aggregate_equals_filtered_joins(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 20, 300), "c": rng.choice(["A", "B", "C"], 300), "x": rng.integers(0, 50, 300).astype(float)})
    df = spark.createDataFrame(pdf)
    got = aggregate(df, ["k"], [(parse_spec("x: mean max"), Subset(f"_{c}", f"c = '{c}'")) for c in "AB"]).toPandas().set_index("k").sort_index()
    for c in "AB":
        want = pdf[pdf.c == c].groupby("k").x.agg(["mean", "max"]).reindex(got.index)
        assert np.allclose(got[[f"X_MEAN_{c}", f"X_MAX_{c}"]], want, equal_nan=True)


def test_indicators_of_missing_are_zero(spark):
    df = spark.createDataFrame([("A",), (None,)], "c string")
    assert rows(with_text(df, indicators("c", ["A", "B b"], "C")).select("C_A", "C_B_b"), F.desc("C_A")) == [(1.0, 0.0), (0.0, 0.0)]


# ---- order --------------------------------------------------------------------

def test_smoothing_carries_over_missing(spark):
    x = [None, 2.0, None, None, 5.0, 7.0, None]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "k long, t int, x double")
    want = [None, 2, 2, 2, 4.976190476190476, 6.660452729693741, 6.660452729693741]
    for options in ({}, {"longest_window": 0}, {"limit": 2, "longest_window": 0}):
        got = [r.EXP_x for r in ewm(df, ["k"], ["t"], ["x"], 0.8, **options).orderBy("t").collect()]
        assert got[0] is None and np.allclose(got[1:], want[1:])


def test_whole_table_smoothing(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, None, 3.0, 10.0])], "t int, x double")
    for limit in (None, 2):
        got = [r.EXP_x for r in ewm(df, [], ["t"], ["x"], 0.5, limit=limit).orderBy("t").collect()]
        assert np.allclose(got, [1, 1, 2.6, 7.153846153846154])


@pytest.fixture(scope="module")
def skewed():
    """One key holds 40 % of the rows, with a very long run of missing values."""
    rng = np.random.default_rng(0)
    n = 4000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.4, 7, rng.integers(0, 60, n)), "o": rng.permutation(n), "x": rng.normal(size=n)})
    pdf = pdf.sort_values(["k", "o"]).reset_index(drop=True)
    pdf.loc[rng.random(n) < 0.2, "x"] = np.nan
    pdf.loc[pdf.index[pdf.k == 7][100:1100], "x"] = np.nan
    return pdf


@pytest.mark.parametrize("options", [{}, {"longest_window": 0}, {"limit": 100}, {"limit": 7}])
def test_smoothing_equals_pandas(spark, skewed, options):
    want = skewed.assign(e=skewed.groupby("k").x.transform(lambda s: s.ewm(alpha=0.8).mean()), p=skewed.groupby("k").cumcount() + 1)
    df = spark.createDataFrame(skewed.astype(object).where(skewed.notna(), None), "k long, o long, x double").repartition(5)
    got = ewm(df, ["k"], ["o"], ["x"], 0.8, position="p", **options).toPandas().sort_values(["k", "o"]).reset_index(drop=True)
    assert (got.p == want.p).all() and (got.EXP_x.isna() == want.e.isna()).all()
    assert np.allclose(got.EXP_x, want.e, equal_nan=True, atol=1e-10)


def test_last_smoothed_value(spark, skewed):
    df = spark.createDataFrame(skewed.astype(object).where(skewed.notna(), None), "k long, o long, x double")
    got = ewm_last(df, ["k"], ["o"], ["x"], 0.8, limit=200).toPandas().set_index("k").sort_index()
    want = skewed.groupby("k").x.apply(lambda s: s.ewm(alpha=0.8).mean().iloc[-1])
    assert np.allclose(got.EXP_x, want, atol=1e-10)


@pytest.mark.parametrize("limit", [None, 150, 11])
def test_positions_and_percentiles_of_oversized_groups(spark, skewed, limit):
    df = spark.createDataFrame(skewed.astype(object).where(skewed.notna(), None), "k long, o long, x double")
    placed = with_positions(df, ["k"], ["o"], limit=limit).toPandas().sort_values(["k", "o"])
    assert (placed._pos.to_numpy() == skewed.groupby("k").cumcount().to_numpy() + 1).all()
    assert (placed._size.to_numpy() == skewed.groupby("k").k.transform("size").to_numpy()).all()
    p = percentiles(df, "x", [0, 0.1, 0.5, 0.9, 1], ["k"], limit=limit).toPandas().sort_values(["k", "fraction"])
    want = skewed.groupby("k").x.quantile([0, 0.1, 0.5, 0.9, 1])
    assert np.allclose(p.value, want)


def test_oversized_groups_are_really_cut(spark, skewed):
    df = spark.createDataFrame(skewed[["k", "o"]])
    plan = plan_slices(df, ["k"], ["o"], limit=200)
    sizes = plan.assign(df).groupBy("k", "_slice").count().agg(F.max("count")).first()[0]
    assert plan.hot and plan.largest > 1000 and sizes < 600
    assert plan_slices(df, ["k"], ["o"]).hot is False


def test_running_totals_of_doubles(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "o long, x double")
    got = running_totals(df, [], ["-o"], {"s": F.col("x")}, {"t": F.col("x")}, limit=9).orderBy("o").toPandas()
    assert np.allclose(got.s, np.arange(100)[::-1].cumsum()[::-1]) and (got.t == 4950).all()


def test_sentinels_sort_before_missing(spark):
    df = spark.createDataFrame([(1, 365243), (1, None), (1, -10), (1, -5)], "k long, d int")
    placed = with_positions(df, ["k"], ["d"]).orderBy("_pos").collect()
    assert [r.d for r in placed] == [-10, -5, 365243, None]
    assert [r.d for r in first_rows(df, ["k"], ["d"], 2).orderBy("d").collect()] == [-10, -5]
    assert {r.d for r in last_rows(df, ["k"], ["d"], 2).collect()} == {365243, None}


def test_ecdf_and_interpolation(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 3.0, 10.0])], "i long, x double")
    assert [r.cdf for r in ecdf(df, "x", ["i"]).orderBy("x").collect()] == pytest.approx([0, 1 / 3, 2 / 3, 1])
    assert percentiles(df, "x", [0.9]).first()["value"] == pytest.approx(7.9)


# ---- encoders, cleaning -------------------------------------------------------

def test_first_seen_codes_equal_enumeration(spark):
    pdf = pd.DataFrame({"i": range(200), "c": np.random.default_rng(1).choice(list("abcde"), 200)})
    codes = first_seen_codes(spark.createDataFrame(pdf).repartition(4), ["c"], ["i"])
    want = {v: i for i, v in enumerate(pdf.c.unique(), 1)}
    assert {r.value: r.code for r in codes.collect()} == want
    many = spark.createDataFrame(pdf.assign(c=pdf.i % 100))  # beyond the literals: joined
    out = apply_codes(many.withColumn("c", F.col("c").cast("string")), first_seen_codes(many.withColumn("c", F.col("c").cast("string")), ["c"], ["i"]), ["c"])
    assert rows(out.select("i", "c"), "i") == [(i, i % 100 + 1) for i in range(200)]


def test_response_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), (None, 0)], "c string, TARGET int")
    fitted = response_fit(df, ["c"])
    out = response_apply(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string"), fitted, ["c"]).collect()
    assert [tuple(r) for r in out] == [(0.5, 0.5), (0.0, 1.0), (None, None), (None, None)]


def test_constant_columns_and_types(spark):
    df = spark.createDataFrame([(1, 7, None, 1.5, 127), (2, 7, None, None, 300)], "a long, b int, c int, d double, e int")
    assert constant_columns(df) == ["b", "c"]
    assert narrow_types(df) == {"a": "tinyint", "b": "tinyint", "e": "smallint", "d": "float"}
    edge = spark.createDataFrame([(126, 127), (-127, 0)], "a int, b int")
    assert narrow_types(edge) == {"a": "tinyint", "b": "smallint"}


# ---- association, metrics, models ---------------------------------------------

def test_pearson_is_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 9.0)], "a double, b double")
    assert pearson_pairs(df, ["a", "b"]).first()["r"] == pytest.approx(0.96312313730186)


def test_phik_limits():
    assert phik_of_table(np.array([[50.0, 0], [0, 50]])) > 0.95
    assert phik_of_table(np.array([[25.0, 25], [25, 25]])) == 0.0
    assert phik_of_table(np.array([[10.0, 20.0]])) is None


def test_auc_with_ties_and_reversal(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 400), "p": rng.integers(0, 30, 400).astype(float)})
    pairs = pdf[pdf.y == 1].p.to_numpy()[:, None] - pdf[pdf.y == 0].p.to_numpy()[None, :]
    want = ((pairs > 0) + (pairs == 0) / 2).mean()
    df = spark.createDataFrame(pdf)
    assert auc(df, "y", "p", limit=4).first()["auc"] == pytest.approx(want)
    assert auc(df.withColumn("p", -F.col("p")), "y", "p").first()["auc"] == pytest.approx(1 - want)


def test_j_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.1)], "y int, p double")
    assert j_threshold(df, "y", "p").first()["threshold"] == 0.8
    worst = spark.createDataFrame([(0, 0.9), (1, 0.1)], "y int, p double")
    assert j_threshold(worst, "y", "p").first()["threshold"] == float("inf")


@pytest.mark.parametrize("limit", [None, 100])
def test_folds_are_even_and_stable(spark, limit):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "i long, y int")
    a = stratified_folds(df, ["i"], "y", 4, 7, limit=limit)
    assert sorted(r["count"] for r in a.groupBy("y", "fold").count().collect()) == [25] * 4 + [225] * 4
    assert rows(a, "i") == rows(stratified_folds(df.repartition(7), ["i"], "y", 4, 7), "i")
    assert {r.y: r.weight for r in class_weights(df, "y").collect()} == {0: 1000 / 1800, 1: 5.0}


def test_many_classes_all_get_weights(spark):
    df = spark.range(4500).select((F.col("id") % 1500).alias("y")).union(spark.createDataFrame([(None,)], "y long"))
    weighted = with_class_weight(df, "y")
    assert weighted.where("weight is null").count() == 1 and weighted.count() == 4501
    assert {round(r.weight, 9) for r in weighted.select("weight").distinct().collect() if r.weight} == {1.0}


def brute(ref, query, k, exclude=False):
    out = []
    for q in query:
        d = np.zeros(len(ref))
        for j in range(1, ref.shape[1] - 1):
            d += (ref[:, j] - q[j]) ** 2
        order = np.lexsort((ref[:, 0], d))
        if exclude:
            order = order[ref[order, 0] != q[0]]
        out.append(ref[order[:k], -1].mean())
    return np.array(out)


@pytest.mark.parametrize("exclude", [False, True])
def test_neighbours_equal_brute_force(spark, exclude):
    rng = np.random.default_rng(2)
    n = 900
    points = rng.normal(size=(n, 3))
    points[: n // 3] = 0.25  # a third of the rows are the same point
    points[n // 3: n // 2] = np.round(points[n // 3: n // 2], 1)  # many equal distances
    ref = np.column_stack([np.arange(n), points, rng.integers(0, 2, n)])
    df = spark.createDataFrame([(int(r[0]), *map(float, r[1:4]), int(r[4])) for r in ref], "i long, a double, b double, c double, y int")
    got = neighbour_mean(df, ["a", "b", "c"], "y", "i", 20, exclude_self=exclude, cell_rows=64).orderBy("i").toPandas()
    assert np.allclose(got.neighbour_mean, brute(ref, ref, 20, exclude))


def test_neighbours_of_other_rows_and_few_rows(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(5)], "i long, a double, y int")
    asked = spark.createDataFrame([(9, 100.0), (8, None)], "q long, a double")
    got = neighbour_mean(df, ["a"], "y", "i", 2, queries=asked).orderBy("q").toPandas()
    assert list(got.neighbour_mean) == [0.5, 0.5]
    assert neighbour_mean(df, ["a"], "y", "i", 50, queries=asked).first()["neighbour_mean"] == pytest.approx(0.4)


def test_scaler_and_draws(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    got = Scaler.fit(df, ["a", "b"]).apply(df).collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0), (0.0, 0.0)]
    assert draw(range(50), 15, 843) == draw(range(50), 15, 843) and len(set(draw(range(50), 15, 843))) == 15


# ---- plans --------------------------------------------------------------------

def test_spec_widths():
    width = lambda spec: sum(len(f) for _, f in spec)
    assert width(specs.BALANCE_ALL) + 3 * width(specs.BALANCE_YEAR) == 40
    assert width(specs.BUREAU_STATUS) == 52 and width(specs.PREVIOUS) == 133
    assert width(specs.INSTALMENT_ALL) == 30 and width(specs.INSTALMENT_PERIOD) == 24
    assert width(specs.INSTALMENT_APPLICANT) == 52 and width(specs.CARD_ALL) == 79 and width(specs.CARD_STATUS) == 27
    assert width(specs.POS_ALL) == 19 and width(specs.POS_STATUS) == 17
    assert 6 * width(specs.INTERACTION_STATS) == 174 and len(specs.SUMMED_DOCUMENTS) == 15


def test_balance_of_one_loan(spark):
    df = spark.createDataFrame([(1, 0, "C"), (1, -1, "0"), (1, -13, "5"), (1, -30, None), (2, -2, "?")], "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")
    r = bureau.balance_features(df).orderBy("SK_ID_BUREAU").collect()
    assert (r[0].STATUS_MAX, r[0].STATUS_FIRST, r[0].STATUS_LAST_YEAR_0, r[0].MONTHS_BALANCE_MAX) == (7, 7, 0, 2)
    assert r[0].STATUS_MEAN_YEAR_REST == 0 and r[1].STATUS_MEAN == 0


def test_inverted_limit_only_in_compat(spark):
    from catalog.credit_tables import credit_table
    table = credit_table(spark, "/root/testdata/sf0.001", "bureau")
    known = lambda compat: bureau.derived(table, compat).where("DAYS_CREDIT_ENDDATE is not null").agg(
        F.min("DAYS_CREDIT_ENDDATE"), F.max("DAYS_CREDIT_ENDDATE")).first()
    assert known(False)[0] > -18250 and known(True)[1] <= -18250


def test_table_scope_smoothing_runs_across_loans(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 1.0, -10.0, -8.0, 5.0, 4.0), (2, 2, 1.0, 1.0, -10.0, -9.0, 5.0, 5.0)],
                               "SK_ID_CURR long, SK_ID_PREV long, NUM_INSTALMENT_VERSION double, NUM_INSTALMENT_NUMBER double,"
                               " DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double")
    own = instalments.loan_features(df).orderBy("SK_ID_PREV").collect()
    table = instalments.loan_features(df, scope="table").orderBy("SK_ID_PREV").collect()
    assert [r.EXP_AMT_PAYMENT_DIFF_LAST for r in own] == [1.0, 0.0]
    assert [r.EXP_AMT_PAYMENT_DIFF_LAST for r in table] == pytest.approx([1.0, 1 / 3])


def test_cross_ratio_widths_and_name_rule():
    from catalog import credit
    columns = {"bureau": credit._names[False], "previous": credit._PREVIOUS_NAMES, "instalments": credit._INST_NAMES,
               "card": credit._CARD_NAMES}
    assert len(merge.cross_ratios(columns)) == 86
    assert pos.applicant_spec(["SK_ID_PREV", "A_MEAN", "B_MAX"]) == [("A_MEAN", ("mean", "sum", "max")), ("B_MAX", ("mean",))]


ORDERED = "k long, i long, ts timestamp, day date, name string, price decimal(18,2), flag boolean, part double, wall timestamp_ntz"


@pytest.fixture(scope="module")
def typed(spark):
    """One group of 900 rows under a missing key, a smaller one, and missing order values."""
    base = spark.range(1000).select(
        F.when(F.col("id") >= 900, F.lit(1)).cast("long").alias("k"), F.col("id").alias("i"),
        F.expr("case when id % 11 = 0 then null else timestamp_seconds(id * 7919 % 1000 * 3600) end").alias("ts"),
        F.expr("date_add(date'1969-06-01', cast(id * 31 % 400 as int))").alias("day"),
        F.expr("case when id % 13 = 0 then null else repeat(chr(cast(97 + id % 5 as int)), cast(id % 4 as int)) end").alias("name"),
        F.expr("cast(case when id % 3 = 0 then null else id * 12345678901.25 end as decimal(18,2))").alias("price"),
        F.expr("id % 2 = 0").alias("flag"), F.expr("case when id % 17 = 0 then double('NaN') else id * 37 % 100 - 50.0 end").alias("part"))
    return base.withColumn("wall", F.expr("cast(day as timestamp_ntz) + make_interval(0, 0, 0, 0, cast(i % 24 as int), 0, 0)")).cache()


@pytest.mark.parametrize("column", ["ts", "day", "name", "price", "flag", "part", "wall", "i"])
@pytest.mark.parametrize("sign", ["", "-"])
def test_any_order_is_the_same_when_cut(spark, typed, column, sign):
    order = [sign + column, "-i" if sign else "i"]
    whole = with_positions(typed, ["k"], order)
    cut = with_positions(typed, ["k"], order, limit=70)
    plan = plan_slices(typed, ["k"], order, limit=70)
    assert plan.hot and plan.assign(typed).where("k is null").groupBy("_slice").count().agg(F.max("count")).first()[0] < 450
    assert {(r.i, r._pos, r._size) for r in whole.collect()} == {(r.i, r._pos, r._size) for r in cut.collect()}


def test_running_sums_keep_type_and_missing_values_when_cut(spark, typed):
    sums = {"s": F.col("price"), "n": F.col("i"), "never": F.lit(None).cast("decimal(10,1)")}
    whole = running_totals(typed, ["k"], ["i"], sums, {"t": F.col("price")})
    cut = running_totals(typed, ["k"], ["i"], sums, {"t": F.col("price")}, limit=50)
    assert {c: t for c, t in whole.dtypes} == {c: t for c, t in cut.dtypes}
    pick = lambda df: sorted((r.i, r.s, r.n, r.never, r.t) for r in df.collect())
    assert pick(whole) == pick(cut)


@pytest.mark.parametrize("limit, longest", [(None, 5000), (None, 150), (None, 10), (60, 10), (60, 150)])
def test_smoothing_of_missing_keys_in_every_form(spark, typed, limit, longest):
    rows_ = typed.withColumn("x", F.when(F.col("i") % 5 != 0, F.col("i").cast("double")))
    got = ewm(rows_, ["k"], ["i"], ["x"], 0.3, position="place", limit=limit, longest_window=longest)
    want = ewm(rows_.withColumn("k", F.coalesce("k", F.lit(-1))), ["k"], ["i"], ["x"], 0.3, position="place")
    a, b = (df.select("i", "place", "EXP_x").orderBy("i").toPandas() for df in (got, want))
    assert (a.place == b.place).all() and np.allclose(a.EXP_x, b.EXP_x, equal_nan=True)
    last = ewm_last(rows_, ["k"], ["i"], ["x"], 0.3, limit=limit).collect()
    assert len(last) == 2


def test_model_queries_run_the_full_operators():
    """No registered model query asks for fewer trees, rounds, draws, folds or neighbours than its operator's default."""
    import ast

    from catalog import models

    cuts = {"trees", "term_trees", "depth", "max_rounds", "draws", "k", "neighbours"}
    calls = [c for c in ast.walk(ast.parse(open(models.__file__).read())) if isinstance(c, ast.Call)]
    assert not [(c.lineno, w.arg) for c in calls for w in c.keywords if w.arg in cuts]
