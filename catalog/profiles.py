"""Profiles, association, classifier metrics."""

from __future__ import annotations

from catalog.base import f32, forced_limit, query, sql_f32, table
from creditloom.functions.text import with_text
from creditloom.operators.association import (chi_square, contingency, equal_width_bins, pearson_pairs, phik_pairs)
from creditloom.operators.density import kernel_density
from creditloom.operators.metrics import auc, confusion, j_threshold, roc_points, to_class
from creditloom.operators.profile import (category_counts, category_profile, default_rates, distinct_profile, duplicate_rows,
                                          null_profile, shape)
from pyspark.sql import functions as F

_DOCS = "select d.*, quality, toxic from documents d join labels using (doc_id)"


def _docs(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


@query("category_counts", f"""
select source as value, count(*) as n, {sql_f32('count(*) / sum(count(*)) over ()', 'share')} from documents group by source""")
def category_counts_source(spark, sf):
    out = category_counts(table(spark, sf, "documents"), "source")
    return out.select("value", "n", f32("share").alias("share"))


@query("category_profile", f"""
select source as value, count(*) as n, count(*) filter (where toxic = 1) as positives,
 {sql_f32('case when count(*) filter (where toxic = 1) > 0 then count(*) filter (where toxic = 1) * 100.0 / count(*) end', 'percent')}
from ({_DOCS}) group by source""")
def category_profile_source(spark, sf):
    out = category_profile(_docs(spark, sf), "source", "toxic")
    return out.select("value", "n", "positives", f32("percent").alias("percent"))


@query("default_rates", f"""
select source as value, {sql_f32('count(*) filter (where toxic = 1) * 100.0 / count(*)', 'percent')}
from ({_DOCS}) group by source having count(*) filter (where toxic = 1) > 0""")
def default_rates_source(spark, sf):
    """Categories without a positive are left out."""
    return default_rates(_docs(spark, sf), "source", "toxic").select("value", f32("percent").alias("percent"))


_DISTINCT = ["doc_id", "text", "lang", "source", "n_chars"]


@query("distinct_profile", " union all ".join(
    f"select '{c}' as \"column\", count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as n_values from documents" for c in _DISTINCT))
def distinct_profile_documents(spark, sf):
    return distinct_profile(table(spark, sf, "documents"), _DISTINCT)


@query("table_shape", "select count(*) as n_rows, 5 as n_columns from documents")
def table_shape(spark, sf):
    return shape(table(spark, sf, "documents"))


@query("class_balance", "select toxic, count(*) as n from labels group by toxic")
def class_balance(spark, sf):
    return table(spark, sf, "labels").groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))


@query("duplicate_rows", """
select cast(count(*) - (select count(*) from (select distinct text, lang, source, n_chars from documents)) as bigint) as n_duplicates from documents""")
def duplicate_rows_documents(spark, sf):
    """Rows equal to an earlier one in everything but the id, compared over whole texts."""
    return duplicate_rows(table(spark, sf, "documents"), ["text", "lang", "source", "n_chars"])


_GAPS = {"status": "case when o_orderkey % 5 = 0 then null else o_orderstatus end",
         "price": "case when o_orderkey % 4 = 0 then null else o_totalprice end", "priority": "o_orderpriority"}


@query("null_profile", " union all ".join(
    f"select '{n}' as \"column\", {sql_f32(f'avg(case when ({e}) is null then 1.0 else 0.0 end) * 100', 'percent')} from orders"
    for n, e in _GAPS.items()))
def null_profile_orders(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(*[f"{e} as {n}" for n, e in _GAPS.items()])
    return null_profile(orders).select("column", f32("percent").alias("percent")).orderBy(F.desc("percent"))


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "gap"]
_LINES = "select *, case when l_partkey % 6 = 0 then null else l_quantity * 3 + l_partkey end as gap from lineitem"


def _round(expression: str, name: str) -> str:
    return f"round({expression}, 8) as \"{name}\""


@query("pearson_matrix", f"with l as ({_LINES}) " + " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, {_round(f'corr({a}, {b})', 'r')} from l"
    for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1:]))
def pearson_matrix(spark, sf):
    """Every pair over the rows where both values are present."""
    lines = with_text(table(spark, sf, "lineitem"), {"gap": "case when l_partkey % 6 = 0 then null else l_quantity * 3 + l_partkey end"})
    return pearson_pairs(lines, _NUMERIC).select("column_a", "column_b", F.round("r", 8).alias("r"))


@query("pearson_top", f"with l as ({_LINES}), r as (" + " union all ".join(
    f"select '{a}' as column_a, abs(corr({a}, l_extendedprice)) as r from l" for a in _NUMERIC if a != "l_extendedprice")
       + ") select column_a, round(r, 8) as r from r order by r desc, column_a limit 2")
def pearson_top(spark, sf):
    """The strongest correlations with one column."""
    lines = with_text(table(spark, sf, "lineitem"), {"gap": "case when l_partkey % 6 = 0 then null else l_quantity * 3 + l_partkey end"})
    out = pearson_pairs(lines, _NUMERIC, against="l_extendedprice").select("column_a", F.abs("r").alias("r"))
    return out.orderBy(F.desc("r"), "column_a").limit(2).select("column_a", F.round("r", 8).alias("r"))


#: More columns than plain aggregates take: each with gaps of its own.
_WIDE = {f"w{k}": f"case when (l_orderkey + 7 * l_linenumber) % {k + 3} = 0 then null else l_quantity * {k % 5} + (l_partkey * {2 * k + 1}) % {k + 11} end"
         for k in range(26)}


@query("pearson_wide", f"with l as (select {', '.join(f'{e} as {c}' for c, e in _WIDE.items())} from lineitem), r as (select " + ", ".join(
    f"corr({a}, {b}) as {a}_{b}" for i, a in enumerate(_WIDE) for b in list(_WIDE)[i + 1:]) + " from l) " + " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, {_round(f'case when not isnan({a}_{b}) then {a}_{b} end', 'r')} from r" for i, a in enumerate(_WIDE) for b in list(_WIDE)[i + 1:]))
def pearson_wide(spark, sf):
    """Every pair of many columns, by blocks of cross-products; a constant column (w10) has no correlation."""
    lines = table(spark, sf, "lineitem").selectExpr(*[f"{e} as {c}" for c, e in _WIDE.items()])
    return pearson_pairs(lines, list(_WIDE)).select("column_a", "column_b", F.round("r", 8).alias("r"))


_PAIRS = [("lang", "toxic"), ("source", "toxic"), ("lang", "quality"), ("lang", "source")]


def _table_sql(a: str, b: str) -> str:
    return (f"select '{a}' as column_a, '{b}' as column_b, cast({a} as varchar) as value_a, cast({b} as varchar) as value_b,"
            f" count(*) as n from d where {a} is not null and {b} is not null group by {a}, {b}")


@query("contingency", f"with d as ({_DOCS}) " + " union all ".join(_table_sql(a, b) for a, b in _PAIRS))
def contingency_tables(spark, sf):
    return contingency(_docs(spark, sf), _PAIRS)


@query("chi_square", f"with d as ({_DOCS}), t as (" + " union all ".join(_table_sql(a, b) for a, b in _PAIRS) + """),
m as (select *, sum(n) over (partition by column_a, column_b, value_a) as na, sum(n) over (partition by column_a, column_b, value_b) as nb,
 sum(n) over (partition by column_a, column_b) as nn from t),
s as (select column_a, column_b, cast(max(nn) as bigint) as n, count(distinct value_a) as k_a, count(distinct value_b) as k_b,
 max(nn) * (sum(cast(n as double) * n / (cast(na as double) * nb)) - 1) as chi2 from m group by 1, 2)
select column_a, column_b, n, k_a, k_b, round(chi2, 6) as chi2, (k_a - 1) * (k_b - 1) as dof,
 round(sqrt(chi2 / (n * (least(k_a, k_b) - 1))), 6) as cramers_v from s""")
def chi_square_pairs(spark, sf):
    out = chi_square(contingency(_docs(spark, sf), _PAIRS))
    return out.select("column_a", "column_b", "n", "k_a", "k_b", F.round("chi2", 6).alias("chi2"), "dof",
                      F.round("cramers_v", 6).alias("cramers_v"))


@query("binned_contingency", f"""
with d as ({_DOCS}), r as (select min(n_chars) lo, (max(n_chars) - min(n_chars)) / 10 w from d)
select cast(least(floor((n_chars - lo) / w), 9) as integer) as bin, toxic, count(*) as n from d, r group by 1, 2""")
def binned_contingency(spark, sf):
    """A numeric column in ten equal-width bins against the label."""
    binned = equal_width_bins(_docs(spark, sf), ["n_chars"])
    return binned.groupBy(F.col("n_chars").alias("bin"), "toxic").agg(F.count(F.lit(1)).alias("n"))


@query("phik_topk")
def phik_topk(spark, sf):
    """The columns most associated with the label by phi_K; numeric columns are binned first."""
    pairs = [(c, "toxic") for c in ("lang", "source", "n_chars", "quality")]
    out = phik_pairs(_docs(spark, sf), pairs, numeric=["n_chars"])
    return out.orderBy(F.desc("phik"), "column_a").limit(10)


@query("phik_matrix")
def phik_matrix(spark, sf):
    """phi_K of every pair of category columns."""
    columns = ["toxic", "lang", "source", "quality"]
    return phik_pairs(_docs(spark, sf), [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]])


_SCORED = "select doc_id, toxic, cast(n_chars as double) as score from documents join labels using (doc_id)"
_ROC = f"""with s as ({_SCORED}), g as (select score, count(*) filter (where toxic = 1) as pos, count(*) filter (where toxic = 0) as neg from s group by score),
r as (select score, pos, neg, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp,
 sum(pos) over () as p, sum(neg) over () as n from g)"""


def _scored(spark, sf):
    return _docs(spark, sf).select("doc_id", "toxic", F.col("n_chars").cast("double").alias("score"))


@query("roc_points", _ROC + f" select score as threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp, {sql_f32('tp / p', 'tpr')}, {sql_f32('fp / n', 'fpr')} from r")
def roc_points_documents(spark, sf):
    scored = _scored(spark, sf)
    out = roc_points(scored, "toxic", "score", limit=forced_limit(scored, 20))
    return out.select("threshold", "tp", "fp", f32("tpr").alias("tpr"), f32("fpr").alias("fpr"))


@query("roc_j_threshold", _ROC + f""", j as (select score, tp / p - fp / n as j from r order by j desc, score desc limit 1)
select score as threshold, {sql_f32('j', 'j')}, (select count(*) from s, j where s.score >= j.score) as n_predicted from j""")
def roc_j_threshold(spark, sf):
    """The threshold of the largest TPR - FPR and how many rows it predicts positive."""
    scored = _scored(spark, sf)
    best = j_threshold(scored, "toxic", "score").first()
    predicted = scored.agg(F.sum(to_class("score", best["threshold"])).alias("n_predicted"))
    return predicted.select(F.lit(best["threshold"]).alias("threshold"), f32(F.lit(best["j"])).alias("j"),
                            F.col("n_predicted").cast("bigint").alias("n_predicted"))


@query("auc_confusion", _ROC + f""", c as (select count(*) filter (where toxic = 1 and score >= 500) as tp, count(*) filter (where toxic = 0 and score >= 500) as fp,
 count(*) filter (where toxic = 1 and score < 500) as fn, count(*) filter (where toxic = 0 and score < 500) as tn from s)
select {sql_f32('(select sum(neg * (tp - pos / 2)) / (max(p) * max(n)) from r)', 'auc')}, tp, fp, fn, tn,
 {sql_f32('tp / (tp + fp)', 'precision')}, {sql_f32('tp / (tp + fn)', 'recall')} from c""")
def auc_confusion(spark, sf):
    scored = _scored(spark, sf).withColumn("predicted", to_class("score", 500))
    one = F.lit(1)
    both = (auc(scored, "toxic", "score").withColumn("_one", one)
            .join(confusion(scored, "toxic", "predicted").withColumn("_one", one), "_one"))
    return both.select(f32("auc").alias("auc"), "tp", "fp", "fn", "tn", f32("precision").alias("precision"), f32("recall").alias("recall"))


_DENSITY = f"""
with v as (select case when c_nationkey < 3 then null else c_nationkey % 2 end as k, c_acctbal::double as v from customer where c_acctbal is not null),
f as (select k, count(*) as n, stddev_samp(v) * pow(count(*), -0.2) as h, min(v) as a, max(v) as b from v group by k),
g as (select k, n, h, a - 3 * h as low, (b + 3 * h - (a - 3 * h)) / 199 as step from f),
p as (select v.k, (v - low) / step as p from v join g on v.k is not distinct from g.k),
c as (select k, p, least(floor(p), 198) as cell from p),
m as (select k, cell as spot, sum(1 - (p - cell)) as w from c group by all union all select k, cell + 1, sum(p - cell) from c group by all),
x as (select g.*, unnest(range(200)) as point from g)
select x.k, point::integer as point, {sql_f32('min(low + point * step)', 'x')},
    {sql_f32('sum(w * exp(-0.5 * pow((point - spot) * step / h, 2))) / (min(n) * min(h) * sqrt(2 * pi()))', 'density')}
from x join m on x.k is not distinct from m.k group by x.k, point"""


@query("kernel_density", _DENSITY)
def kernel_density_by_class(spark, sf):
    """Density of a column by class, a missing class among them, at 200 points."""
    rows = table(spark, sf, "customer").selectExpr("case when c_nationkey < 3 then null else c_nationkey % 2 end as k", "c_acctbal")
    return kernel_density(rows, "c_acctbal", ["k"]).select("k", "point", f32("x").alias("x"), f32("density").alias("density"))
