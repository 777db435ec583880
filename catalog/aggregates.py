"""Conditional aggregates, roll-ups, joins."""

from __future__ import annotations

from catalog.base import f32, f32_all, query, sql_f32, table
from catalog.sqlgen import f32_list, select_list, spec_items
from creditloom.functions.naming import having, numeric_columns
from creditloom.functions.text import with_text
from creditloom.operators.aggregate import (Subset, aggregate, group_means, grouped, indicator_shares, one, parse_spec,
                                            rest_of, spec_names)
from creditloom.operators.joins import left_join_detail
from creditloom.operators.ordered import first_rows, last_rows, with_positions
from pyspark.sql import functions as F

# an order's amount is missing in every seventh order: the sources have no missing values
_ORDERS = "case when o_orderkey % 7 = 0 then null else floor(o_totalprice) end"
_DAY = "(extract(year from o_orderdate) * 372 + extract(month from o_orderdate) * 31 + extract(day from o_orderdate))"
_PLACED = (f"select *, {_ORDERS} as amount, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as place,"
           " count(*) over (partition by o_custkey) as n from orders")


def _orders(spark, sf):
    return with_text(table(spark, sf, "orders"), {"amount": _ORDERS})


_FLAG = parse_spec("amount: sum mean max first last\no_orderkey: count")
_STATUS = parse_spec("amount: sum mean min max first last")
_FLAG_SQL = spec_items(_FLAG, "place") + [i for s in "FOP" for i in spec_items(_STATUS, "place", f"o_orderstatus = '{s}'", f"_{s}")]
_FLAG_NAMES = [n for n, _ in _FLAG_SQL]


@query("flagship_customer_features", f"""
with p as ({_PLACED}),
a as (select o_custkey, {select_list(_FLAG_SQL)} from p group by o_custkey)
select c_custkey, c_mktsegment, {f32_list(_FLAG_NAMES)} from customer left join a on c_custkey = o_custkey""")
def flagship_customer_features(spark, sf):
    """Order history per customer, overall and per status, joined left to the customers."""
    placed = with_positions(_orders(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"], position="place", size="n")
    parts = [(_FLAG, Subset())] + [(_STATUS, Subset(f"_{s}", f"o_orderstatus = '{s}'")) for s in "FOP"]
    history = aggregate(placed, ["o_custkey"], parts, order="place").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return f32_all(customers.join(history, "c_custkey", "left"), ["c_custkey", "c_mktsegment"])


_LINE = parse_spec("l_extendedprice: sum mean max min\nl_quantity: sum mean")
_FLAGGED = "case when l_partkey % 11 = 0 then null else l_returnflag end"
_FLAG_SETS = {"_A": "flag = 'A'", "_N": "flag = 'N'", "_REST": "(flag is null or flag not in ('A', 'N'))"}
_LINE_SQL = [i for s, p in _FLAG_SETS.items() for i in spec_items(_LINE, None, p, s)]


@query("cond_agg_rest_nullsafe", f"""
with l as (select *, {_FLAGGED} as flag from lineitem),
a as (select l_suppkey, {select_list(_LINE_SQL)} from l group by l_suppkey)
select l_suppkey, {f32_list(n for n, _ in _LINE_SQL)} from a""")
def cond_agg_rest_nullsafe(spark, sf):
    """Two named categories and the rest, where a missing category belongs to the rest."""
    lines = with_text(table(spark, sf, "lineitem"), {"flag": _FLAGGED})
    parts = [(_LINE, Subset("_A", "flag = 'A'")), (_LINE, Subset("_N", "flag = 'N'")),
             (_LINE, Subset("_REST", rest_of("flag", ["A", "N"])))]
    return f32_all(aggregate(lines, ["l_suppkey"], parts), ["l_suppkey"])


_YEAR = parse_spec("amount: mean max first last\nplace: max")
_YEAR_SETS = {"_YEAR_0": "age = 0", "_YEAR_1": "age = 1", "_YEAR_REST": "age > 1"}
_YEAR_SQL = [i for s, p in _YEAR_SETS.items() for i in spec_items(_YEAR, "place", p, s)]


@query("agg_by_year_bucket", f"""
with p as (select *, floor((2002 * 12 - (extract(year from o_orderdate) * 12 + extract(month from o_orderdate))) / 12) - 1 as age
           from ({_PLACED})),
a as (select o_custkey, {select_list((n, f'coalesce({e}, 0)') for n, e in _YEAR_SQL)} from p group by o_custkey)
select o_custkey, {f32_list(n for n, _ in _YEAR_SQL)} from a""")
def agg_by_year_bucket(spark, sf):
    """Months to years, one subset per year, gaps filled with 0."""
    rows = with_text(_orders(spark, sf), {
        "age": "floor((2002 * 12 - (extract(year from o_orderdate) * 12 + extract(month from o_orderdate))) / 12) - 1"})
    placed = with_positions(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], position="place", size="n")
    out = aggregate(placed, ["o_custkey"], [(_YEAR, Subset(s, p)) for s, p in _YEAR_SETS.items()], order="place")
    return f32_all(out.fillna(0, subset=out.columns[1:]), ["o_custkey"])


_ENDS = parse_spec("amount: mean sum max first last\no_totalprice: max")
_ENDS_SETS = {"_LAST_5": "n - place < 5", "_FIRST_2": "place <= 2", "_ALL": "place > 0"}
_ENDS_SQL = [i for s, p in _ENDS_SETS.items() for i in spec_items(_ENDS, "place", p, s)]


@query("agg_first2_last5_all", f"""
with p as ({_PLACED}), a as (select o_custkey, {select_list(_ENDS_SQL)} from p group by o_custkey)
select o_custkey, {f32_list(n for n, _ in _ENDS_SQL)} from a""")
def agg_first2_last5_all(spark, sf):
    """First two, last five and all rows of a group in one aggregate."""
    placed = with_positions(_orders(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"], position="place", size="n")
    out = aggregate(placed, ["o_custkey"], [(_ENDS, Subset(s, p)) for s, p in _ENDS_SETS.items()], order="place")
    return f32_all(out, ["o_custkey"])


@query("first_rows_per_group", f"select o_custkey, o_orderkey from ({_PLACED}) where place <= 2")
def first_rows_per_group(spark, sf):
    return first_rows(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 2).select("o_custkey", "o_orderkey")


@query("last_rows_per_group", f"select o_custkey, o_orderkey from ({_PLACED}) where n - place < 5")
def last_rows_per_group(spark, sf):
    return last_rows(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 5).select("o_custkey", "o_orderkey")


_LOAN = parse_spec("price: sum mean max\nl_quantity: sum\nl_linenumber: max")
_APPLICANT = parse_spec("PRICE_SUM: mean sum max\nPRICE_MEAN: mean min max\nPRICE_MAX: max\nL_QUANTITY_SUM: sum\nL_LINENUMBER_MAX: mean")
_LINES = "select *, floor(l_extendedprice) as price from lineitem join orders on l_orderkey = o_orderkey"


def _lines(spark, sf):
    return with_text(table(spark, sf, "lineitem"), {"price": "floor(l_extendedprice)"})


@query("two_level_rollup", f"""
with l as ({_LINES}), loans as (select o_custkey, l_orderkey, {select_list(spec_items(_LOAN))} from l group by o_custkey, l_orderkey),
a as (select o_custkey, {select_list(spec_items(_APPLICANT))} from loans group by o_custkey)
select o_custkey, {f32_list(spec_names(_APPLICANT))} from a""")
def two_level_rollup(spark, sf):
    """Lines to orders to customers; lines are summed up before the join, so few rows are shuffled."""
    loans = aggregate(_lines(spark, sf), ["l_orderkey"], [(_LOAN, Subset())])
    owners = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return f32_all(aggregate(loans.join(owners, "l_orderkey"), ["o_custkey"], [(_APPLICANT, Subset())]), ["o_custkey"])


@query("last_period_agg", f"""
with l as (select *, floor(l_extendedprice) as price from lineitem),
a as (select l_orderkey, {select_list(spec_items(_LOAN) + spec_items(_LOAN, None, "l_shipdate > timestamp '2000-11-04'", '_LAST_YEAR'))}
      from l group by l_orderkey)
select l_orderkey, {f32_list(spec_names(_LOAN) + spec_names(_LOAN, '_LAST_YEAR'))} from a""")
def last_period_agg(spark, sf):
    """The whole history and the last year side by side; an order without recent lines gets NULL."""
    recent = "l_shipdate > timestamp_ntz '2000-11-04 00:00:00'"
    return f32_all(aggregate(_lines(spark, sf), ["l_orderkey"], [(_LOAN, Subset()), (_LOAN, Subset("_LAST_YEAR", recent))]),
                   ["l_orderkey"])


_STATUSES = ["F", "O", "P"]
_MAYBE = "case when o_orderkey % 13 = 0 then null else o_orderstatus end"


@query("onehot_share_mean", f"""
with o as (select *, {_MAYBE} as status from orders)
select o_custkey, {', '.join(sql_f32(f"avg(case when status = '{s}' then 1.0 else 0.0 end)", f'STATUS_{s}') for s in _STATUSES)}
from o group by o_custkey""")
def onehot_share_mean(spark, sf):
    orders = with_text(table(spark, sf, "orders"), {"status": _MAYBE})
    return f32_all(grouped(orders, ["o_custkey"], indicator_shares("status", _STATUSES, "STATUS")), ["o_custkey"])


_NAMED = [(n, ("mean", "sum", "max") if "MEAN" in n else ("mean",)) for n in spec_names(_LOAN)]


@query("rollup_by_name_rule", f"""
with l as ({_LINES}), loans as (select o_custkey, l_orderkey, {select_list(spec_items(_LOAN))} from l group by o_custkey, l_orderkey),
a as (select o_custkey, {select_list(spec_items(_NAMED))} from loans group by o_custkey)
select o_custkey, {f32_list(spec_names(_NAMED))} from a""")
def rollup_by_name_rule(spark, sf):
    """Columns with MEAN in their name are rolled up three ways, the others by their mean."""
    loans = aggregate(_lines(spark, sf), ["l_orderkey"], [(_LOAN, Subset())])
    threefold = set(having(loans.columns, "MEAN"))
    spec = [(c, ("mean", "sum", "max") if c in threefold else ("mean",)) for c in loans.columns if c != "l_orderkey"]
    owners = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return f32_all(aggregate(loans.join(owners, "l_orderkey"), ["o_custkey"], [(spec, Subset())]), ["o_custkey"])


_NUMERIC = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("group_mean_all_numeric", f"""
select o_custkey, {', '.join(sql_f32(f'avg({c})', c) for c in _NUMERIC)}
from orders left join lineitem on l_orderkey = o_orderkey group by o_custkey""")
def group_mean_all_numeric(spark, sf):
    """Detail joined left to its owners, then the mean of every numeric column."""
    owners = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    joined = left_join_detail(owners, lines, ["o_orderkey"])
    columns = numeric_columns(joined, without=["o_orderkey", "o_custkey"])
    return f32_all(group_means(joined, ["o_custkey"], columns), ["o_custkey"])


@query("label_join", """
select c_custkey, case when c_acctbal < 0 then 1 else 0 end as target, o_orderkey, o_totalprice
from customer left join (select * from orders where o_orderstatus = 'F') on c_custkey = o_custkey""")
def label_join(spark, sf):
    """Labels joined left to the detail; applicants without detail stay with missing detail."""
    labels = table(spark, sf, "customer").selectExpr("c_custkey", "if(c_acctbal < 0, 1, 0) as target")
    detail = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return left_join_detail(labels, detail, ["c_custkey"]).select("c_custkey", "target", "o_orderkey", "o_totalprice")


@query("first_last_skip_missing", f"""
select o_custkey, {sql_f32('arg_min(amount, place) filter (where amount is not null)', 'first_amount')},
       {sql_f32('arg_max(amount, place) filter (where amount is not null)', 'last_amount')} from ({_PLACED}) group by o_custkey""")
def first_last_skip_missing(spark, sf):
    placed = with_positions(_orders(spark, sf), ["o_custkey"], ["o_orderdate", "o_orderkey"], position="place", size="n")
    out = grouped(placed, ["o_custkey"], [f"{one('amount', fn, 'place')} as {fn}_amount" for fn in ("first", "last")])
    return out.select("o_custkey", f32("first_amount").alias("first_amount"), f32("last_amount").alias("last_amount"))
