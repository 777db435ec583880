"""Order-dependent operators: smoothing, positions, ECDF, percentiles."""

from __future__ import annotations

from catalog.base import f32, forced_limit, query, sql_f32, table
from creditloom.functions.text import with_text
from creditloom.operators.ewm import ewm, ewm_last
from creditloom.operators.ordered import ecdf, percentiles, running_totals, with_positions
from creditloom.operators.profile import DEFAULT_PERCENTILES, box_summary, histogram, percentile_table
from pyspark.sql import functions as F

# a value is missing in every ninth event
_VALUE = "case when event_id % 9 = 4 then null else value end"
_EVENTS = f"select *, {_VALUE} as x, row_number() over (partition by user_id order by ts, event_id) as place from events"


def _events(spark, sf):
    return with_text(table(spark, sf, "events"), {"x": _VALUE})


_PAIRS = f"""with e as ({_EVENTS})
select a.user_id, a.event_id, a.place, sum(b.x * pow(0.2, a.place - b.place)) / sum(case when b.x is not null then pow(0.2, a.place - b.place) end) as y
from e a join e b on a.user_id = b.user_id and b.place <= a.place and b.place > a.place - 200 group by all"""


@query("ewm_rowwise", f"select user_id, event_id, {sql_f32('y', 'EXP_x')} from ({_PAIRS})")
def ewm_rowwise(spark, sf):
    """Smoothed value of every row of a history."""
    out = ewm(_events(spark, sf), ["user_id"], ["ts", "event_id"], ["x"], 0.8)
    return out.select("user_id", "event_id", f32("EXP_x").alias("EXP_x"))


@query("ewm_scan", f"select user_id, event_id, {sql_f32('y', 'EXP_x')}, cast(place as bigint) as place from ({_PAIRS})")
def ewm_scan(spark, sf):
    """The same by the streaming scan that long histories take, with the row's place."""
    out = ewm(_events(spark, sf), ["user_id"], ["ts", "event_id"], ["x"], 0.8, position="place", longest_window=0)
    return out.select("user_id", "event_id", f32("EXP_x").alias("EXP_x"), "place")


@query("ewm_split_groups", f"select user_id, event_id, {sql_f32('y', 'EXP_x')} from ({_PAIRS})")
def ewm_split_groups(spark, sf):
    """The same with every history cut into slices, as happens to oversized groups."""
    events = _events(spark, sf)
    out = ewm(events, ["user_id"], ["ts", "event_id"], ["x"], 0.8, limit=forced_limit(events), longest_window=0)
    return out.select("user_id", "event_id", f32("EXP_x").alias("EXP_x"))


@query("ewm_last", f"select user_id, {sql_f32('arg_max(y, place)', 'EXP_x')} from ({_PAIRS}) group by user_id")
def ewm_last_value(spark, sf):
    """Only the final smoothed value per history, as an aggregate."""
    out = ewm_last(_events(spark, sf), ["user_id"], ["ts", "event_id"], ["x"], 0.8)
    return out.select("user_id", f32("EXP_x").alias("EXP_x"))


@query("ewm_table_scan", f"""
with e as (select event_id, {_VALUE} as x, row_number() over (order by user_id, ts, event_id) as place from events)
select a.event_id, {sql_f32('sum(b.x * pow(0.5, a.place - b.place)) / sum(case when b.x is not null then pow(0.5, a.place - b.place) end)', 'EXP_x')}
from e a join e b on b.place between a.place - 79 and a.place group by a.event_id""")
def ewm_table_scan(spark, sf):
    """One mean running over the whole table in key order, computed slice by slice in parallel."""
    events = _events(spark, sf)
    out = ewm(events, [], ["user_id", "ts", "event_id"], ["x"], 0.5, limit=table_slice_rows(events))
    return out.select("event_id", f32("EXP_x").alias("EXP_x"))


def table_slice_rows(df) -> int:
    """Two slices per core, so that the whole table keeps every core busy."""
    return forced_limit(df, 2 * df.sparkSession.sparkContext.defaultParallelism)


@query("running_positions", f"""
select user_id, event_id, cast(place as bigint) as place, cast(count(*) over (partition by user_id) as bigint) as n from ({_EVENTS})""")
def running_positions(spark, sf):
    """Place in the group and group size, with oversized groups cut into slices."""
    events = table(spark, sf, "events")
    out = with_positions(events, ["user_id"], ["ts", "event_id"], position="place", size="n", limit=forced_limit(events))
    return out.select("user_id", "event_id", "place", "n")


@query("running_sums", """
select o_orderkey, cast(sum(cast(floor(o_totalprice) as bigint)) over (order by o_orderdate, o_orderkey) as bigint) as so_far from orders""")
def running_sums(spark, sf):
    """A running total over the whole table without sorting it in one task."""
    orders = with_text(table(spark, sf, "orders"), {"amount": "cast(floor(o_totalprice) as bigint)"})
    out = running_totals(orders, [], ["o_orderdate", "o_orderkey"], {"so_far": F.col("amount")}, limit=table_slice_rows(orders))
    return out.select("o_orderkey", "so_far")


_LABELLED = "select *, case when c_acctbal < 0 then 1 else 0 end as target from customer"


def _customers(spark, sf):
    return with_text(table(spark, sf, "customer"), {"target": "if(c_acctbal < 0, 1, 0)"})


@query("ecdf_by_class", f"""
select c_custkey, target, {sql_f32('(row_number() over (partition by target order by c_acctbal, c_custkey) - 1) / (count(*) over (partition by target) - 1)', 'cdf')}
from ({_LABELLED})""")
def ecdf_by_class(spark, sf):
    out = ecdf(_customers(spark, sf), "c_acctbal", ["c_custkey"], ["target"])
    return out.select("c_custkey", "target", f32("cdf").alias("cdf"))


@query("ecdf_overall", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, {sql_f32('''(row_number() over (order by l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1)
 / (count(*) over () - 1)''', 'cdf')} from lineitem""")
def ecdf_overall(spark, sf):
    lines = table(spark, sf, "lineitem")
    out = ecdf(lines, "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], limit=table_slice_rows(lines))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", f32("cdf").alias("cdf"))


@query("percentiles", " union all ".join(
    f"select cast({p} as double) as percentile, {sql_f32(f'quantile_cont(l_extendedprice, {p / 100})', 'value')} from lineitem"
    for p in DEFAULT_PERCENTILES))
def percentiles_default(spark, sf):
    out = percentile_table(table(spark, sf, "lineitem"), "l_extendedprice")
    return out.select(F.col("percentile").cast("double").alias("percentile"), f32("value").alias("value"))


@query("percentiles_by_class", f"""
select c_mktsegment, fraction, {sql_f32('value', 'value')} from (
select c_mktsegment, unnest([0.1, 0.5, 0.9])::double as fraction, unnest(quantile_cont(c_acctbal, [0.1, 0.5, 0.9])) as value
from customer group by c_mktsegment)""")
def percentiles_by_class(spark, sf):
    customers = table(spark, sf, "customer")
    out = percentiles(customers, "c_acctbal", [0.1, 0.5, 0.9], ["c_mktsegment"], limit=forced_limit(customers, 100))
    return out.select("c_mktsegment", "fraction", f32("value").alias("value"))


@query("box_summary_by_class", f"""
with c as ({_LABELLED}), q as (select target, quantile_cont(c_acctbal, 0.25) q1, quantile_cont(c_acctbal, 0.5) median,
 quantile_cont(c_acctbal, 0.75) q3 from c group by target)
select target, {sql_f32('q1', 'q1')}, {sql_f32('median', 'median')}, {sql_f32('q3', 'q3')},
 {sql_f32('min(c_acctbal) filter (where c_acctbal between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))', 'whisker_low')},
 {sql_f32('max(c_acctbal) filter (where c_acctbal between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))', 'whisker_high')},
 count(*) filter (where not c_acctbal between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as n_outliers, count(*) as n
from c join q using (target) group by target, q1, median, q3""")
def box_summary_by_class(spark, sf):
    out = box_summary(_customers(spark, sf), "c_acctbal", ["target"])
    return out.select("target", *[f32(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "n_outliers", "n")


@query("histogram_by_class", f"""
with c as ({_LABELLED}), r as (select min(c_acctbal) lo, (max(c_acctbal) - min(c_acctbal)) / 20 w from c),
b as (select target, cast(least(floor((c_acctbal - lo) / w), 19) as integer) as bin, lo, w from c, r),
g as (select target, bin, lo, w, count(*) as n from b group by all)
select target, bin, {sql_f32('lo + bin * w', 'bin_start')}, n, {sql_f32('n / (sum(n) over (partition by target) * w)', 'density')} from g""")
def histogram_by_class(spark, sf):
    out = histogram(_customers(spark, sf), "c_acctbal", ["target"])
    return out.select("target", "bin", f32("bin_start").alias("bin_start"), "n", f32("density").alias("density"))
