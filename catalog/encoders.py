"""Category encoders and response statistics."""

from __future__ import annotations

from catalog.base import f32, f32_all, query, sql_f32, table
from catalog.sqlgen import f32_list, select_list, spec_items
from creditloom.functions.text import with_text
from creditloom.operators.aggregate import parse_spec
from creditloom.operators.encode import (apply_codes, first_seen_codes, fixed_codes, interaction_names, interactions_apply,
                                         interactions_fit, response_apply, response_fit, response_out_of_fold)
from creditloom.operators.folds import stratified_folds
from creditloom.session import materialise
from pyspark.sql import functions as F

_EVENT_CODES = {"view": 0, "click": 1, "signup": 2, "purchase": 4}


@query("map_encode", f"select event_id, case event_type {' '.join(f'when {k!r} then {v}' for k, v in _EVENT_CODES.items())} end as code from events")
def map_encode(spark, sf):
    """Fixed codes; a value outside of the table becomes NULL."""
    events = fixed_codes(table(spark, sf, "events"), {"event_type": _EVENT_CODES})
    return events.select("event_id", F.col("event_type").alias("code"))


@query("first_seen_encode", """
with o as (select *, row_number() over (order by o_custkey, o_orderdate, o_orderkey) as place from orders),
s as (select o_orderstatus, row_number() over (order by min(place)) as c from o group by 1),
p as (select o_orderpriority, row_number() over (order by min(place)) as c from o group by 1)
select o_orderkey, cast(s.c as integer) as o_orderstatus, cast(p.c as integer) as o_orderpriority
from orders join s using (o_orderstatus) join p using (o_orderpriority)""")
def first_seen_encode(spark, sf):
    """Categories numbered in the order of their first appearance."""
    orders, columns = table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"]
    codes = first_seen_codes(orders, columns, ["o_custkey", "o_orderdate", "o_orderkey"])
    return apply_codes(orders, codes, columns).select("o_orderkey", *columns)


_DOCS = "select doc_id, lang, case when doc_id % 17 = 0 then null else source end as source, toxic from documents join labels using (doc_id)"


def _docs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.expr("case when doc_id % 17 = 0 then null else source end").alias("source"))
    return docs.join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")


_SHARE = "avg(case when toxic = {k} then 1.0 else 0.0 end)"


def _shares(column: str) -> str:
    return (f"(select {column}, {_SHARE.format(k=0)} as {column}_0, {_SHARE.format(k=1)} as {column}_1 from d"
            f" where {column} is not null group by {column})")


@query("response_encode", f"""
with d as ({_DOCS}) select doc_id, {f32_list(['lang_0', 'lang_1', 'source_0', 'source_1'])}
from d left join {_shares('lang')} using (lang) left join {_shares('source')} using (source)""")
def response_encode(spark, sf):
    """Class shares per category replace the category; a missing category has none."""
    docs = _docs(spark, sf)
    vocabulary = materialise(response_fit(docs, ["lang", "source"], "toxic"))
    return f32_all(response_apply(docs, vocabulary, ["lang", "source"]).drop("toxic"), ["doc_id"])


_FOLDED = "select *, cast(doc_id % 4 as integer) as fold from d"


_OUT_OF_FOLD = f"""
with d as ({_DOCS}), f as ({{folded}})
select a.doc_id, a.fold, {', '.join(sql_f32(f'avg(case when b.toxic = {k} then 1.0 else 0.0 end) filter (where b.doc_id is not null)', f'lang_{k}') for k in (0, 1))}
from f a left join f b on a.lang = b.lang and a.fold <> b.fold group by a.doc_id, a.fold"""


@query("response_encode_key_folds", _OUT_OF_FOLD.format(folded=_FOLDED))
def response_encode_key_folds(spark, sf):
    """The same with folds that SQL can name."""
    folded = with_text(_docs(spark, sf), {"fold": "cast(doc_id % 4 as int)"})
    return response_out_of_fold(folded, ["lang"], "fold", "toxic").select("doc_id", "fold", f32("lang_0").alias("lang_0"),
                                                                        f32("lang_1").alias("lang_1"))


_GROUPS = [["c_mktsegment", "region"], ["region", "rich", "c_mktsegment"]]
_STATS = parse_spec("c_acctbal: mean max min\nc_nationkey: mean")
_PEOPLE = ("select c_custkey, c_mktsegment, c_acctbal, c_nationkey, n_regionkey as region,"
           " case when c_acctbal > 5000 then 'yes' else 'no' end as rich from customer join nation on c_nationkey = n_nationkey")


@query("group_interactions", f"""
with p as ({_PEOPLE}), {', '.join(f"g{i} as (select {', '.join(g)}, {select_list(spec_items(_STATS, None, None, '_AGG_' + '_'.join(g)))} from p group by all)"
                                   for i, g in enumerate(_GROUPS))}
select c_custkey, {f32_list(interaction_names(_GROUPS, _STATS))} from p
{' '.join(f"left join g{i} using ({', '.join(g)})" for i, g in enumerate(_GROUPS))}""")
def group_interactions(spark, sf):
    """Statistics of category tuples joined back to every row."""
    nation = table(spark, sf, "nation").selectExpr("n_nationkey as c_nationkey", "n_regionkey as region")
    people = table(spark, sf, "customer").join(nation, "c_nationkey")
    people = with_text(people, {"rich": "if(c_acctbal > 5000, 'yes', 'no')"})
    out = interactions_apply(people, interactions_fit(people, _GROUPS, _STATS))
    return f32_all(out.select("c_custkey", *interaction_names(_GROUPS, _STATS)), ["c_custkey"])


_DEALT = """select *, cast((row_number() over (partition by toxic order by md5('5:' || cast(doc_id as varchar)), doc_id) - 1) % 4 as integer) as fold from d"""


@query("response_encode_oof", _OUT_OF_FOLD.format(folded=_DEALT))
def response_encode_oof(spark, sf):
    """A row's own fold is left out of its shares (folds dealt out by a hash)."""
    folded = stratified_folds(_docs(spark, sf), ["doc_id"], "toxic", 4, seed=5)
    return response_out_of_fold(folded, ["lang"], "fold", "toxic").select("doc_id", "fold", f32("lang_0").alias("lang_0"),
                                                                        f32("lang_1").alias("lang_1"))
