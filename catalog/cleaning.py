"""Cleaning, derived columns, schema operators, sources and sinks."""

from __future__ import annotations

import os
import tempfile

from catalog.base import f32, f32_all, query, sql_f32, table
from creditloom.functions.nulls import differs, fill_text, keep_between, nan_to_null, null_where
from creditloom.functions.text import ratio, row_mean, row_missing, row_product, row_sum, row_variance, with_text
from creditloom.operators.clean import constant_columns, narrow, narrow_types
from creditloom.sources.sinks import Paths, read_names, read_stage, write_names, write_predictions, write_stage
from creditloom.sources.tables import read_csv
from pyspark.sql import functions as F, types as T


@query("null_sentinel", f"""
select p_partkey, case when p_size in (1, 50) then null else p_size end as size,
 {sql_f32('case when p_retailprice > 1500 then null else p_retailprice end', 'price')},
 case when p_size > 10 and p_size < 40 then p_size end as limited from part
where case when p_size in (1, 50) then null else p_size end is not null""")
def null_sentinel(spark, sf):
    """Sentinels and ranges to NULL, limits, and rows with a missing size dropped."""
    part = table(spark, sf, "part")
    out = part.select("p_partkey", F.expr("if(p_size in (1, 50), NULL, p_size)").alias("size"),
                      f32(null_where("p_retailprice", F.col("p_retailprice") > 1500)).alias("price"),
                      keep_between("p_size", 10, 40).alias("limited"))
    return out.dropna(subset=["size"])


_GAPS = {"status": "case when o_orderkey % 5 = 0 then null else o_orderstatus end",
         "priority": "case when o_orderkey % 3 = 0 then null else o_orderpriority end",
         "price": "case when o_orderkey % 4 = 0 then null else o_totalprice end"}
_GAPS_SQL = ", ".join(f"{e} as {n}" for n, e in _GAPS.items())


def _gaps(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", *[f"{e} as {n}" for n, e in _GAPS.items()])


@query("fill_and_row_null_count", f"""
with o as (select o_orderkey, {_GAPS_SQL} from orders)
select o_orderkey, coalesce(status, 'XNA') as status, coalesce(priority, 'XNA') as priority, coalesce(price, 0) as price,
 cast((status is null)::int + (priority is null)::int + (price is null)::int as integer) as n_missing from o""")
def fill_and_row_null_count(spark, sf):
    rows = _gaps(spark, sf)
    return fill_text(with_text(rows, {"n_missing": row_missing(rows.columns)})).fillna(0, subset=["price"])


@query("row_filter_nullsafe", f"""
with o as (select o_orderkey, {_GAPS_SQL} from orders) select o_orderkey, status from o where status is distinct from 'F'""")
def row_filter_nullsafe(spark, sf):
    """Drop one category and keep the rows whose category is missing."""
    return _gaps(spark, sf).where(differs("status", "F")).select("o_orderkey", "status")


@query("missing_split", f"""
with o as (select o_orderkey, {_GAPS_SQL} from orders)
select price is null as missing, count(*) as n, {sql_f32('avg(o_orderkey)', 'mean_key')} from o group by 1""")
def missing_split(spark, sf):
    """Rows with and without a value, told apart in one pass."""
    out = _gaps(spark, sf).groupBy(F.col("price").isNull().alias("missing")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_orderkey").alias("mean_key"))
    return out.select("missing", "n", f32("mean_key").alias("mean_key"))


_CONSTANTS = {"always": "7", "never": "cast(null as int)", "mostly": "case when event_id % 2 = 0 then 1 end",
              "same_text": "'x'"}


@query("drop_constant_columns", """
select 'always' as "column" union all select 'never' union all select 'same_text'""")
def drop_constant_columns(spark, sf):
    """Names of the constant columns; a column that is 1 or missing is not constant."""
    events = with_text(table(spark, sf, "events"), _CONSTANTS)
    return spark.createDataFrame([(c,) for c in constant_columns(events)], "column string")


@query("schema_narrowing", """
with r as (select * from (values %s) t("column", lo, hi, whole)) select "column", case when whole then
 case when lo > -128 and hi < 127 then 'tinyint' when lo > -32768 and hi < 32767 then 'smallint'
  when lo > -2147483648 and hi < 2147483647 then 'int' else 'bigint' end else 'float' end as type
from (%s)""" % ("('', 0, 0, true)", " union all ".join(
    f"select '{c}' as \"column\", cast(min({c}) as double) as lo, cast(max({c}) as double) as hi, {w} as whole from lineitem"
    for c, w in [("l_orderkey", "true"), ("l_partkey", "true"), ("l_suppkey", "true"), ("l_linenumber", "true"),
                 ("l_quantity", "false"), ("l_extendedprice", "false"), ("l_discount", "false"), ("l_tax", "false")])))
def schema_narrowing(spark, sf):
    types = narrow_types(table(spark, sf, "lineitem"))
    return spark.createDataFrame(sorted(types.items()), "column string, type string")


@query("narrowed_values", "select l_orderkey, l_linenumber, l_partkey, l_suppkey,"
       " cast(cast(l_extendedprice as float) as double) as l_extendedprice from lineitem")
def narrowed_values(spark, sf):
    """The table after narrowing holds the same values, floats to 4 bytes."""
    n = narrow(table(spark, sf, "lineitem"))
    return n.select(F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int"), F.col("l_partkey").cast("bigint"),
                    F.col("l_suppkey").cast("bigint"), F.col("l_extendedprice").cast("double"))


_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_RATIOS = {
    "price_per_unit": ("l_extendedprice", "l_quantity", 1e-5), "unprotected": ("l_extendedprice", "l_discount", 0),
    "tax_to_discount": ("l_tax", "l_discount", 0), "protected": ("l_tax", "l_discount", 1e-5)}


@query("derived_ratios", f"""
select {', '.join(_LINE_KEY)}, {', '.join(sql_f32(f'{a} / nullif({b} + {e!r}, 0)' if e else f'{a} / nullif({b}, 0)', n)
                                          for n, (a, b, e) in _RATIOS.items())},
 {sql_f32('l_extendedprice - l_quantity', 'diff')}, {sql_f32('abs(l_partkey - l_suppkey)', 'distance')} from lineitem""")
def derived_ratios(spark, sf):
    """Ratios with and without protection; a zero denominator gives NULL, never an error."""
    lines = with_text(table(spark, sf, "lineitem"), {n: ratio(a, b, e) for n, (a, b, e) in _RATIOS.items()}
                      | {"diff": "l_extendedprice - l_quantity", "distance": "abs(l_partkey - l_suppkey)"})
    return f32_all(lines.select(*_LINE_KEY, *_RATIOS, "diff", "distance"), _LINE_KEY)


_THREE = ["l_quantity", "l_discount", "l_tax"]
_MEAN = "((l_quantity + l_discount + l_tax) / 3)"


@query("rowwise_stats", f"""
select {', '.join(_LINE_KEY)}, {sql_f32(_MEAN, 'mean3')}, {sql_f32('l_quantity * l_discount * l_tax', 'product3')},
 {sql_f32('greatest(l_quantity, l_discount, l_tax)', 'max3')}, {sql_f32('least(l_quantity, l_discount, l_tax)', 'min3')},
 {sql_f32('(' + ' + '.join(f'({c} - {_MEAN}) * ({c} - {_MEAN})' for c in _THREE) + ') / 3', 'var3')},
 {sql_f32('l_quantity * 2 + l_discount * 3 + l_tax * 4', 'weighted')} from lineitem""")
def rowwise_stats(spark, sf):
    lines = with_text(table(spark, sf, "lineitem"), {
        "mean3": row_mean(_THREE), "product3": row_product(_THREE), "max3": f"greatest({', '.join(_THREE)})",
        "min3": f"least({', '.join(_THREE)})", "var3": row_variance(_THREE),
        "weighted": "l_quantity * 2 + l_discount * 3 + l_tax * 4"})
    return f32_all(lines.select(*_LINE_KEY, "mean3", "product3", "max3", "min3", "var3", "weighted"), _LINE_KEY)


_FLAGS = {"returned": "if(l_returnflag = 'R', 1, 0)", "open": "if(l_linestatus = 'O', 1, 0)", "large": "if(l_quantity > 25, 1, 0)",
          "taxed": "if(l_partkey % 10 = 0, NULL, if(l_tax > 0, 1, 0))"}


@query("flag_sums", f"""
select {', '.join(_LINE_KEY)}, cast({' + '.join('(' + e.replace('if(', 'if(') + ')' for e in _FLAGS.values())} as integer) as flags,
 cast(l_linenumber + l_quantity as double) as total from lineitem""")
def flag_sums(spark, sf):
    """A sum over a row is missing as soon as one part is missing."""
    lines = with_text(table(spark, sf, "lineitem"), _FLAGS)
    lines = with_text(lines, {"flags": row_sum(_FLAGS), "total": "l_linenumber + l_quantity"})
    return lines.select(*_LINE_KEY, "flags", "total")


@query("table_preview", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 5")
def table_preview(spark, sf):
    """The first five rows of a sorted table."""
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


def _scratch(spark) -> str:
    """A folder for files of a check: in the shared checkpoint folder, else (local only) a temporary one."""
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can read")
        return tempfile.mkdtemp(prefix="creditloom-")
    return os.path.join(shared, f"check-{spark.sparkContext.applicationId}-{os.urandom(4).hex()}")


@query("sinks_roundtrip", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def sinks_roundtrip(spark, sf):
    """Written as CSV, read with a declared schema, written and read as a Parquet stage."""
    paths = Paths(_scratch(spark))
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    orders = table(spark, sf, "orders").select(*columns)
    orders.write.option("header", True).csv(paths.at("csv"))
    back = read_csv(spark, paths.at("csv"), T.StructType([orders.schema[c] for c in columns]))
    write_stage(back, paths.stage("orders"))
    write_names(spark, columns, paths.vocabulary("columns"))
    return read_stage(spark, paths.stage("orders")).select(*read_names(spark, paths.vocabulary("columns")))


@query("prediction_sink", 'select c_custkey as "SK_ID_CURR", c_acctbal as "TARGET" from customer')
def prediction_sink(spark, sf):
    paths = Paths(_scratch(spark))
    write_predictions(table(spark, sf, "customer"), paths.result("scores"), "c_custkey", "c_acctbal")
    return read_csv(spark, paths.result("scores"), T.StructType([
        T.StructField("SK_ID_CURR", T.LongType()), T.StructField("TARGET", T.DoubleType())]))


@query("nan_as_missing", f"select count(*) as n, count(case when l_discount = 0 then null else 1 end) as n_known,"
       f" {sql_f32('avg(case when l_discount = 0 then null else l_tax / l_discount end)', 'mean')} from lineitem")
def nan_as_missing(spark, sf):
    """NaN written by other tools counts as missing after reading."""
    lines = with_text(table(spark, sf, "lineitem"), {"x": "if(l_discount = 0, double('NaN'), l_tax / nullif(l_discount, 0))"})
    return nan_to_null(lines.select("x")).agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("n_known"),
                                              f32(F.avg("x")).alias("mean"))
