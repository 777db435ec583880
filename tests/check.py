"""Compare a query with its SQL check: row count, column names and types, and all values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
         " conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def compare(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences found; empty means equal."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    types = dict(zip(names, [str(d[1]) for d in want.description]))
    rows = want.fetchall()
    problems = []
    if sorted(names) != sorted(got.columns):
        return [f"columns differ: only here {sorted(set(got.columns) - set(names))[:5]},"
                f" only in the check {sorted(set(names) - set(got.columns))[:5]}"]
    for c, t in got.dtypes:
        if TYPES.get(t, t).upper() != types[c].upper():
            problems.append(f"type of {c}: {t} / {types[c]}")
    order = sorted(names)
    at = {c: i for i, c in enumerate(names)}
    mine = got.select(*[f"`{c}`" for c in order]).collect()
    if len(mine) != len(rows):
        problems.append(f"rows: {len(mine)} / {len(rows)}")
    a = Counter(tuple(_cell(v) for v in r) for r in mine)
    b = Counter(tuple(_cell(r[at[c]]) for c in order) for r in rows)
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    if only_a or only_b:
        problems.append(f"{len(only_a)} rows only here, {len(only_b)} only in the check")
        only_a.sort(key=str), only_b.sort(key=str)
        if only_a and only_b:
            keyed = {r[0:1]: r for r in only_b}
            columns = Counter()
            for x in only_a:
                y = min(only_b, key=lambda r: sum(p != q for p, q in zip(r, x))) if len(only_b) < 50 else only_b[0]
                for c, p, q in zip(order, x, y):
                    if p != q:
                        columns[c] += 1
                if sum(columns.values()) > 3000:
                    break
            problems.append(f"most different columns: {columns.most_common(6)}")
            problems.append(f"example: {[(c, p, q) for c, p, q in zip(order, only_a[0], only_b[0]) if p != q][:6]}")
            del keyed
    return problems
