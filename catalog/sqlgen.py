"""SQL text of wide aggregates, written from the same specs but evaluated by another engine."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from creditloom.functions.naming import safe, spec_alias
from creditloom.operators.aggregate import Spec


def agg_item(column: str, fn: str, order: str | None, predicate: str | None) -> str:
    where = f" filter (where {predicate})" if predicate else ""
    if fn == "mean":
        return f'avg("{column}"){where}'
    if fn in ("min", "max", "count"):
        return f'{fn}("{column}"){where}'
    if fn == "sum":
        total = f'coalesce(sum("{column}"){where}, 0)'
        return f"case when count(*){where} > 0 then {total} end" if predicate else total
    known = f'"{column}" is not null' + (f" and {predicate}" if predicate else "")
    return f'{"arg_min" if fn == "first" else "arg_max"}("{column}", {order}) filter (where {known})'


def spec_items(spec: Spec, order: str | None = None, predicate: str | None = None,
               suffix: str = "") -> list[tuple[str, str]]:
    """``(name, expression)`` of each aggregate."""
    return [(spec_alias(c, fn, suffix), agg_item(c, fn, order, predicate)) for c, fns in spec for fn in fns]


def share_items(column: str, values: Sequence[str], prefix: str) -> list[tuple[str, str]]:
    return [(f"{prefix}_{safe(v)}", f"avg(case when \"{column}\" = '{v}' then 1.0 else 0.0 end)") for v in values]


def select_list(items: Iterable[tuple[str, str]]) -> str:
    return ",\n".join(f'{e} as "{n}"' for n, e in items)


def f32_list(names: Iterable[str]) -> str:
    return ",\n".join(f'cast(cast("{n}" as float) as double) as "{n}"' for n in names)


def ewm_items(columns: Sequence[str], alpha: float, window: str, place: str = "_place") -> list[tuple[str, str]]:
    """Closed form with weights q**-place; for the short groups of the check only."""
    q = repr(round(1 - alpha, 10))
    w = f"pow(1 / cast({q} as double), {place})"
    run = f"over ({window} rows between unbounded preceding and current row)"
    return [(f"EXP_{c}", f'sum("{c}" * {w}) {run} / sum(case when "{c}" is not null then {w} end) {run}')
            for c in columns]


def ratio(a: str, b: str, eps: str = "1e-5") -> str:
    return f"cast({a} as double) / nullif(cast({b} as double) + {eps}, 0)" if eps else \
        f"cast({a} as double) / nullif(cast({b} as double), 0)"


def with_steps(steps: Sequence[tuple[str, str]], final: str) -> str:
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in steps) + "\n" + final
