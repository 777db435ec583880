"""SQL checks of the corpus queries that SQL can express."""

from __future__ import annotations

from creditloom.llm.mixing import BLOCK_DOCUMENTS, HALVINGS, MIX_TOKENS
from creditloom.llm.rules import FENCE, MEASURES, SLACK, SMALLEST

#: Words of every document in order; a null text has none.
_WORDS = """w as (select doc_id, lang, source, coalesce(text, '') as body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words from documents),
u as (select doc_id, len(words) as n, unnest(words) as x, generate_subscripts(words, 1) as p from w)"""


def _windows(span: int) -> str:
    return (f"select doc_id, p, h from (select doc_id, n, p, string_agg(x, ' ') over (partition by doc_id order by p"
            f" rows between current row and {span - 1} following) as h from u) where p <= n - {span - 1}")


REPEATED_SPANS = f"""
with {_WORDS},
k as ({_windows(20)}),
r as (select doc_id, p, row_number() over (partition by h order by doc_id, p) as turn from k),
gone as (select distinct doc_id, unnest(range(p, p + 20)) as p from r where turn > 1),
lost as (select doc_id, count(*) as c from gone group by doc_id),
left_over as (select doc_id, string_agg(x, ' ' order by p) as t from u anti join gone using (doc_id, p) group by doc_id)
select w.doc_id, len(words)::bigint as n_words, coalesce(c, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join lost using (doc_id) left join left_over using (doc_id)"""

_DIV = {name: "(" + e.replace(" div ", " // ") + ")" for name, e in MEASURES.items()}


def _low(value: str) -> str:
    shift = f"greatest(length(bin({value})) - 6, 0)"
    return f"(({value} >> {shift}) << {shift})"


def _limits(by: str) -> str:
    """Limits of the groups ``by``, as columns named by measure and ``shortest``, null for small groups."""
    keys = f"{by}, " if by else ""
    wide = ", ".join(f"max(q{k}) filter (measure = '{m}') as {m}_q{k}" for m in MEASURES for k in (1, 2, 3))
    upper = ", ".join(f"{m}_q2 + {FENCE} * ({m}_q3 - {m}_q2) + {SLACK[m]} as {m}" for m in MEASURES)
    enough = f" where documents >= {SMALLEST}" if by else ""
    return f"""select {keys}{upper}, length_q2 - {FENCE} * (length_q2 - length_q1) - {SLACK['length']} as shortest from (
        select {keys}max(total) as documents, {wide} from (
            select {keys}measure, max(total) as total, {", ".join(f"min(low) filter (4 * running >= {k} * total) as q{k}" for k in (1, 2, 3))} from (
                select *, sum(n) over (partition by {keys}measure order by low) as running, sum(n) over (partition by {keys}measure) as total
                from (select {keys}measure, low, count(*) as n from shapes group by {keys}measure, low))
            group by {keys}measure) {f"group by {by}" if by else ""}){enough}"""


_CHOSEN = ", ".join(f"coalesce(f.{m}, c.{m}, a.{m}) as lim_{m}" for m in [*MEASURES, "shortest"])
ADAPTIVE_RULES = f"""
with {_WORDS},
k as ({_windows(8)}),
twice as (select doc_id, p from (select doc_id, p, count(*) over (partition by doc_id, h) as c from k) where c > 1),
covered as (select doc_id, count(distinct q) as c from (select doc_id, unnest(range(p, p + 8)) as q from twice) group by doc_id),
chars as (select doc_id, sum(length(x)) as c from u group by doc_id),
m as (select w.doc_id, lang, source, len(words)::bigint as n_words, coalesce(chars.c, 0)::bigint as word_chars,
        (length(body) - length(translate(body, '#*$%&|<>', '')))::bigint as n_symbols,
        (len(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
         - len(list_distinct(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))))::bigint as n_dup_lines,
        coalesce(covered.c, 0)::bigint as n_repeat_words
      from w left join chars using (doc_id) left join covered using (doc_id)),
shapes as (select lang, source, measure, {_low("v")} as low from ({" union all ".join(f"select lang, source, '{n}' as measure, {e} as v from m where n_words > 0" for n, e in _DIV.items())})),
fine as ({_limits("lang, source")}), coarse as ({_limits("lang")}), whole as ({_limits("")}),
j as (select m.*, {_CHOSEN} from m left join fine f on f.lang is not distinct from m.lang and f.source is not distinct from m.source
      left join coarse c on c.lang is not distinct from m.lang left join whole a on true),
v as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from j)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    case when base_failed then false else {" and ".join(f"{e} <= lim_{n}" for n, e in _DIV.items())} and {_DIV["length"]} >= lim_shortest end as kept
from v"""


def _number(*parts: str) -> str:
    return "('0x' || substr(md5('mix:' || " + " || ':' || ".join(f"{p}::varchar" for p in parts) + "), 1, 8))::bigint"


_RAISED = "pow(share, (low + high) / 2)"
_ENTROPY = "(select ln(sum({r})) - sum({r} * ln({r})) / sum({r}) from shares)"
TEMPERATURE_MIX = f"""
with recursive d as materialized (
    select doc_id, source, greatest(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')), 1)::bigint as tokens
    from documents),
totals as (select source, sum(tokens)::bigint as own, count(*) as documents from d group by source),
shares as materialized (select *, own / (select sum(own) from totals) as share from totals),
target as (select {_ENTROPY.format(r='share')} + 0.5 * ((select ln(count(*)) from shares) - {_ENTROPY.format(r='share')}) as t),
bisect(step, low, high) as (
    select 0, 0.0::double, 1.0::double
    union all
    select step + 1, case when up then (low + high) / 2 else low end, case when up then high else (low + high) / 2 end
    from (select *, (select max({_RAISED} / share) / min({_RAISED} / share) from shares) > 4.0
                 or {_ENTROPY.format(r=_RAISED)} > (select t from target) as up from bisect where step < {HALVINGS})),
weights as (select *, pow(share, e) / sum(pow(share, e)) over () as weight from shares, (select high as e from bisect where step = {HALVINGS})),
budget as (select max(own / weight) as b from weights),
plan as (select source, own, round(weight, 9) as weight, greatest(round(b * weight)::bigint, 1) as quota,
         greatest(1, floor(b / {MIX_TOKENS}))::bigint as mix_blocks, greatest(1, documents // {BLOCK_DOCUMENTS}) as blocks from weights, budget),
passes as (select doc_id, d.source, tokens, own, weight, quota, mix_blocks, {_number('doc_id')} % blocks as home,
           unnest(range(case when (quota // own) * own < quota then quota // own + 1 else quota // own end)) as pass
           from d join plan on d.source is not distinct from plan.source),
held as (select source, pass, home, sum(tokens) as held from passes group by source, pass, home),
starts as (select source, pass, home, coalesce(sum(held) over (partition by source, pass order by {_number('pass', 'home')}, home
           rows between unbounded preceding and 1 preceding), 0) as start from held),
placed as (select p.*, p.pass * own + start + sum(tokens) over (partition by p.source, p.pass, p.home order by {_number('p.pass', 'doc_id')}, doc_id, tokens
           rows between unbounded preceding and current row) - tokens as spot
           from passes p join starts s on p.source is not distinct from s.source and p.pass = s.pass and p.home = s.home)
select doc_id, source, pass::integer as pass, tokens, least((spot * mix_blocks) // quota, mix_blocks - 1)::bigint as block, weight
from placed where spot < quota"""

HARD_NEGATIVES = """
with r as materialized (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as materialized (
    select a.vec_id as anchor_id, a.label = r.label as same, r.vec_id, list_inner_product(a.q, r.q)::bigint as score
    from r as a, r where a.vec_id % 100 = 0 and a.vec_id <> r.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (select p.*, vec_id as negative_id, score as negative_score,
          row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::integer as rank
      from p join s using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""
