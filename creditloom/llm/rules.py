"""Quality rules with adaptive thresholds, in DataFrame functions only.

Text measures become whole numbers (per thousand words or the like). Each (language, source) group's distribution of
a measure is a histogram whose bins keep the six leading binary digits, as a plain grouped count: such sketches
merge by adding, are the same in any order, and read a quantile with a relative error of 1/32 at most. A measure
fails beyond a fence above the median of its group, ``median + FENCE * (upper quartile - median) + slack`` (for word
lengths below the median too), so junk below a quarter of a group doesn't move its limits and a clean group
loses nothing but outliers. Groups under ``SMALLEST`` documents take the limits of their language, and
languages under it those of all documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from creditloom.llm.common import stage

#: Words of the repeat windows, and the symbols that count.
SPAN, SYMBOLS = 8, "#*$%&|<>"
#: Quartile distances from the median to the fence, and the smallest group with limits of its own.
FENCE, SMALLEST = 6, 50
#: What every group is allowed beyond its fence, by measure, in the measure's unit. Repeats: below the base rule's 300, so that
#: the fence decides first. Lines: wholly repeated lines of 7 words are 143 at most; lines from ``SPAN`` words on are repeats too.
SLACK = {"length": 200, "symbols": 100, "lines": 40, "repeats": 200}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def measures(docs: DataFrame, doc_id: str, text: str, keep: list[str]) -> DataFrame:
    """``keep`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every whole text; a null text is empty.

    The windows of a text are compared by two 64-bit hashes and never leave its row.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.select(*[F.col(c) for c in dict.fromkeys([doc_id, *keep])], body.alias("_body"), _words(body).alias("_words"))
    lines = F.filter(F.split("_body", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    hashed = split.select(
        *split.columns[:-2],
        F.size("_words").cast("bigint").alias("n_words"),
        (F.char_length("_body") - F.char_length(F.regexp_replace("_body", "[^\\x20\\x09-\\x0D]", ""))).cast("bigint").alias("word_chars"),
        (F.char_length("_body") - F.char_length(F.translate("_body", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    spans = F.when(F.col("n_words") >= SPAN, F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - SPAN),
        lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(SPAN)])))
    seen = hashed.select(
        *split.columns[:-2], "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"), "_hashes", spans.alias("_spans"))
    # only texts with an equal pair of windows are sorted
    ordered = F.when(F.size(F.array_distinct("_spans")) < F.size("_spans"), F.sort_array(F.transform(
        "_spans", lambda h, i: F.struct(h.alias("h"), F.hash(*[F.get(F.col("_hashes"), i + k) for k in range(SPAN)]).alias("g"), i.alias("i")))))
    sorted_ = seen.select(*[c for c in seen.columns if c not in ("_hashes", "_spans")], ordered.alias("_sorted"))
    same = lambda a, b: (a["h"] == b["h"]) & (a["g"] == b["g"])
    twice = F.sort_array(F.transform(F.filter("_sorted", lambda s, n: (
        F.coalesce(same(s, F.get(F.col("_sorted"), n + 1)), F.lit(False))
        | F.coalesce(same(s, F.get(F.col("_sorted"), n - 1)), F.lit(False)))), lambda s: s["i"]))
    found = sorted_.select(*sorted_.columns[:-1], twice.alias("_twice"))
    covered = F.aggregate(F.transform("_twice", lambda p, n: F.least(
        F.lit(SPAN), F.coalesce(F.get(F.col("_twice"), n + 1) - p, F.lit(SPAN)))), F.lit(0).cast("bigint"), lambda total, x: total + x)
    return found.select(*found.columns[:-1], F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


#: Measures by name, as SQL text over the columns of :func:`measures`: hundredths of a character, and per thousand.
MEASURES = {
    "length": "100 * word_chars div n_words",
    "symbols": "1000 * n_symbols div n_words",
    "lines": "1000 * n_dup_lines div n_words",
    "repeats": "1000 * n_repeat_words div n_words",
}
BASE_FAILED = "(n_words < 20 or 100 * n_repeat_words > 30 * n_words)"


def bin_of(value: str) -> str:
    """SQL text: the lower end of a value's bin, its six leading binary digits with zeros after them."""
    shift = f"greatest(length(bin({value})) - 6, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketch(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, low, n): mergeable quantile sketches of all measures for each group."""
    shapes = F.expr("explode(array(" + ", ".join(f"struct('{m}' as measure, {bin_of(f'({e})')} as low)" for m, e in MEASURES.items()) + "))")
    return (rows.where("n_words > 0").select(*by, shapes.alias("_s")).select(*by, "_s.measure", "_s.low")
            .groupBy(*by, "measure", "low").agg(F.count("*").alias("n")))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups: bins add up."""
    return sketches.groupBy(*by, "measure", "low").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, documents, and q1, q2, q3 of every measure): the lowest bins that reach each share.

    A group's bins are one row per group when they are put in order: their number is bounded by the bins of a 64-bit number.
    """
    bins = F.array_sort(F.collect_list(F.struct("low", "n")))
    read = sketches.groupBy(*by, "measure").agg(bins.alias("bins"), F.sum("n").alias("documents"))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), *[F.lit(None).cast("bigint").alias(q) for q in ("q1", "q2", "q3")])

    def step(state, b):
        n = state["n"] + b["n"]
        reach = [F.when(state[f"q{k}"].isNull() & (4 * n >= k * F.col("documents")), b["low"]).otherwise(state[f"q{k}"]) for k in (1, 2, 3)]
        return F.struct(n.alias("n"), *[r.alias(f"q{k + 1}") for k, r in enumerate(reach)])

    read = read.select(*by, "measure", "documents", F.aggregate("bins", start, step).alias("q"))
    wide = [F.max(F.when(F.col("measure") == m, F.struct("q.q1", "q.q2", "q.q3"))).alias(m) for m in MEASURES]
    return read.groupBy(*by).agg(F.max("documents").alias("documents"), *wide)


def limits(sketches: DataFrame, by: list[str], suffix: str) -> DataFrame:
    """(by, limits): upper limits of all measures and the lower one of word lengths, null for small groups."""
    read = quartiles(sketches, by)
    upper = [(F.col(f"{m}.q2") + FENCE * (F.col(f"{m}.q3") - F.col(f"{m}.q2")) + SLACK[m]).alias(m) for m in MEASURES]
    lower = (F.col("length.q2") - FENCE * (F.col("length.q2") - F.col("length.q1")) - SLACK["length"]).alias("shortest")
    enough = F.lit(True) if not by else F.col("documents") >= SMALLEST
    return read.select(*by, F.when(enough, F.struct(*upper, lower)).alias(f"_limits{suffix}"))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for every row.

    Null languages and sources are groups like any other. Texts are measured whole, however long. A text without a word fails the base rules.
    Repeated rows are judged and counted one by one; other columns aren't read; no documents give no rows.
    """
    group = [F.col(c).cast("string") for c in (lang, source)]
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), group[0].alias("lang"), group[1].alias("source"))
    rows = stage(measures(named, "doc_id", "text", ["lang", "source"]), "measures")
    both = stage(sketch(rows, ["lang", "source"]), "sketches")
    of_lang = merged(both, ["lang"])
    fine, coarse = limits(both, ["lang", "source"], "1"), limits(of_lang, ["lang"], "2")
    whole = limits(merged(of_lang, []), [], "3").first()  # one row, without a value if there is no word
    of_all = F.struct(*[F.lit(whole["_limits3"][m] if whole and whole["_limits3"] else None).cast("bigint").alias(m) for m in [*MEASURES, "shortest"]])
    same = lambda a, b, keys: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])
    per_group = (fine.alias("f").join(coarse.alias("c"), same("f", "c", ["lang"]), "left")
                 .select("f.lang", "f.source", F.coalesce("_limits1", "_limits2", of_all).alias("_limits")))
    failed = F.expr(BASE_FAILED)
    joined = rows.alias("r").join(per_group.alias("g"), same("r", "g", ["lang", "source"]), "left")
    within = [F.expr(f"({e}) <= _limits.{m}") for m, e in MEASURES.items()] + [F.expr(f"({MEASURES['length']}) >= _limits.shortest")]
    kept = F.when(failed, F.lit(False)).otherwise(F.coalesce(reduce(lambda a, b: a & b, within), F.lit(True)))
    return joined.select(F.col("r.doc_id").alias(doc_id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), kept.alias("kept"))
