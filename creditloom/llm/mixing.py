"""Mixing sources by temperature, in DataFrame functions only.

A source's weight is its token share to the power of an exponent between 0 (all sources alike) and 1 (as they
are), normalised. The exponent is bisected: the largest one whose weights reach the target entropy, and not
below the smallest one that keeps every source's repetition within the limit. The budget is the
smallest at which the least favoured source is taken once whole, so no document is lost: sources are
repeated, never cut, unless a budget is given.

The weights are realised as block permutations. A source's documents are dealt into blocks by a hash, blocks
are put in a hashed order, and so are the documents of a block, anew in each pass; a pass is taken up to the budget left
for the source. Running token counts first add up over blocks and then inside a block, so a source with
most of the documents is many groups. The place in its source's budget then gives each taken document its block of the
mixture: every block holds the sources in their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from creditloom.llm.common import plain_names, stage, with_row_key

#: Halvings of the exponent's interval, tokens of a block of the mixture, and documents of a source's block.
HALVINGS, MIX_TOKENS, BLOCK_DOCUMENTS = 24, 1_000_000, 1000


def _number(seed: str, *columns: str):
    """32 bits of a digest that every engine has."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *values).cast("binary")), 1, 8), 16, 10).cast("bigint")


def _weights(sources: DataFrame, exponent: float) -> DataFrame:
    """(source, tokens, documents, weight): the shares to the exponent, normalised."""
    raised = F.pow(F.col("share"), F.lit(float(exponent)))
    total = sources.agg(F.sum(raised)).first()[0]
    return sources.select("source", "tokens", "documents", (raised / F.lit(total)).alias("weight"))


def _facts(sources: DataFrame, exponent: float) -> tuple[float, float]:
    """Entropy of the weights, and how often the most favoured source is repeated where the least favoured is taken once."""
    raised = F.pow(F.col("share"), F.lit(float(exponent)))
    row = sources.agg(F.sum(raised).alias("z"), F.sum(raised * F.log(raised)).alias("e"),
                      F.max(raised / F.col("share")).alias("most"), F.min(raised / F.col("share")).alias("least")).first()
    return math.log(row.z) - row.e / row.z, row.most / row.least


def find_exponent(sources: DataFrame, entropy_share: float, most_repeats: float) -> float:
    """The largest exponent that reaches the target entropy, raised as far as the repetition limit asks.

    The target lies ``entropy_share`` of the way from the shares' own entropy to that of equal weights. Both the entropy
    and the repetition fall with the exponent, so each bound is bisected; every step is one small aggregate.
    """
    own, even = _facts(sources, 1.0)[0], _facts(sources, 0.0)[0]
    target = own + entropy_share * (even - own)
    low, high = 0.0, 1.0
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        entropy, repeats = _facts(sources, middle)
        if repeats > most_repeats or entropy > target:
            low = middle
        else:
            high = middle
    return high


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", tokens: str = "tokens", entropy_share: float = 0.5,
        most_repeats: float = 4.0, budget: int | None = None, seed: str = "mix") -> DataFrame:
    """(doc_id, source, pass, tokens, block, weight): one row each time a document is taken.

    Null sources are a source of their own; a document with no token counts as one token, so it can be taken. Rows that
    share an id are taken one by one. Without ``budget`` every row is taken at least once and at most
    ``most_repeats`` times, rounded up. No documents give no rows.
    """
    rows = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                             F.greatest(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)), F.lit(1)).alias("tokens")), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))
    every = rows.agg(F.sum("tokens")).first()[0]
    sources = stage(totals.select("source", "tokens", "documents", (F.col("tokens") / F.lit(every)).alias("share")), "mix-sources")
    exponent = find_exponent(sources, entropy_share, most_repeats) if every else 1.0
    weighted = _weights(sources, exponent)
    # the budget: given, or what takes the least favoured source once
    amount = F.lit(float(budget) if budget is not None else weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0])
    quota = F.greatest(F.round(amount * F.col("weight")).cast("bigint"), F.lit(1))
    quotas = weighted.select("source", F.col("tokens").alias("own"), "documents", F.round("weight", 9).alias("weight"), quota.alias("quota"),
                             F.greatest(F.lit(1), F.floor(amount / MIX_TOKENS)).cast("bigint").alias("mix_blocks"))
    planned = (quotas.withColumn("full", F.expr("quota div own"))
               .withColumn("blocks", F.greatest(F.lit(1), F.expr(f"documents div {BLOCK_DOCUMENTS}"))))
    same = F.col("r.source").eqNullSafe(F.col("q.source"))
    dealt = (rows.alias("r").join(planned.alias("q"), same)
             .select("doc_id", "r.source", "tokens", "own", "quota", "full", "mix_blocks", "weight",
                     F.pmod(_number(seed, "doc_id"), F.col("blocks")).alias("home")))
    passes = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("full") * F.col("own") < F.col("quota"), F.col("full"))
                                                    .otherwise(F.col("full") - 1))).alias("pass"))
    turn = _number(seed, "pass", "home")
    sizes = passes.groupBy("source", "pass", "home").agg(F.sum("tokens").alias("held"))
    blocks_before = Window.partitionBy("source", "pass").orderBy(turn, "home").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("source", "pass", "home", F.coalesce(F.sum("held").over(blocks_before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "pass", "home").orderBy(_number(seed, "pass", "doc_id"), "doc_id", "tokens")
    local = passes.withColumn("_inside", F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    on = F.col("l.source").eqNullSafe(F.col("s.source")) & (F.col("l.pass") == F.col("s.pass")) & (F.col("l.home") == F.col("s.home"))
    placed = local.alias("l").join(starts.alias("s"), on).withColumn("_at", F.col("l.pass") * F.col("own") + F.col("start") + F.col("_inside"))
    taken = placed.where(F.col("_at") < F.col("quota"))
    block = F.least(F.expr("(_at * mix_blocks) div quota"), F.col("mix_blocks") - 1)
    return taken.select(F.col("doc_id").alias(doc_id), F.col("l.source").alias(source), F.col("l.pass").cast("int").alias("pass"),
                        "tokens", block.alias("block"), "weight")


def word_count(text: str = "text"):
    """Tokens as words: runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mixture takes it, words as tokens; columns as they are.

    A null or wordless text counts as one token, a very long one as all of its words. Null sources are a source; repeated rows are
    taken one by one; no documents give no rows.
    """
    given, names = plain_names(docs)
    keyed = with_row_key(given, names[doc_id], names[text], names[source])
    counted = keyed.select(F.concat_ws(":", "_k1", "_k2").alias("_key"), F.col(names[source]).alias("source"), word_count(names[text]).alias("tokens"))
    takes = mix(counted, "_key", **options)
    totals = stage(takes.groupBy("_key").agg(F.count("*").alias("_taken"))
                   .select(F.split("_key", ":").alias("_key"), "_taken")
                   .select(F.col("_key")[0].cast("bigint").alias("_k1"), F.col("_key")[1].cast("int").alias("_k2"), "_taken"), "takes")
    equal = Window.partitionBy("_k1", "_k2")
    rows = (keyed.join(totals, ["_k1", "_k2"])
            .withColumns({"_n": F.row_number().over(equal.orderBy("_k1")), "_rows": F.count("*").over(equal)}))
    times = F.floor((F.col("_taken") - F.col("_n")) / F.col("_rows")).cast("int") + 1  # rows that are equal share their takes evenly
    return rows.where(times > 0).withColumn("_take", F.explode(F.sequence(F.lit(1), times))).select(*given.columns).toDF(*docs.columns)
