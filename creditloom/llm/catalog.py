"""The registered corpus queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from creditloom.llm import checks, hard_negatives, langid, mixing, packing, pii, quality, rules, set_join, simhash, substrings, tokens, tree_search, variants
from creditloom.llm.common import remainder, stage_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the tables in a folder and, where SQL can say the same, its check."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_language_families")
def op1_language_families(spark, sf):
    """The language of every whole text; learned where the crc32 of the id modulo 3 is not 1."""
    docs = _documents(spark, sf)
    model = langid.train(docs.where(remainder("doc_id", 3) != 1))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return langid.identify(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op2_line_quality")
def op2_line_quality(spark, sf):
    """The quality of every whole text; learned where the crc32 of the id modulo 4 is not 2."""
    docs, labels = _documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels.where(remainder("doc_id", 4) != 2))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return quality.score_quality(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op3_cached_token_counts")
def op3_cached_token_counts(spark, sf):
    """Tokens of every whole text, from a cache that begins empty."""
    counts = tokens.cached_token_counts(_documents(spark, sf), stage_path(spark, "token-cache"), vocabulary("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op4_adaptive_rules", checks.ADAPTIVE_RULES)
def op4_adaptive_rules(spark, sf):
    """Measures of every whole text and whether it passes its group's limits."""
    return rules.judged(_documents(spark, sf))


@query("op5_kmeans_tree")
def op5_kmeans_tree(spark, sf):
    """The 20 nearest of all vectors for each whose id is divisible by 20."""
    return tree_search.search(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


@query("op6_personal_data")
def op6_personal_data(spark, sf):
    """Personal data in every whole text: fixed patterns and what the network adds."""
    docs = _documents(spark, sf)
    return pii.find_spans(docs, pii.train(docs), ["doc_id"])


@query("op7_temperature_mix", checks.TEMPERATURE_MIX)
def op7_temperature_mix(spark, sf):
    """All documents mixed by source, words as tokens."""
    return mixing.mix(_documents(spark, sf).select("doc_id", "source", mixing.word_count().alias("tokens")))


@query("op9_repeated_spans", checks.REPEATED_SPANS)
def op9_repeated_spans(spark, sf):
    """Words left of every whole text when windows of 20 words are kept where they start first."""
    kept = substrings.dedup_spans(_documents(spark, sf))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_packed_sequences")
def op10_packed_sequences(spark, sf):
    """Every document cut and packed into sequences of 2048 tokens."""
    return packing.packed_documents(_documents(spark, sf), vocabulary("word_bpe_49k.json"))


@query("op8_simhash_pigeonring")
def op8_simhash_pigeonring(spark, sf):
    """Near-duplicate groups of all documents by 64-bit fingerprints."""
    groups = simhash.near_groups(_documents(spark, sf))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op11_spelling_variants")
def op11_spelling_variants(spark, sf):
    """The form and root of every frequent word of all documents."""
    return variants.variant_groups(_documents(spark, sf))


@query("op12_hard_negatives", checks.HARD_NEGATIVES)
def op12_hard_negatives(spark, sf):
    """Hard negatives of every vector whose id is divisible by 100, among all vectors."""
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label)


@query("op13_jaccard_join")
def op13_jaccard_join(spark, sf):
    """Groups of documents whose four-word shingle sets share 85 percent of their union."""
    return set_join.similar_groups(_documents(spark, sf))
