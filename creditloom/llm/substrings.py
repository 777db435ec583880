"""Substring dedup by seed and extend.

Seeds are winnowed anchors (Schleimer et al., SIGMOD 2003): of every ``span`` consecutive words the ``seed``-word gram
with the least hash. Equal spans choose the same anchor at the same place, so documents are joined on anchors that
occur twice or more, and spans elsewhere are never looked at again.

A seed is extended both ways over all spans that chose it: its reach, one run of words. Reaches with equal words and
anchor form a class, compared by 128-bit digests instead of pair by pair, so a passage of thousands of documents is
one class. Every reach but its class's first repeats an earlier one whole. A class's first reach may still repeat in
part: its single spans are compared with those of all other classes. Repeated spans and reaches of a document
join to maximal repeats, which are cut.

Words are hashed by XXH64 under two seeds. Hashes of grams, reaches and spans (at most 32 words, so no pattern of words is
long enough to cancel out) are differences of running sums of a polynomial in them, a few array operations for whole
texts. Equal documents are one: later copies go whole.
"""

from __future__ import annotations

from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from creditloom.llm.common import find_words, map_texts, slices, stage
from creditloom.llm.wordhash import mixed, split_words, word_hashes

SPAN, SEED = 20, 8
#: Bytes of text hashed at once.
PART_BYTES = 1 << 20
_NO_ID = (1 << 63) - 1


@cache
def _base(salt: int) -> tuple[int, int]:
    """An odd base for words, and its inverse modulo 2**64."""
    base = (0xD6E8FEB86659FD93 * (2 * salt + 5) | 5) & (2 ** 64 - 1)
    return base, pow(base, -1, 2 ** 64)


@cache
def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of a base; ``n`` is a power of two so that few tables are kept."""
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _pow(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(10, int(n).bit_length()))[:n]


class Words:
    """The words of some texts in one row: where each text's words begin, and hashes of any run of words."""

    def __init__(self, texts: list[str | None], salts: int = 1):
        words, self.bounds = split_words(texts)
        self.sums = []
        for salt in range(salts):
            total = np.zeros(len(words) + 1, dtype=np.uint64)
            np.cumsum(word_hashes(words, 42 + salt) * _pow(_base(salt)[0], len(words)), out=total[1:])
            self.sums.append(total)

    def hashes(self, start: np.ndarray, length, salt: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each ``start``."""
        total, back = self.sums[salt], _base(salt)[1]
        value = (total[start + length] - total[start]) * _pow(back, len(total) + 1)[start]
        return mixed(value + np.asarray(length, dtype=np.uint64))


def anchors(words: Words, span: int = SPAN, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, first span, spans) of every anchor: the spans that chose it are consecutive.

    A gram's hash decides; of equal ones the first. Texts shorter than a span have none.
    """
    count = np.diff(words.bounds)
    room = np.maximum(count - span + 1, 0)
    text = np.repeat(np.arange(len(count)), room)
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    first = np.r_[0, np.cumsum(room)[:-1]]
    starts = np.arange(len(text)) - first[text] + words.bounds[:-1][text]
    grams = words.hashes(np.arange(len(words.sums[0]) - seed), seed)
    width = span - seed + 1
    least, where = grams[starts], np.zeros(len(starts), dtype=np.int64)
    for i in range(1, width):
        other = grams[starts + i]
        smaller = other < least
        where[smaller] = i
        least = np.where(smaller, other, least)
    at = starts + where
    new = np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])]
    heads = np.flatnonzero(new)
    return text[heads], least[heads], starts[heads] - words.bounds[:-1][text[heads]], np.diff(np.r_[heads, len(at)])


def _lists(values: np.ndarray, text: np.ndarray, texts: int, kind: pa.DataType) -> pa.Array:
    offsets = np.r_[0, np.cumsum(np.bincount(text, minlength=texts))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _seeds(span: int, seed: int, texts: list) -> list:
    text, key, first, spans = anchors(Words(texts), span, seed)
    n = len(texts)
    return [_lists(key.view(np.int64), text, n, pa.int64()), _lists(first, text, n, pa.int32()), _lists(spans, text, n, pa.int32())]


def _reaches(span: int, batches):
    """Reaches of the repeated anchors of whole texts: class digests, place, and the digests of their spans.

    Of equal reaches in a slice only the first carries its spans.
    """
    names = ["k1", "k2", "id", "mark", "first", "spans", "s1", "s2"]
    for batch in batches:
        for part in slices(batch, 0, PART_BYTES):
            words = Words(part.column(0).to_pylist(), 2)
            lists = part.column(3)
            row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            first = lists.flatten().field("first").to_numpy(zero_copy_only=False).astype(np.int64)
            spans = lists.flatten().field("spans").to_numpy(zero_copy_only=False).astype(np.int64)
            ids = part.column(1).to_numpy(zero_copy_only=False)[row]
            marks = part.column(2).to_numpy(zero_copy_only=False)[row]
            start = words.bounds[:-1][row] + first
            k1, k2 = (words.hashes(start, spans + span - 1, s).view(np.int64) for s in (0, 1))
            order = np.lexsort((first, marks, ids, k2, k1))
            a, b = k1[order], k2[order]
            lead = np.zeros(len(order), dtype=bool)
            lead[order[np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(order)]]] = True
            kept = np.where(lead, spans, 0)
            each = np.repeat(start, kept) + np.arange(kept.sum()) - np.repeat(np.cumsum(kept) - kept, kept)
            offsets = pa.array(np.r_[0, np.cumsum(kept)].astype(np.int32))
            digests = [pa.ListArray.from_arrays(offsets, pa.array(words.hashes(each, span, s).view(np.int64))) for s in (0, 1)]
            columns = [pa.array(v) for v in (k1, k2, ids, marks)] + [pa.array(v, pa.int32()) for v in (first, spans)]
            yield pa.RecordBatch.from_arrays(columns + digests, names=names)


def cut(text: str, ranges: list[tuple[int, int]]) -> tuple[list[str], int]:
    """The words outside all ranges (first word, end), and how many lie inside."""
    words = find_words(text)
    inside = np.zeros(len(words) + 1, dtype=np.int64)
    for start, end in ranges:
        inside[start] += 1
        inside[end] -= 1
    gone = np.cumsum(inside)[:-1] > 0
    return [w for w, g in zip(words, gone.tolist()) if not g], int(gone.sum())


def _cut_batches(batches):
    for batch in batches:
        for part in slices(batch, 0, PART_BYTES):
            removed, texts = [], []
            for text, ranges in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words, n = cut(text, [(r["first"], r["last"]) for r in ranges or []])
                removed.append(n)
                texts.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_words", "copy", "n_removed", "kept"])


def _bodies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, body, id, mark) of every row: a null text is empty, a null id the largest; a hash tells texts of one id apart."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID)).alias("id"),
                       F.xxhash64(body).alias("mark"))


def repeated_ranges(docs: DataFrame, doc_id: str, text: str, span: int = SPAN, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(id, mark, n_words, copy) of all documents, staged, and the word ranges to cut of those that have any.

    ``copy``: an earlier document has the same words, ``span`` at least. Documents are ordered by id, then hash.
    """
    if not 0 < seed <= span:
        raise ValueError("a seed has at least one word and at most a span's")
    given = _bodies(docs, doc_id, text)
    words = F.filter(F.split("body", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    read = given.select("id", "mark", words.alias("words"))
    rows = stage(read.select("id", "mark", F.size("words").cast("bigint").alias("n_words"), F.sha2(F.array_join("words", " "), 256).alias("digest"))
                 .distinct(), "rows")  # rows that share id and text are one document
    # staged, so that a digest of many documents is dealt out where it is joined
    firsts = stage(rows.groupBy("digest").agg(F.min(F.struct("id", "mark")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    again = F.coalesce(F.struct("id", "mark") != F.col("first"), F.lit(False))
    known = stage(rows.join(firsts, "digest", "left").select("id", "mark", "n_words", (again & (F.col("n_words") >= span)).alias("copy")), "documents")
    seeded = map_texts(given, ["id", "mark"], "body", partial(_seeds, span, seed), "keys array<bigint>, first array<int>, spans array<int>", PART_BYTES)
    own = known.where(~F.col("copy") & (F.col("n_words") >= span)).select("id", "mark")
    found = stage(seeded.where(F.size("keys") > 0).join(own, ["id", "mark"], "left_semi"), "anchors")
    each = found.select("id", "mark", F.explode(F.arrays_zip("keys", "first", "spans")).alias("a")).select("id", "mark", "a.*")
    # staged, so that the join's two sides are plain shuffles, whose large partitions Spark deals out
    twice = stage(each.groupBy("keys").agg(F.count("*").alias("n")).where("n > 1").select("keys"), "keys")
    seeds = each.join(twice, "keys").groupBy("id", "mark").agg(F.collect_set(F.struct("first", "spans")).alias("seeds"))  # one document's
    met = given.join(stage(seeds, "seeds"), ["id", "mark"]).select("body", "id", "mark", "seeds")
    reach = stage(met.mapInArrow(partial(_reaches, span), "k1 bigint, k2 bigint, id bigint, mark bigint, first int, spans int,"
                                 " s1 array<bigint>, s2 array<bigint>"), "reaches")
    place = F.struct("id", "mark", "first")
    leads = stage(reach.groupBy("k1", "k2").agg(F.min(place).alias("lead")), "classes")
    classed = reach.drop("s1", "s2").join(leads, ["k1", "k2"])
    later = classed.where(place != F.col("lead")).select("id", "mark", "first", (F.col("first") + F.col("spans") + (span - 1)).alias("last"))
    led = reach.where(F.size("s1") > 0).join(leads, ["k1", "k2"]).where(place == F.col("lead"))
    single = stage(led.select("id", "mark", "first", F.posexplode(F.arrays_zip("s1", "s2")).alias("at", "s"))
                   .select("id", "mark", (F.col("first") + F.col("at")).alias("first"), "s.s1", "s.s2"), "spans")
    least = stage(single.groupBy("s1", "s2").agg(F.min(place).alias("lead"), F.count("*").alias("n")).where("n > 1").select("s1", "s2", "lead"), "leads")
    again = single.join(least, ["s1", "s2"]).where(place != F.col("lead")).select("id", "mark", "first", (F.col("first") + span).alias("last"))
    return known, later.union(again).groupBy("id", "mark").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))  # one document's


def dedup_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row; ``kept`` has the words left, joined by blanks.

    A word goes if a window of ``span`` words that covers it starts earlier as well: in a smaller doc_id, or in the same
    document before. A null text has no words. Null ids come last; of rows that share an id the one whose text has the
    smaller hash comes first, and rows that share id and text are one document. No documents give no rows.
    """
    known, ranges = repeated_ranges(docs, doc_id, text, span, seed)
    fate = known.join(stage(ranges, "ranges"), ["id", "mark"], "left")
    given = _bodies(docs, doc_id, text).join(fate, ["id", "mark"])
    body = F.when(F.col("copy"), F.lit("")).otherwise(F.col("body"))
    done = given.select(body.alias("body"), "ranges", "doc_id", "n_words", "copy").mapInArrow(
        _cut_batches, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words bigint, copy boolean, n_removed bigint, kept string")
    return done.select(F.col("doc_id").alias(doc_id), "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"), "kept")
