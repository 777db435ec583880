"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols. Two words one edit apart are at most one edit apart in the reduced alphabet, and
there a word's full one-edit neighbourhood is small: every deletion, replacement and insertion, whatever the letters were.
Each word is sent to the keys of its reduced neighbourhood, the reduced vocabulary is joined on them, and every
pair that meets is verified on the original strings. Keys are polynomial hashes of reduced words, so the neighbours of a
word of any length cost a few array operations; a clash of keys only adds a pair to verify.

Words are counted with a dictionary for each slice of the texts before the shuffle, so a very frequent word is one row a slice.
"""

from __future__ import annotations

import re
from functools import cache, partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from creditloom.llm.common import bit_filter, in_filter, map_texts, stage

#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Of so many (document, run) pairs one loses a letter.
ERRORS = 199
#: A word has so many letters and occurrences at least; its form is so many times as frequent.
LETTERS, OCCURRENCES, TIMES = 6, 5, 5
#: Distinct words that a task holds before it passes their counts on.
HELD = 200_000

#: Runs of ``LETTERS`` letters at least: a shorter one cannot become a word.
_runs = re.compile("[a-z\u00C0-\u00FF]{%d,}" % LETTERS).findall
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2 ** 64)


def count_words(doc_id, text: str | None, held: dict[str, int]) -> None:
    """Add the words of a text to ``held``: runs of letters with A-Z lower-cased, some of them with a letter lost.

    The crc32 of id and run decides which runs lose a letter, and which one; a null id is written as nothing.
    """
    start, so_far = crc32(f"{'' if doc_id is None else doc_id}:".encode()), held.get
    for word in _runs((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):  # bytes: A-Z only
        h = crc32(word.encode(), start)
        if h % ERRORS == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < LETTERS:
                continue
        held[word] = so_far(word, 0) + 1


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of ``LETTERS`` letters and ``OCCURRENCES`` occurrences at least."""
    given = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("body"))

    def count(batches):
        held: dict[str, int] = {}

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                count_words(i, t.as_py(), held)
                if len(held) > HELD:
                    yield rows()
                    held.clear()
        yield rows()

    counted = given.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def symbols(word: str) -> np.ndarray:
    """The reduced word: each letter as a symbol from 1 to ``SYMBOLS``."""
    points = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    return (points * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(SYMBOLS) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@cache
def _powers(n: int) -> np.ndarray:
    power = np.full(n, _BASE, np.uint64)
    power[0] = 1
    return np.cumprod(power, dtype=np.uint64)


def reduced_key(word: str) -> int:
    """The key of the reduced word."""
    s = symbols(word)
    n = len(s)
    return int(_mixed((s * _powers(1 << n.bit_length())[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)).view(np.int64)[0])


def reduced_neighbours(word: str) -> np.ndarray:
    """The keys of the reduced word's full one-edit neighbourhood, itself included."""
    s = symbols(word)
    n = len(s)
    power = _powers(1 << n.bit_length())[:n + 1]
    head = np.zeros(n + 1, np.uint64)
    np.cumsum(s * power[:-1], out=head[1:])
    whole = head[n:]
    every = np.arange(1, SYMBOLS + 1, dtype=np.uint64)[:, None]
    fewer = head[:-1] + (whole - head[1:]) * np.uint64(_BACK) + np.uint64(n - 1)
    other = (whole - s * power[:-1]) + every * power[:-1] + np.uint64(n)
    more = head + every * power + (whole - head) * np.uint64(_BASE) + np.uint64(n + 1)
    return np.unique(_mixed(np.concatenate([fewer, other.ravel(), more.ravel()]))).view(np.int64)


def _own(words: list) -> list:
    return [pa.array([reduced_key(w) for w in words], pa.int64())]


def _ways(known: bytes, words: list) -> list:
    """Of each word's reduced neighbourhood the keys that the filter knows."""
    near = [keys[in_filter(known, keys)] for keys in map(reduced_neighbours, words)]
    offsets = np.cumsum([0, *map(len, near)]).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(near) if near else np.zeros(0, np.int64)))]


def near_pairs(words: DataFrame) -> DataFrame:
    """(id, near, near_n): every ordered pair of ``words`` (id, word, n) that differ in exactly one edit; ``near`` is a word."""
    reduced = stage(map_texts(words, ["id"], "word", _own, "key bigint", 1 << 18), "reduced")
    known = bit_filter(reduced.select("key"))
    ways = map_texts(words, ["id"], "word", partial(_ways, known), "keys array<bigint>", 1 << 16).select("id", F.explode("keys").alias("key"))
    met = ways.join(reduced.withColumnRenamed("id", "other"), "key").where("id <> other").select("id", "other")
    one, two = words.select("id", "word"), words.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return met.join(one, "id").join(two, "other").where(F.levenshtein("word", "near", 1) == 1).select("id", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of ``forms`` (word, form) along the forms to the last, by pointer doubling.

    A form is at least ``TIMES`` as frequent as its word, so a path has fewer than 30 steps: five doublings.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def variant_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    A word's form is its near word with the largest n (of equal ones the smallest in code-point order) if that is at least
    ``TIMES`` its own, else null; its root is the last of the forms followed from it, itself without any. Null and empty texts
    hold no words; a null id counts as an empty one; rows that repeat an id or a text count each. No words give no rows.
    Only ``doc_id`` and ``text`` are read.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: not to be coalesced
    words = stage(vocabulary(docs, doc_id, text).repartition(tasks).withColumn("id", F.monotonically_increasing_id()), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_pairs(words).groupBy("id").agg(F.count("*").alias("n_near"), best)
    known = words.join(near, "id", "left")
    good = F.coalesce(-F.col("best.less") >= TIMES * F.col("n"), F.lit(False))
    formed = stage(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(good, F.col("best.near")).alias("form"),
                                F.when(good, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(formed.where("form is not null").select("word", "form"))
    return (formed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
