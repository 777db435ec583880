"""Token ids of whole texts, and the counts of a digest cache.

A library encodes a chunk of text the same in any surroundings if no token can cross the chunk's ends.
For byte-level vocabularies whose pattern lets a token start with one blank that is so before each
single blank between two other characters; for vocabularies that drop white space it is so at each
blank and line feed. So texts are cut into chunks, each distinct chunk of some texts is looked up once in a bounded memory
of two generations, what is new there is looked up as a word and the marks after it, what is still new goes to the library, and
the texts are put together from chunks. Texts
with other runs of white space go to the library whole (byte level).
"""

from __future__ import annotations

import hashlib
import os
import string
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.utils import AnalysisException

from creditloom.llm.common import map_texts, stage

#: Chunks that a worker remembers in each of two generations, the longest one worth it, and bytes of text at once.
REMEMBERED, LONGEST, AT_ONCE = 300_000, 64, 4 << 20

#: Letters whose only other form is their upper case: words of them end at any of the marks.
_LOWER = string.ascii_lowercase + "".join(map(chr, range(0xDF, 0x100))).replace("\u00f7", "")
_LETTERS, _MARKS = _LOWER + _LOWER.replace("\u00df", "").replace("\u00ff", "").upper(), string.punctuation



class Chunks:
    """A tokenizer with its memory of chunks as bytes of their ids (4 each, little-endian).

    ``blanks``: a chunk stands for itself after one blank, and letter case matters; otherwise white space is
    dropped and ASCII letters are alike in either case.
    """

    def __init__(self, path: str, blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.library, self.blanks = Tokenizer.from_file(path), blanks
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.edge = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that begin a word (blanks), or end one
        for token, number in vocabulary.items():
            self.edge[number] = token.startswith("\u0120") if blanks else token.endswith("</w>")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails = {"": b"", ".": self.whole(["."])[0], ",": self.whole([","])[0]}
        self.direct = None  # the model without the steps before it, which leave plain words as they are
        if not blanks:
            direct = Tokenizer(self.library.model)
            direct.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            probe = " ".join([*_LOWER, *(a + b for a in _LOWER for b in _LOWER), _LOWER])
            if direct.encode(probe, add_special_tokens=False).ids == self.library.encode(probe, add_special_tokens=False).ids:
                self.direct = direct

    def whole(self, texts: list[str]) -> list[bytes]:
        made = []
        for start in range(0, len(texts), 1024):
            batch = self.library.encode_batch_fast(texts[start:start + 1024], add_special_tokens=False)
            made += [np.array(e.ids, dtype="<u4").tobytes() for e in batch]
        return made

    def _words(self, words: list[str], plain: bool = False) -> list[bytes]:
        """Ids of words of letters: many in one call, told apart by the ids at words' ends."""
        made, reader = [], self.direct if plain else self.library
        for start in range(0, len(words), 1000):
            part = words[start:start + 1000]
            line = " ".join(part)
            ids = np.array(reader.encode_batch_fast([" " + line if self.blanks else line], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.edge[ids]) + (not self.blanks)
            bounds = np.r_[cuts, len(ids)] if self.blanks else np.r_[0, cuts]
            if len(bounds) == len(part) + 1 and bounds[0] == 0 and bounds[-1] == len(ids):
                data = ids.tobytes()
                made += [data[4 * a:4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            else:  # some letter is none to the library
                made += self.whole([" " + w if self.blanks else w for w in part])
        return made

    def _key(self, chunk: str) -> tuple[str, str]:
        """What is remembered of a chunk, and the marks after a word of letters, which are tokens of their own."""
        if not self.blanks:
            word = chunk.rstrip(_MARKS)
            if word and not word.strip(_LETTERS):
                return word.lower(), chunk[len(word):]
            if not chunk.isascii():
                if not chunk[:-1].lower().isalpha():
                    return chunk, ""  # a letter whose lower case has a mark: it joins what comes after
            elif "|>" not in chunk:
                chunk = chunk.lower()  # special tokens are told by case, so their chunks stay
        if chunk.isalpha():
            return chunk, ""
        if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
            return chunk[:-1], chunk[-1]
        return chunk, ""

    def ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, by memory or library."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found, unknown = list(map(young.get, chunks)), []
        missing = [c for c, v in zip(chunks, found) if v is None]
        for c, v in zip(missing, map(old.get, missing)):
            if v is None:
                unknown.append(c)
            else:
                young[c] = v
        names, marks = [], []  # no pairs: what the collector follows is kept few
        for c in unknown:
            name, mark = self._key(c)
            names.append(name)
            marks.append(mark)
        wanted = set(names) if self.blanks else {*names, *marks}
        wanted -= young.keys()
        for k in wanted & old.keys():
            young[k] = old[k]
        fresh = wanted - young.keys()
        plain = {k for k in fresh if k and not k.strip(_LOWER)} if self.direct else set()
        words = [k for k in fresh - plain if k.isalpha()]
        others = [k for k in fresh - plain if not k.isalpha()]
        young.update(zip(plain, self._words(list(plain), True)))
        young.update(zip(words, self._words(words)))
        young.update(zip(others, self.whole([" " + k if self.blanks else k for k in others])))
        tails = self.tails if self.blanks else young
        for c, k, t in zip(unknown, names, marks):
            young[c] = young[k] + tails[t] if t else young[k]
        made = [young[c] if v is None else v for c, v in zip(chunks, found)]
        for c in [*unknown, *fresh]:
            if len(c) > LONGEST:
                young.pop(c, None)
        return made


@cache
def _chunks(path: str, blanks: bool) -> Chunks:
    return Chunks(path, blanks)


def _lowered(texts: pa.Array) -> pa.Array:
    """ASCII letters in lower case, but in texts where case may tell: special tokens, and letters that a mark may join in one case only."""
    tells = pc.or_(pc.match_substring(texts, "|>"), pc.match_substring_regex(texts, r"\pM"))
    return pc.if_else(tells, texts, pc.ascii_lower(texts))


def _split(texts: list[str], line_feeds: bool) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Where each text's chunks begin (and the end), the distinct chunks, and the number of each chunk among them."""
    array = pa.array(texts, pa.string())
    if line_feeds:
        array = _lowered(pc.replace_substring(array, "\n", " "))
    parts = pc.split_pattern(array, " ")
    coded = parts.flatten().dictionary_encode()
    return parts.offsets.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def count_tokens(path: str, texts: list[str | None]) -> list[int]:
    """Tokens of each text under a byte-level vocabulary that keeps one blank with the word after it."""
    if not texts:
        return []
    chunks, texts = _chunks(path, True), [t or "" for t in texts]
    bounds, distinct, number = _split(texts, False)
    plain = [bool(c) and not c[0].isspace() and not c[-1].isspace() for c in distinct]
    known = iter(chunks.ids([c for c, p in zip(distinct, plain) if p]))
    size = np.array([len(next(known)) // 4 if p else 0 for p in plain], dtype=np.int64)
    odd = np.add.reduceat((~np.array(plain))[number].astype(np.int64), bounds[:-1]) > 0
    total = np.add.reduceat(size[number], bounds[:-1])
    heads = [distinct[k] for k in number[bounds[:-1]].tolist()]  # no blank before these
    unlike = list(set(heads))
    bare = dict(zip(unlike, (len(v) // 4 for v in chunks.whole(unlike))))
    total += np.array([bare[h] for h in heads]) - size[number[bounds[:-1]]]
    result = total.tolist()
    for i in np.flatnonzero(odd).tolist():
        result[i] = len(chunks.whole([texts[i]])[0]) // 4
    return result


def token_ids(path: str, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row and where each text's begin (and the end), under a vocabulary that drops white space."""
    if not texts:
        return np.zeros(0, "<u4"), np.zeros(1, np.int64)
    bounds, distinct, number = _split([t or "" for t in texts], True)
    values = _chunks(path, False).ids(distinct)
    size = np.array([len(v) // 4 for v in values], dtype=np.int64)
    flat = np.frombuffer(b"".join(values), dtype="<u4")
    begin, length = (np.cumsum(size) - size)[number], size[number]
    ends = np.cumsum(length)
    at = np.repeat(begin - (ends - length), length) + np.arange(ends[-1])
    return flat[at], np.r_[0, ends][bounds]


def vocabulary_version(path: str) -> str:
    """Digest of the vocabulary file: counts of another file are never taken from the cache."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _read_cache(spark, folder: str, version: str) -> DataFrame:
    schema = "digest string, n_tokens bigint, version string"
    try:
        found = spark.read.schema(schema).parquet(folder)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], "digest string, n_tokens bigint")
    # two jobs may append the same digest at the same time
    return found.where(F.col("version") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def cached_token_counts(docs: DataFrame, cache_folder: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row; new counts are appended to ``cache_folder``.

    Content is normalised by taking null as empty and nothing else: any other rewriting would change
    the counts of a byte-level vocabulary. Its SHA-256 and the vocabulary's make the key. One row of
    each digest that the cache lacks is encoded; copies, null ids and repeated ids get their count by join.
    An empty table appends nothing and returns no rows. Other columns are not read.
    """
    spark, version = docs.sparkSession, vocabulary_version(vocabulary)
    content = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"))
    keyed = content.withColumns({"digest": F.sha2("content", 256), "row": F.xxhash64("doc_id", F.col("doc_id").isNull())})
    ids = stage(keyed.select("doc_id", "digest", "row", F.octet_length("content").cast("bigint").alias("n_bytes")), "digests")
    wanted = ids.groupBy("digest").agg(F.min("row").alias("row"))
    missing = wanted.join(_read_cache(spark, cache_folder, version), "digest", "left_anti")
    once = F.row_number().over(Window.partitionBy("digest", "row").orderBy("row"))  # rows that are equal
    to_encode = (keyed.select("digest", "row", "content").join(stage(missing, "missing"), ["digest", "row"], "left_semi")
                 .withColumn("n", once).where("n = 1").select("digest", "content"))

    def encode(texts: list) -> list:
        return [pa.array(count_tokens(vocabulary, texts), pa.int64())]

    fresh = map_texts(to_encode, ["digest"], "content", encode, "n_tokens bigint", AT_ONCE)
    fresh.withColumn("version", F.lit(version)).write.mode("append").parquet(cache_folder)
    counts = _read_cache(spark, cache_folder, version)
    return ids.join(counts, "digest").select(F.col("doc_id").alias(doc_id), "n_bytes", "n_tokens")
