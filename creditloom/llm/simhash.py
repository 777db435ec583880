"""SimHash near-duplicates, candidates pruned by pigeonring chains.

A fingerprint of 64 bits is seen as a ring of four 16-bit segments. If two fingerprints differ in at
most 3 bits, some start on the ring has a viable chain: the differences of its first 1, 2, 3 and 4
segments stay within 3/4, 6/4, 9/4 and 12/4 (Qin and Xiao, "Pigeonring", VLDB 2018). So a pair agrees
in the first segment of the chain and differs in at most one bit of the second: one side of the join
carries the 32 bits of those two segments for each start, the other side also their 16 one-bit
variants of the second segment. The join itself checks the chain's third step and the full distance, and
takes a pair at its first viable start only.

Equal fingerprints are one row before any join, so groups of copies never meet as pairs.
"""

from __future__ import annotations

from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from creditloom.llm.common import find_words, map_texts, plain_names, stage, with_row_key
from creditloom.llm.components import components

SEGMENTS, WIDTH, DISTANCE = 4, 16, 3
#: For each byte value, its 8 bits as 8 byte-wide counters.
_SPREAD = sum(((np.arange(256, dtype=np.uint64) >> np.uint64(k)) & np.uint64(1)) << np.uint64(8 * k) for k in range(8))
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed 64-bit number; 0 without words."""
    words = find_words(text.translate(_LOWER)) if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [" ".join(words)]
    else:
        grams = map(" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), dtype="<u8", count=n)
    spread = _SPREAD[hashes.view(np.uint8).reshape(n, 8)]
    blocks = np.add.reduceat(spread, np.arange(0, n, 255), axis=0)  # 255 rows cannot overflow a byte
    ones = blocks.view(np.uint8).reshape(len(blocks), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int, texts: list) -> list:
    return [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for every row; whole texts. Null or wordless texts have fingerprint 0."""
    return map_texts(docs, [doc_id], text, partial(_fingerprints, shingle), "fp bigint")


def _bits(x: str, start: int, length: int) -> str:
    """Differing bits in ``length`` segments of the ring from ``start``."""
    parts = [f"bit_count(shiftrightunsigned({x}, {WIDTH * ((start + i) % SEGMENTS)}) & 65535L)" for i in range(length)]
    return "(" + " + ".join(parts) + ")"


def _first_start(x: str, distance: int) -> str:
    """SQL text: the first start whose chain is viable, NULL if none is."""
    cases = []
    for i in range(SEGMENTS):
        steps = [f"{_bits(x, i, n)} <= {distance * n // SEGMENTS}" for n in range(1, SEGMENTS + 1)]
        cases.append(f"when {' and '.join(steps)} then {i}")
    return f"case {' '.join(cases)} end"


def _key(fp: str, start: int) -> Column:
    """The start and the 32 bits of its first two segments."""
    first, second = WIDTH * start, WIDTH * ((start + 1) % SEGMENTS)
    return F.expr(f"shiftleft({start}L, 32) | shiftleft(shiftrightunsigned({fp}, {second}) & 65535L, 16)"
                  f" | (shiftrightunsigned({fp}, {first}) & 65535L)")


def links(distinct: DataFrame, fp: str = "fp", distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints that differ in at most ``distance`` (0 to 3) bits, each once.

    Both sides are shuffled, whatever Spark takes their sizes for: it does not count the 4 and 68 rows that a fingerprint becomes, and would
    broadcast them from the driver.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance must be 0 to {DISTANCE}: the chains have one bit to spare in the second segment")
    keys = F.array(*[_key(fp, i) for i in range(SEGMENTS)])
    plain = distinct.select(F.col(fp).alias("a"), F.explode(keys).alias("key"))
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << (WIDTH + j)).cast("bigint") for j in range(WIDTH)])
    near = (distinct.select(F.col(fp).alias("b"), F.explode(keys).alias("key"))
            .select("b", F.explode(F.transform(flips, lambda bit: F.col("key").bitwiseXOR(bit))).alias("key")))
    start = _first_start("(a ^ b)", distance)
    viable = F.expr(f"a < b and {start} = shiftrightunsigned(p.key, 32)")
    return plain.alias("p").join(near.alias("q").hint("merge"), (F.col("p.key") == F.col("q.key")) & viable).select("a", "b")


def _rooted(classes: DataFrame, distance: int) -> DataFrame:
    """(fp, least, root): the smallest fingerprint that each distinct one reaches."""
    roots = components(links(classes.select("fp"), "fp", distance))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``distance`` bits. Rows with a null
    doc_id take part in links and get the smallest id that is not null (null if there is none); rows that
    repeat a doc_id each keep their row. Only ``doc_id`` and ``text`` are read. No documents: no rows.
    """
    prints = stage(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = stage(prints.groupBy("fp").agg(F.min(doc_id).alias("least")), "classes")
    rooted = stage(_rooted(classes, distance), "roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(of_class, "fp").select(doc_id, "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate group: one of each, with the smallest doc_id.

    Of rows with equal ids the one with the smaller hash stays, of equal rows one; null ids come last. Null and wordless texts are one
    group; very long texts are read whole; no documents give no rows.
    """
    given, names = plain_names(docs)
    keyed = with_row_key(given, names[doc_id], names[text])
    prints = stage(map_texts(keyed.withColumnRenamed(names[doc_id], "id"), ["_k1", "_k2", "id"], names[text],
                             partial(_fingerprints, shingle), "fp bigint"), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("late"), "id", "_k1", "_k2")
    classes = stage(prints.groupBy("fp").agg(F.min(first).alias("least")), "classes")
    kept = _rooted(classes, distance).groupBy("root").agg(F.min("least").alias("least")).select("least._k1", "least._k2")
    once = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy("_k1"))
    left = keyed.join(stage(kept, "kept"), ["_k1", "_k2"], "left_semi").withColumn("_n", once).where("_n = 1")
    return left.select(*given.columns).toDF(*docs.columns)
