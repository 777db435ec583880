"""Similarity join of shingle sets: size-aware, heavy and light.

Small sets are light: each enumerates its subsets of the sizes that a link needs (Deng, Tao and Li, "Overlap set similarity
joins with theoretical guarantees", SIGMOD 2018). Two sets of a and b shingles link if they share ceil(t / (1 + t) * (a + b)) of
them, so sets that meet in a subset of c shingles link exactly if a + b is small enough for c: whichever meet there, each is
linked to the smallest of them or to none, and one link a set suffices for the groups.

Large sets are heavy and scan inverted lists, those of their rarest shingles: as many as a linked set cannot miss all
of, and some more, so that it shares several. A set that meets others in fewer lists is left out before any pair is made.
Rarity is read from a sketch of fixed size, which only orders shingles. The boundary between light and heavy is where the
counted cost of enumerating sets up to a size and of scanning lists beyond it is least.

A list may hold a third of all sets, near copies mostly. Its sets are first compared with a few centres, in rounds; then only
pairs in different groups are left, and all of those are compared. No link between groups is lost. A pair is made only
where the list could be the first that both share, and where bitmaps of the two sets differ in no more bits than linked sets may.
Sets are of 64-bit hashes; links are decided on the whole sets, equal sets are one.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from creditloom.llm.common import bit_filter, in_filter, map_texts, slices, stage
from creditloom.llm.components import components
from creditloom.llm.wordhash import mixed, shingle_hashes, split_words, word_hashes

#: Words of a shingle, and percent of the union that linked sets share.
SHINGLE, PERCENT = 4, 85
#: Cells of the sketch of shingle counts (as a power of two), and cells of one of its rows.
SKETCH_BITS, SKETCH_ROW = 20, 4096
#: Lists that a set of many shingles shares at least with any set that it links to (a tenth of its shingles if that is less).
LEAD = 16
#: 64-bit words of a set's bitmap, and earlier shingles that an entry knows, to make a pair in one list only.
MAP_WORDS, BEFORE = 32, 32
#: Sets of more shingles are never light: their subsets run to millions.
LIGHT_MOST = 40
#: Rounds of centres, centres of a list in a round, and the share of lists that a round looks at.
ROUNDS, CENTRES, LIST_SHARE = 3, 8, 2


def shared_least(n, percent: int = PERCENT):
    """Shingles that a set of ``n`` shares at least with any set that it links to."""
    return -(-percent * n // 100)


def lead(n: int) -> int:
    """Of the rarest ``n - shared_least(n) + lead(n)`` shingles of a set, in one order for all sets, linked sets of ``n`` share so many.

    A pair of different sizes shares those of the smaller one.
    """
    return max(1, min(LEAD, n // 10))


def head(n: int, percent: int = PERCENT) -> int:
    """The rarest shingles whose lists a set of ``n`` is in."""
    return n - shared_least(n, percent) + lead(n)


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted hashes; none without words."""
    words, bounds = split_words(texts, lower=True)
    hashes, cuts = shingle_hashes(word_hashes(words), bounds, size)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        one = np.sort(hashes[a:b])
        if b - a > 1:
            one = one[np.r_[True, one[1:] != one[:-1]]]
        out.append(one)
    return out


def _count_cells(size: int, batches):
    """How often the shingles of a task's texts fall in each cell, as rows of cells."""
    cells = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        for part in slices(batch, 0, 1 << 22):
            words, bounds = split_words(part.column(0).to_pylist(), lower=True)
            hashes, _ = shingle_hashes(word_hashes(words), bounds, size)
            np.add.at(cells, (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
    rows = cells.reshape(-1, SKETCH_ROW)
    used = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(np.full(len(used), TaskContext.get().partitionId() % 64), pa.int64()),
                                      pa.array([rows[i].tobytes() for i in used], pa.binary())], names=["row", "salt", "cells"])


def _add_cells(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SKETCH_ROW, np.uint64)
    for cells in rows["cells"]:
        total += np.frombuffer(cells, np.uint32)
    total = np.minimum(total, 2 ** 32 - 1).astype(np.uint32)
    return pd.DataFrame({"row": rows["row"].iloc[:1], "salt": rows["salt"].iloc[:1], "cells": [total.tobytes()]})


def count_sketch(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """Counts of all shingles by cell: of a fixed size, merged in two steps."""
    fields = "row bigint, salt bigint, cells binary"
    rows = docs.select(F.col(text).cast("string")).mapInArrow(partial(_count_cells, size), fields)
    some = rows.groupBy("row", "salt").applyInPandas(_add_cells, fields)
    total = np.zeros((1 << SKETCH_BITS) // SKETCH_ROW * SKETCH_ROW, np.uint32).reshape(-1, SKETCH_ROW)
    for r in some.groupBy("row").applyInPandas(_add_cells, fields).collect():
        total[r.row] = np.frombuffer(bytes(r.cells), np.uint32)
    return total.ravel()


def rarest(one: np.ndarray, sketch: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` rarest shingles of a sorted set, of equally rare cells the smaller hash: the same order for every set."""
    return one[np.argsort(sketch[(one >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")[:n]]


def _lists(parts: list, kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.uint64).view(np.int64), kind))


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A bitmap of each set, (sets, ``MAP_WORDS``): two of them differ in at most as many bits as their sets in shingles."""
    bits = np.zeros((len(sets), 64 * MAP_WORDS), np.uint8)
    for row, one in zip(bits, sets):
        row[(mixed(one) % np.uint64(64 * MAP_WORDS)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1).view(np.int64)


def _describe(size: int, percent: int, sketch: np.ndarray, texts: list) -> list:
    sets = shingle_sets(texts, size)
    heads = [rarest(s, sketch, head(len(s), percent)) if len(s) else s for s in sets]
    small = [s if len(s) <= LIGHT_MOST else s[:0] for s in sets]
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            _lists(heads, pa.int64()), _lists(small, pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(bitmaps(sets).ravel()), MAP_WORDS).cast(pa.list_(pa.int64()))]


def _whole(size: int, known: bytes, batches):
    """The sets of the rows (rid, body) that the filter knows."""
    for batch in batches:
        chosen = batch.filter(pa.array(in_filter(known, batch.column(0).to_numpy())))
        for part in slices(chosen, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(shingle_sets(part.column(1).to_pylist(), size), pa.int64())], names=["rid", "set"])


def ways(n: int, percent: int = PERCENT) -> int:
    """Subsets that a light set of ``n`` enumerates."""
    return sum(comb(n, r) for r in range(n - shared_least(n, percent) + 1))


def subset_keys(one: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sizes) of a set's subsets of every size that a link may need."""
    spread = mixed(one ^ np.uint64(0x5851F42D4C957F2D))
    whole, keys, sizes = spread.sum(dtype=np.uint64), [], []
    for r in range(len(one) - shared_least(len(one), percent) + 1):
        gone = np.array(list(combinations(range(len(one)), r)), dtype=np.int64).reshape(comb(len(one), r), r)
        keys.append(mixed(whole - spread[gone].sum(axis=1, dtype=np.uint64) + np.uint64(len(one) - r)))
        sizes.append(np.full(len(gone), len(one) - r))
    return np.concatenate(keys), np.concatenate(sizes)


def _subsets(percent: int, batches):
    for batch in batches:
        for i in range(batch.num_rows):
            one = np.array(batch.column(2)[i].as_py(), np.int64).view(np.uint64)
            keys, sizes = subset_keys(one, percent)
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, batch.column(0)[i].as_py())), pa.array(np.full(n, batch.column(1)[i].as_py())),
                                              pa.array(keys.view(np.int64)), pa.array(sizes)], names=["id", "size", "key", "c"])


def boundary(classes: DataFrame, percent: int = PERCENT) -> int:
    """The size up to which sets are light: where enumerating up to it and scanning beyond costs least."""
    near = classes.where(F.col("size") <= LIGHT_MOST * 100 // percent + 1).select("size", F.explode("head").alias("key"))
    lists = near.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    scans = {r["size"]: r["n"] for r in near.join(lists, "key").groupBy("size").agg(F.sum("n").alias("n")).collect()}  # a row a size
    held = {r["size"]: r["n"] for r in classes.where(F.col("size") <= LIGHT_MOST).groupBy("size").agg(F.count("*").alias("n")).collect()}
    cost = {x: sum(n * ways(s, percent) for s, n in held.items() if s <= x) + sum(n for s, n in scans.items() if s > x) for x in range(LIGHT_MOST + 1)}
    return min(cost, key=lambda x: (cost[x], x))


def light_links(classes: DataFrame, most: int, percent: int = PERCENT) -> DataFrame:
    """(a, b): links among sets of at most ``most`` shingles, one at least from each linked set of every subset it shares."""
    light = classes.where(F.col("size") <= most)
    subsets = light.select("id", "size", "small").mapInArrow(partial(_subsets, percent), "id bigint, size bigint, key bigint, c bigint")
    rows = stage(subsets, "subsets")
    least = stage(rows.groupBy("key", "c").agg(F.min(F.struct("size", "id")).alias("low"), F.count("*").alias("n")).where("n > 1").select("key", "c", "low"), "meeting")
    met = rows.join(least, ["key", "c"]).where(f"id <> low.id and {100 + percent} * c >= {percent} * (size + low.size)")
    pairs = met.select(F.col("low.id").alias("a"), F.col("id").alias("b")).distinct()
    return linked(pairs, light.select("id", F.col("small").alias("set")), percent)


def linked(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The ``pairs`` (a, b) whose whole ``sets`` (id, set) share ``percent`` of their union."""
    both = pairs.join(sets.toDF("a", "_x"), "a").join(sets.toDF("b", "_y"), "b")
    common = F.size(F.array_intersect("_x", "_y"))
    return both.where(100 * common >= percent * (F.size("_x") + F.size("_y") - common)).select("a", "b")


def _apart(x: str, y: str, most: int, percent: int) -> str:
    """SQL: two entries of a list in different groups, one of them heavy, that may link and share no earlier list."""
    share = f"(({percent} * ({x}.size + {y}.size) + {99 + percent}) div {100 + percent})"
    return (f"{x}.root <> {y}.root and greatest({x}.size, {y}.size) > {most} and least({x}.size, {y}.size) >= {share}"
            f" and {x}.at <= {x}.size - {share} and {y}.at <= {y}.size - {share}")


def _alike(x: str, y: str, percent: int) -> str:
    """SQL: the bitmaps of two entries differ in no more bits than their sets may in shingles."""
    bits = " + ".join(f"bit_count({x}.m{i} ^ {y}.m{i})" for i in range(MAP_WORDS))
    return f"{bits} <= {x}.size + {y}.size - 2 * (({percent} * ({x}.size + {y}.size) + {99 + percent}) div {100 + percent})"


def heavy_links(classes: DataFrame, bodies: DataFrame, light: DataFrame, most: int, size: int, percent: int = PERCENT) -> DataFrame:
    """(a, b): with ``light``, links that join all sets which any links join. ``bodies``: (rid, body) of the documents."""
    entries = classes.where(F.col("size") >= shared_least(most + 1, percent)).select("id", "size", F.posexplode("head").alias("at", "key"))
    shared, least = entries, f"greatest(1, least({LEAD}, (({percent} * size + 99) div 100) div 10))"
    for _ in range(2):  # sets left out shorten lists, which leaves out more
        lists = stage(shared.groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("top")).where(f"n > 1 and top > {most}").select("key"), "lists")
        met = shared.join(lists, "key")
        if shared is entries:
            met = stage(met, "entries")
        often = stage(met.groupBy("id", "size").agg(F.count("*").alias("n")).where(f"n >= {least}").select("id"), "often")
        shared = stage(met.join(often, "id").select("id", "size", "at", "key"), "entries")
    own = stage(shared.select("id").distinct().join(classes.select("id", "rid"), "id"), "owners")
    read = bodies.mapInArrow(partial(_whole, size, bit_filter(own.select("rid"))), "rid bigint, set array<bigint>")
    sets = stage(read.join(own, "rid").dropDuplicates(["rid"]).select("id", "set"), "sets")
    found = light
    shared = shared.where(f"at <= size - (({percent} * size + 99) div 100)")  # further lists only served to leave sets out
    maps = classes.select("id", "head", *[F.col("map")[i].alias(f"m{i}") for i in range(MAP_WORDS)])

    def grouped(rows: DataFrame) -> DataFrame:
        roots = stage(components(found), "roots").withColumnRenamed("node", "id")
        return rows.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))

    for r in range(ROUNDS):
        rows = stage(grouped(shared.where(F.pmod(F.xxhash64("key"), F.lit(LIST_SHARE)) == r % LIST_SHARE)), "round")
        chance = Window.partitionBy("key").orderBy(F.xxhash64("id", F.lit(r)), "id")
        centres = rows.withColumn("n", F.row_number().over(chance)).where(F.col("n") <= CENTRES).drop("n")
        met = rows.alias("x").join(stage(centres, "centres").alias("y"), F.expr(f"x.key = y.key and {_apart('x', 'y', most, percent)}"))
        pairs = stage(met.selectExpr("least(x.id, y.id) as a", "greatest(x.id, y.id) as b").distinct(), "pairs")
        if not pairs.isEmpty():
            found = stage(found.union(linked(pairs, sets, percent)), "links")
    rows = stage(grouped(shared), "entries")
    mixed_lists = stage(rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key"), "lists")
    rows = rows.join(mixed_lists, "key").join(maps, "id")
    rows = stage(rows.withColumn("before", F.expr(f"slice(head, 1, least(at, {BEFORE}))")).drop("head"), "entries")
    may = (f"x.key = y.key and x.id < y.id and {_apart('x', 'y', most, percent)} and {_alike('x', 'y', percent)}"
           " and not arrays_overlap(x.before, y.before)")  # an earlier list makes the pair
    met = rows.alias("x").join(rows.alias("y"), F.expr(may))
    pairs = stage(met.selectExpr("x.id as a", "y.id as b").distinct(), "pairs")
    return found.union(linked(pairs, sets, percent))


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two documents link if their sets of ``size``-word shingles share at least ``percent`` of their union; component_id is the
    smallest doc_id that a document reaches. A text with fewer words has its whole sequence as its only shingle. Null, empty
    and wordless texts have an empty set, link with nothing and keep their own id. Rows with a null id take part in links and get the smallest
    id that is not null (null if there is none); rows that repeat an id or a text each keep their row. Only ``doc_id`` and
    ``text`` are read. No documents give no rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    given = docs.select(F.col(doc_id).alias("doc"), body.alias("body"))
    given = given.withColumn("rid", F.xxhash64("doc", "body"))
    sketch = count_sketch(given, "body", size)
    rows = stage(map_texts(given, ["doc", "rid"], "body", partial(_describe, size, percent, sketch), "size bigint, class binary, head array<bigint>, small array<bigint>, map array<bigint>"), "rows")
    held = rows.where("size > 0").groupBy("class").agg(F.min("doc").alias("least"), F.min("rid").alias("rid"), F.first("size").alias("size"),
                                                      F.first("head").alias("head"), F.first("small").alias("small"), F.first("map").alias("map"))
    classes = stage(held.withColumn("id", F.monotonically_increasing_id()), "classes")
    most = boundary(classes, percent)
    light = stage(light_links(classes, most, percent), "light")
    links = heavy_links(classes, given.select("rid", "body"), light, most, size, percent)
    roots = stage(components(links), "roots").withColumnRenamed("node", "id")
    rooted = stage(classes.select("id", "class", "least").join(roots, "id", "left").select("class", "least", F.coalesce("root", "id").alias("root")), "rooted")
    smallest = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    of_class = stage(rooted.join(smallest, "root").select("class", "component_id"), "groups")
    done = rows.select("doc", "size", "class").join(of_class, "class", "left")
    alone = F.when(F.col("class").isNull(), F.col("doc")).otherwise(F.col("component_id"))
    return done.select(F.col("doc").alias(doc_id), F.col("size").alias("n_shingles"), alone.alias("component_id"))
