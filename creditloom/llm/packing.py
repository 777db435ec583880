"""Best-fit packing after a Martello-Toth dominance reduction.

Packing sees only how many pieces each length has, at most ``capacity`` numbers however many documents
there are. The plan is made of groups of equally filled sequences; a table with one row per length
and group then gives every piece its place by its rank among the pieces of its length, in one join.
"""

from __future__ import annotations

import bisect
import zlib
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from creditloom.llm.common import map_texts, stage
from creditloom.llm.tokens import AT_ONCE, token_ids

#: A plan group: how many sequences, and what each holds as (length, times).
Group = tuple[int, list[tuple[int, int]]]


def _merge(sizes: list[int]) -> list[tuple[int, int]]:
    return [(s, sizes.count(s)) for s in sorted(set(sizes), reverse=True)]


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Martello and Toth's reduction: sequences fixed for good, and the counts left over.

    For a piece, a set of up to two further pieces is fixed with it if it dominates every other set that
    fits: each such set can be dealt into the fixed pieces so that no piece is overfull. Some best
    packing then holds the fixed sequence.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    sizes, fixed = sorted(left), []

    def use(sizes_used: list[int], times: int) -> None:
        fixed.append((times, _merge(sizes_used)))
        for s in sizes_used:
            left[s] -= times
            if not left[s]:
                del left[s]
                sizes.remove(s)

    def others(item: int) -> list[int]:
        return sizes if left[item] > 1 else [s for s in sizes if s != item]

    def most(sizes_used: list[int]) -> int:
        return min(left[s] // sizes_used.count(s) for s in sizes_used)

    for item in sorted(left, reverse=True):
        while item in left:
            room, rest = capacity - item, others(item)
            spare = lambda s: left[s] - (s == item)  # noqa: E731  pieces of a length without this one
            if not rest or rest[0] > room:
                use([item], left[item])
                continue
            best = rest[bisect.bisect_right(rest, room) - 1]
            smallest: list[int] = []
            for s in rest[:3]:
                smallest += [s] * min(spare(s), 3 - len(smallest))
            if best == room or len(smallest) < 2 or sum(smallest[:2]) > room:
                use([item, best], most([item, best]))
                continue
            if len(smallest) == 3 and sum(smallest) <= room:
                break  # three more pieces fit: no small set is known to dominate
            pair_sum, low_most = 0, 0
            for at, y in enumerate(rest):  # y: the smaller of two
                x_least = y if spare(y) > 1 else (rest[at + 1] if at + 1 < len(rest) else None)
                if x_least is None or y + x_least > room:
                    continue
                low_most = y
                pair_sum = max(pair_sum, y + rest[bisect.bisect_right(rest, room - y) - 1])
            if pair_sum <= best:
                use([item, best], most([item, best]))
                continue
            second = [s for s in rest if s <= room - best and spare(s) > (s == best)]
            if second and second[-1] >= low_most:
                use([item, best, second[-1]], most([item, best, second[-1]]))
                continue
            break
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best-fit decreasing over counts: groups of sequences that hold the same lengths."""
    groups: list[Group] = []
    open_rooms: list[tuple[int, int]] = []  # (room left, index of the group), sorted
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(open_rooms, (size, -1))
            if at == len(open_rooms):
                bins, held, room = -(-left // (capacity // size)), [], capacity
            else:
                room, index = open_rooms.pop(at)
                bins, held = groups[index]
            times = min(left, room // size)
            full = min(bins, left // times)
            if held:
                groups[index] = (bins - full, held)
                if bins > full:
                    bisect.insort(open_rooms, (room, index))
            groups.append((full, held + [(size, times)]))
            bisect.insort(open_rooms, (room - size * times, len(groups) - 1))
            left -= full * times
    return [g for g in groups if g[0]]


def plan(counts: dict[int, int], capacity: int) -> list[Group]:
    """Groups of sequences for the pieces counted by length: the fixed ones, then best fit for the rest."""
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, times, first sequence, offset) of each length in each group.

    At most 63 rows a group (so many different lengths fit in 2048), and at most two groups for a length
    besides the fixed ones: the table's size is bounded by the capacity, not by the documents.
    """
    rows, ranks, base = [], {}, 0
    for bins, held in groups:
        offset = 0
        for size, times in held:
            start = ranks.get(size, 0)
            ranks[size] = start + bins * times
            rows.append((size, start, start + bins * times - 1, times, base, offset))
            offset += size * times
        base += bins
    return rows


def pack(pieces: DataFrame, length: str, order: list[str], capacity: int) -> DataFrame:
    """``pieces`` (staged, lengths 1 to ``capacity``) with ``sequence_id`` and ``offset``; no other column changes.

    Ranks within a length are dealt over up to 4096 hash buckets, so one very common length is many groups.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().collect()}  # one row a length, capacity at most
    slots = spark.createDataFrame(places(plan(counts, capacity)) or [(0,) * 6],
                                  "size int, low bigint, high bigint, times bigint, first bigint, at bigint")
    buckets = max(1, min(4096, sum(counts.values()) // 2000))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sums = Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (dealt.groupBy(length, "_bucket").agg(F.count("*").alias("_n"))
              .select(length, "_bucket", F.coalesce(F.sum("_n").over(sums), F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy(length, "_bucket").orderBy(*order))
    ranked = (dealt.withColumn("_inside", inside).join(before, [length, "_bucket"])
              .withColumn("_rank", F.col("_before") + F.col("_inside") - 1))
    found = ranked.join(F.broadcast(slots), (F.col(length) == F.col("size")) & F.col("_rank").between(F.col("low"), F.col("high")))
    step = F.col("_rank") - F.col("low")
    return found.select(*pieces.columns, (F.col("first") + F.floor(step / F.col("times"))).cast("bigint").alias("sequence_id"),
                        (F.col("at") + F.pmod(step, F.col("times")) * F.col("size")).cast("bigint").alias("offset"))


def _cut(vocabulary: str, capacity: int, end_id: int, texts: list) -> list:
    """For each text its number of ids with the end id, and the CRC-32 of each piece's ids."""
    totals, sums = [], []
    ids, bounds = token_ids(vocabulary, texts)
    data, end = ids.tobytes(), end_id.to_bytes(4, "little")
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = data[4 * a:4 * b] + end
        totals.append(b - a + 1)
        sums.append([zlib.crc32(own[i:i + 4 * capacity]) for i in range(0, len(own), 4 * capacity)])
    return [pa.array(totals, pa.int64()), pa.array(sums, pa.list_(pa.int64()))]


def packed_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every row of ``docs`` cut and placed.

    A null text is empty: its only id is the end id. Rows with null or repeated doc_ids are packed like any
    other, each with pieces of its own. Only documents over ``capacity`` ids are cut, however long they are. No documents: no rows.
    """
    cut = map_texts(docs, [doc_id], text, partial(_cut, vocabulary, capacity, end_id), "_total bigint, _sums array<bigint>", AT_ONCE)
    pieces = stage(cut.select(F.col(doc_id).alias("doc_id"), "_total", F.posexplode("_sums").alias("piece", "ids_crc32"))
                   .select("doc_id", "piece", (F.col("piece").cast("bigint") * capacity).alias("start"),
                           F.least(F.lit(capacity), F.col("_total") - F.col("piece").cast("bigint") * capacity).cast("bigint").alias("length"),
                           "ids_crc32"), "pieces")
    placed = pack(pieces, "length", ["doc_id", "piece", "ids_crc32"], capacity)
    return placed.withColumnRenamed("doc_id", doc_id)
