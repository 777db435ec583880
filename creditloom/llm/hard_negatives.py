"""Hard-negative mining over STR-packed R-trees.

Rows are packed by sort-tile-recursive cuts on label and the two coordinates that vary most into blocks, and within a block
the same way into leaves. A minimum bounding box gives an interval for the inner product with an anchor, coordinate
by coordinate. An anchor is sent to the blocks whose label range and interval it can use; there a queue opens boxes
best first and prunes those outside the score window or strictly below the k-th score found.

Positives come first: the anchor's own block gives a k-th score that prunes the others. Negatives are searched by the windows
that the positives' scores set, all windows of an anchor together.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from creditloom.llm.common import stage

#: Rows of a block and of a leaf, boxes of an inner node, anchors that meet a block at once, boxes that meet anchors at once.
BLOCK, LEAF, FANOUT, ANCHORS, BOXES = 4096, 64, 8, 1024, 8192
SCALE = 256
_FOUND = "anchor_id bigint, positive_id bigint, vec_id bigint, score bigint"
_WINDOWS = "array<struct<positive_id: bigint, low: bigint, high: bigint>>"


def usable(vectors: DataFrame, vec_id: str, label: Column, embedding: str) -> DataFrame:
    """(vec_id, label, q) of the rows that take part, one for each id; ``q``: the components times ``SCALE``, rounded down."""
    x = F.col(embedding).cast("array<double>")
    given = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), x.alias("x")).where(
        "vec_id is not null and label is not null and size(x) > 0 and forall(x, v -> v is not null and abs(v) < double('infinity'))")
    common = given.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), "w").first()
    width = int(common.w) if common else 0
    most = int((2 ** 56 / max(1, width)) ** 0.5)  # so that a hundred times a score fits 64 bits
    scaled = given.where(F.size("x") == width).select("vec_id", "label", F.transform("x", lambda v: F.floor(v * SCALE).cast("double")).alias("q"))
    scaled = stage(scaled.where(F.forall("q", lambda v: F.abs(v) <= most)), "vectors")
    repeated = stage(scaled.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"), "repeated")
    once = scaled.join(repeated, "vec_id").groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")
    return scaled.join(repeated, "vec_id", "left_anti").union(once)


def _cut(rows: DataFrame, by: list[str], value: Column, slabs: int, name: str) -> DataFrame:
    """``rows`` with the slab that ``value`` falls into: cuts at its quantiles within ``by``, which only balance the work."""
    if slabs < 2:
        return rows.withColumn(name, F.lit(0))
    shares = F.array(*[F.lit(i / slabs) for i in range(1, slabs)])
    cuts = rows.groupBy(*by).agg(F.percentile_approx(value, shares).alias("_cuts"))
    joined = rows.join(cuts, by) if by else rows.withColumn("_cuts", F.lit(cuts.first()._cuts).cast("array<double>"))
    return joined.withColumn(name, F.size(F.filter("_cuts", lambda c: c < value))).drop("_cuts")


def blocks_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` with a ``block`` of about that many rows: tiles by label and the two widest coordinates, larger ones dealt by id."""
    n = rows.count()
    spread = rows.select(F.posexplode("q").alias("at", "v")).groupBy("at").agg(F.var_pop("v").alias("s")).orderBy(F.desc("s"), "at").limit(2).collect()
    tiles = -(-n // block)
    slabs = max(1, round(tiles ** (1 / (1 + len(spread))) + 0.4999))
    tiled = _cut(rows, [], F.col("label").cast("double"), slabs, "s0")
    for i, r in enumerate(spread):
        tiled = _cut(tiled, [f"s{k}" for k in range(i + 1)], F.col("q")[r["at"]], slabs, f"s{i + 1}")
    keys = [f"s{k}" for k in range(1 + len(spread))]
    tiled = stage(tiled, "tiles")
    parts = tiled.groupBy(*keys).agg(F.ceil(F.count("*") / block).alias("_parts"))
    number = F.xxhash64(*keys, F.pmod(F.xxhash64("vec_id"), F.col("_parts")))
    return tiled.join(parts, keys).select("vec_id", "label", "q", number.alias("block"))


def str_order(x: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Rows in sort-tile-recursive order: by label, then slabs of the coordinates that vary most."""
    def tile(rows: np.ndarray, axes: list) -> np.ndarray:
        if len(rows) <= leaf or not axes:
            return rows
        rows = rows[np.argsort(axes[0][rows], kind="stable")]
        slabs = max(1, int(np.ceil((len(rows) / leaf) ** (1 / len(axes)))))
        size = -(-len(rows) // slabs)
        size = -(-size // leaf) * leaf  # whole leaves
        return np.concatenate([tile(rows[i:i + size], axes[1:]) for i in range(0, len(rows), size)])

    widest = np.argsort(-x.var(axis=0), kind="stable")[:4]
    out = [tile(np.flatnonzero(labels == v), [x[:, k] for k in widest]) for v in np.unique(labels)]
    return np.concatenate(out)


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """The leaves of one block: ids, labels and vectors of each, in packing order."""
    x, labels, ids = np.stack(rows["q"].to_numpy()), rows["label"].to_numpy(), rows["vec_id"].to_numpy()
    order = str_order(x, labels)
    cuts = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
    return pd.DataFrame({"block": rows["block"].iloc[0], "leaf": range(len(cuts)), "ids": [ids[c] for c in cuts], "labels": [labels[c] for c in cuts],
                         "x": [x[c].ravel() for c in cuts], "low": [x[c].min(axis=0) for c in cuts], "high": [x[c].max(axis=0) for c in cuts],
                         "first": [labels[c].min() for c in cuts], "last": [labels[c].max() for c in cuts]})


def _exact(*parts: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles where all their inner products are whole numbers below 2**53, else as Python integers."""
    most = [max(1.0, float(np.abs(p).max(initial=0))) for p in parts]
    if most[0] * max(most[1:]) * parts[0].shape[1] < 2 ** 52:
        return list(parts)
    whole = np.frompyfunc(int, 1, 1)
    return [whole(p) for p in parts]


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of every anchor with the points of every box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _usable_boxes(label: int, same: bool, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Boxes that hold a row of the label, or one of another label."""
    return (first <= label) & (label <= last) if same else (first != label) | (last != label)


class Packed:
    """The leaves of a block and the levels of boxes above them."""

    def __init__(self, leaves: pd.DataFrame):
        leaves = leaves.sort_values("leaf")
        self.ids, self.labels = leaves["ids"].tolist(), leaves["labels"].tolist()
        low, high = np.stack(leaves["low"].to_numpy()), np.stack(leaves["high"].to_numpy())
        self.rows = [v.reshape(len(i), low.shape[1]) for v, i in zip(leaves["x"], self.ids)]
        self.levels = [(low, high, leaves["first"].to_numpy(), leaves["last"].to_numpy())]
        while len(self.levels[-1][0]) > 1:
            low, high, first, last = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))


def search_block(tree: Packed, anchors: np.ndarray, ids: list[int], labels: list[int], windows: list, same: bool, k: int) -> list[tuple]:
    """(anchor, positive_id, vec_id, score): for each anchor and window the ``k`` best rows of the block.

    ``windows``: (positive_id, low, high) each, None where open. Ties go to the smaller vec_id.
    """
    out = []
    whole = _exact(anchors, *[b for low, high, _, _ in tree.levels[:1] for b in (low, high)])
    plain = whole[0] is anchors
    anchors = whole[0]
    bounds = []
    for low, high, first, last in tree.levels:
        if not plain:
            low, high = np.frompyfunc(int, 1, 1)(low), np.frompyfunc(int, 1, 1)(high)
        bounds.append((*intervals(anchors, low, high), first, last))
    rows = tree.rows if plain else [np.frompyfunc(int, 1, 1)(r) for r in tree.rows]
    top = len(bounds) - 1
    for n, (anchor, label) in enumerate(zip(ids, labels)):
        fits = [_usable_boxes(label, same, first, last) for _, _, first, last in bounds]
        least, most = [b[0][n] for b in bounds], [b[1][n] for b in bounds]
        scored: dict[int, list] = {}
        for positive, low, high in windows[n]:
            found: list[tuple] = []  # a heap with the worst of the best on top: (score, -id)
            queue: list[tuple] = []

            def push(level: int, box: int) -> None:
                upper = most[level][box]
                if not fits[level][box] or (low is not None and upper < low) or (high is not None and least[level][box] > high):
                    return
                heapq.heappush(queue, (-(upper if high is None else min(upper, high)), level, box))

            push(top, 0)
            while queue:
                bound, level, box = heapq.heappop(queue)
                if len(found) == k and -bound < found[0][0]:
                    break  # every box left is strictly below the k-th
                if level:
                    for child in range(box * FANOUT, min((box + 1) * FANOUT, len(most[level - 1]))):
                        push(level - 1, child)
                    continue
                if box not in scored:
                    good = (tree.labels[box] == label) == same
                    good &= tree.ids[box] != anchor
                    scored[box] = sorted(((int(s), -int(i)) for s, i in zip((rows[box] @ anchors[n])[good], tree.ids[box][good])), reverse=True)
                for one in scored[box]:
                    if high is not None and one[0] > high:
                        continue
                    if (low is not None and one[0] < low) or (len(found) == k and one <= found[0]):
                        break
                    heapq.heappushpop(found, one) if len(found) == k else heapq.heappush(found, one)
            out += [(anchor, positive, -i, s) for s, i in found]
    return out


def _meet(same: bool, k: int, asked: pd.DataFrame, leaves: pd.DataFrame) -> pd.DataFrame:
    names = ["anchor_id", "positive_id", "vec_id", "score"]
    if asked.empty or leaves.empty:
        return pd.DataFrame({n: pd.Series(dtype="Int64") for n in names})
    windows = [[(None if pd.isna(w["positive_id"]) else int(w["positive_id"]), *(None if w[c] is None else int(w[c]) for c in ("low", "high"))) for w in ws]
               for ws in asked["windows"]]
    found = search_block(Packed(leaves), np.stack(asked["q"].to_numpy()), asked["anchor_id"].tolist(), asked["label"].tolist(), windows, same, k)
    return pd.DataFrame(found, columns=names).astype({n: "Int64" for n in names})


def _searched(routed: DataFrame, packed: DataFrame, same: bool, k: int) -> DataFrame:
    """What the anchors sent to each block find there; a block that many are sent to meets them in parts."""
    parts = routed.groupBy("block").agg(F.ceil(F.count("*") / ANCHORS).alias("_parts"))
    zero = F.lit(0).cast("bigint")
    asked = routed.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.col("_parts"))).drop("_parts")
    held = packed.join(parts, "block").withColumn("part", F.explode(F.sequence(zero, F.col("_parts") - 1))).drop("_parts")
    return asked.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInPandas(partial(_meet, same, k), _FOUND)


def _routes(same: bool, asked: pd.DataFrame, boxes: pd.DataFrame) -> pd.DataFrame:
    """(anchor_id, block) wherever the block's label range and score interval leave a window of the anchor open."""
    if asked.empty or boxes.empty:
        return pd.DataFrame({"anchor_id": pd.Series(dtype="int64"), "block": pd.Series(dtype="int64")})
    anchors, low, high = _exact(np.stack(asked["q"].to_numpy()), np.stack(boxes["low"].to_numpy()), np.stack(boxes["high"].to_numpy()))
    least, most = intervals(anchors, low, high)
    first, last, block = (boxes[c].to_numpy() for c in ("first", "last", "block"))
    made = []
    for n, (anchor, label, windows) in enumerate(zip(asked["anchor_id"], asked["label"], asked["windows"])):
        use = np.zeros(len(boxes), bool)
        for w in windows:
            fit = np.ones(len(boxes), bool)
            if w["low"] is not None:
                fit &= (most[n] >= w["low"]).astype(bool)
            if w["high"] is not None:
                fit &= (least[n] <= w["high"]).astype(bool)
            use |= fit
        use &= _usable_boxes(label, same, first, last)
        made.append(pd.DataFrame({"anchor_id": anchor, "block": block[use]}))
    return pd.concat(made)


def _routed(queries: DataFrame, boxes: DataFrame, same: bool) -> DataFrame:
    """``queries`` with each block to search; anchors meet the boxes in parts of bounded size."""
    spread = [max(1, -(-boxes.count() // BOXES)), max(1, -(-queries.count() // ANCHORS))]
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    asked = queries.withColumn("i", deal("anchor_id", spread[1])).withColumn("j", every(spread[0]))
    there = boxes.withColumn("j", deal("block", spread[0])).withColumn("i", every(spread[1]))
    ways = asked.groupBy("i", "j").cogroup(there.groupBy("i", "j")).applyInPandas(partial(_routes, same), "anchor_id bigint, block bigint")
    return queries.join(ways, "anchor_id")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    first = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
                   vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``is_anchor``, a condition on vec_id.

    Scores are inner products of the components times 256, rounded down. An anchor's positives are the ``positives`` best other
    rows of its label; a positive's negatives the ``negatives`` best rows of other labels whose score is ``least`` to ``most`` percent of
    the positive's. Ties go to the smaller vec_id. Null ids, labels and vectors, empty vectors, null or non-finite components and
    vectors of another width than the most common one take no part, nor do components so large (from about 2**25 at width 64) that
    scores would not fit 64 bits. Of rows that repeat an id the one with the smallest label, then vector, counts. An anchor
    without positives, or a positive without negatives, gives no rows; nor does an empty table. Other columns are not read.
    """
    rows = stage(blocks_of(usable(vectors, vec_id, label, embedding)), "blocks")
    packed = stage(rows.groupBy("block").applyInPandas(_pack, "block bigint, leaf int, ids array<bigint>, labels array<bigint>, x array<double>,"
                                                       " low array<double>, high array<double>, first bigint, last bigint"), "leaves")
    boxes = stage(packed.select("block", "first", "last", "low", "high").groupBy("block").applyInPandas(_box, "block bigint, first bigint, last bigint,"
                                                                                                        " low array<double>, high array<double>"), "boxes")
    open_window = F.array(F.struct(F.lit(None).cast("bigint").alias("positive_id"), F.col("floor").alias("low"), F.lit(None).cast("bigint").alias("high")))
    anchors = stage(rows.where(is_anchor).withColumnRenamed("vec_id", "anchor_id"), "anchors")
    nothing = F.lit(None).cast("bigint")
    home = stage(_searched(anchors.withColumn("floor", nothing).select("anchor_id", "label", "q", open_window.cast(_WINDOWS).alias("windows"), "block"),
                           packed, True, positives), "home")
    floors = home.groupBy("anchor_id").agg(F.when(F.count("*") == positives, F.min("score")).alias("floor"))
    queries = stage(anchors.join(floors, "anchor_id", "left").select("anchor_id", "label", "q", open_window.cast(_WINDOWS).alias("windows"), F.col("block").alias("own")), "queries")
    away = _routed(queries, boxes, True).where("block <> own").drop("own")
    near = stage(_best(home.union(_searched(away, packed, True, positives)), ["anchor_id"], positives)
                 .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # the least and largest whole score of each window; an empty one is left out
    bounds = near.select("anchor_id", "positive_id", F.expr(f"-((-positive_score * {least} - pmod(-positive_score * {least}, 100)) div 100)").alias("low"),
                         F.expr(f"(positive_score * {most} - pmod(positive_score * {most}, 100)) div 100").alias("high")).where("low <= high")
    windows = bounds.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "low", "high")).alias("windows"))  # one anchor's positives
    hunted = stage(anchors.join(windows, "anchor_id").select("anchor_id", "label", "q", F.col("windows").cast(_WINDOWS).alias("windows")), "hunts")
    found = _best(_searched(_routed(hunted, boxes, False), packed, False, negatives), ["anchor_id", "positive_id"], negatives)
    return (found.join(near, ["anchor_id", "positive_id"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def _box(leaves: pd.DataFrame) -> pd.DataFrame:
    """The bounding box of a block's leaves."""
    return pd.DataFrame({"block": leaves["block"].iloc[:1], "first": leaves["first"].min(), "last": leaves["last"].max(),
                         "low": [np.stack(leaves["low"].to_numpy()).min(axis=0)], "high": [np.stack(leaves["high"].to_numpy()).max(axis=0)]})
