"""Nearest neighbours by inner product: a hierarchical k-means tree, best bin first.

Vectors get one more component, so that the largest inner product is the smallest distance (Bachrach et al.,
RecSys 2014). The tree is fitted on a bounded sample and every vector is put in a leaf. A query goes down the tree by
a priority queue of branches, nearest centre first, and visits leaves in that order; how many is widened until a
calibration set of queries, compared with every vector, reaches the wanted recall.

Equal vectors are one candidate that knows its smallest ids, and equal queries are asked once, so copies
neither fill a leaf nor push others out. Leaves and their queries are cut into blocks, joined block by block.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from creditloom.llm.common import stage

#: Sampled vectors that fit the tree, children of a node, sampled vectors of a leaf, and rows of a block.
SAMPLE, BRANCH, LEAF, BLOCK = 60_000, 8, 60, 4096
#: Calibration queries and the recall they have to reach.
PROBES, RECALL = 256, 0.97


@dataclass
class Tree:
    """Centres of all nodes, the children of each (empty: a leaf), and the leaf's number."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray
    longest: float  # the longest vector's length: the added component makes all of them that long

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes them equally long (0 beyond the longest one known)."""
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(axis=1), 0.0))
        return np.hstack([x, rest[:, None]])

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector, by the nearest centre at each level."""
        x, out = self.lift(x), np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            nearest = _distances(x[rows], self.centres[kids]).argmin(axis=1)
            todo += [(int(kid), rows[nearest == k]) for k, kid in enumerate(kids) if (nearest == k).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """Up to ``most`` leaves for a query (its added component is 0), best bin first."""
        q, queue, found = np.append(query, 0.0), [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(int(self.leaf[node]))
                continue
            kids = self.children[node]
            gaps = ((self.centres[kids] - q) ** 2).sum(axis=1)
            for gap, kid in zip(gaps.tolist(), kids):
                heapq.heappush(queue, (gap, kid))
        return found

    @property
    def leaves(self) -> int:
        return int((self.leaf >= 0).sum())


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances less what is the same for every centre."""
    return (centres * centres).sum(axis=1) - 2 * x @ centres.T


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = _distances(x, centres).argmin(axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def grow(x: np.ndarray, longest: float, branch: int = BRANCH, leaf: int = LEAF, seed: int = 5) -> Tree:
    """The tree of a sample: nodes are split by k-means until ``leaf`` sampled vectors or one distinct vector are left."""
    tree = Tree(np.zeros((1, x.shape[1] + 1)), [[]], np.array([-1]), longest)
    x = tree.lift(np.unique(x, axis=0)) if len(x) else np.zeros((0, x.shape[1] + 1))
    centres, children, leaves, rng = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [[]], [-1], np.random.default_rng(seed)
    todo, n = [(0, np.arange(len(x)))], 0
    while todo:
        node, rows = todo.pop()
        if len(rows) > leaf:
            near = _distances(x[rows], found := _k_means(x[rows], min(branch, len(rows)), rng)).argmin(axis=1)
            used = np.unique(near)
            if len(used) > 1:
                for k in used:
                    children[node].append(len(centres))
                    todo.append((len(centres), rows[near == k]))
                    centres.append(found[k])
                    children.append([])
                    leaves.append(-1)
                continue
        leaves[node], n = n, n + 1
    return Tree(np.array(centres), children, np.array(leaves), longest)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), width)


def _usable(vectors: DataFrame, vec_id: str, embedding: str, width: int) -> DataFrame:
    """Rows with an id and a vector of ``width`` finite components that aren't all 0; as doubles."""
    x = F.col(embedding).cast("array<double>")
    fine = F.coalesce((F.size(x) == width) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists(x, lambda v: v != 0), F.lit(False))
    return vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), x.alias("x")).where(fine & F.col("vec_id").isNotNull())


def search(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``is_query`` (a condition on vec_id) its ``k`` nearest others.

    Nearness is the inner product in double precision; ties go to the smaller vec_id. Null ids and vectors that are null,
    zero, of another width than the most common one or hold null or non-finite components take no part.
    Rows that repeat an id count once for each distinct vector. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    widths = vectors.where(F.col(embedding).isNotNull()).groupBy(F.size(embedding).alias("w")).count().where("w > 0")
    common = widths.orderBy(F.desc("count"), "w").first()
    if common is None:
        return spark.createDataFrame([], schema)
    width = int(common.w)
    rows = stage(_usable(vectors, vec_id, embedding, width).withColumn("class", F.sha2(F.concat_ws(",", F.transform("x", lambda v: (v + 0.0).cast("string"))), 256))
                 .dropDuplicates(["vec_id", "class"]), "vectors")
    # a query needs at most k others, so a class of equal vectors answers with its k + 1 smallest ids
    least = rows.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    members = least.groupBy("class").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = stage(rows.groupBy("class").agg(F.first("x").alias("x")).join(members, "class"), "classes")
    asked = rows.where(is_query).select("vec_id", "class")
    facts = distinct.agg(F.count("*").alias("n"), F.max(F.aggregate("x", F.lit(0.0), lambda t, v: t + v * v)).alias("long")).first()
    if not facts.n:
        return spark.createDataFrame([], schema)
    share = F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 0.95 * SAMPLE / facts.n))
    sample = np.array([r.x for r in distinct.where(share).select("x").limit(SAMPLE).collect()], np.float64).reshape(-1, width)
    tree = grow(sample, float(np.sqrt(facts.long)) * (1 + 1e-12))

    def place(batches):
        for batch in batches:
            leaf = tree.place(_matrix(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(leaf, pa.int64())],
                                             names=["class", "x", "ids", "leaf"])

    placed = stage(distinct.select("class", "x", "ids").mapInArrow(place, "class string, x array<double>, ids array<bigint>, leaf bigint"), "leaves")
    queries = stage(distinct.join(asked.select("class").distinct(), "class").select("class", "x"), "queries")
    visits = _calibrated(tree, placed, queries, k, width)

    per = max(1, BLOCK * tree.leaves // facts.n)  # leaves of a block, neighbours in the tree

    def route(batches):
        """A query's visits, one row for each block of leaves."""
        for batch in batches:
            at, block, leaves = [], [], []
            for i, q in enumerate(_matrix(batch.column(1), width)):
                ways = np.sort(np.array(tree.visits(q, visits), dtype=np.int64))
                for part in np.split(ways, np.flatnonzero(np.diff(ways // per)) + 1):
                    at.append(i)
                    block.append(int(part[0]) // per)
                    leaves.append(part)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(block, pa.int64()),
                                              pa.array(leaves, pa.list_(pa.int64()))], names=["class", "x", "block", "leaves"])

    routed = stage(queries.mapInArrow(route, "class string, x array<double>, block bigint, leaves array<bigint>"), "routes")
    near = _nearest_in_blocks(routed, placed.withColumn("block", F.expr(f"leaf div {per}")), k)
    found = near.select("class", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("class").orderBy(F.desc("score"), "vec_id")
    answers = found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).drop("n")
    mine = answers.join(asked.withColumnRenamed("vec_id", "query_id"), "class").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (mine.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _best(queries: np.ndarray, x: np.ndarray, visited: np.ndarray, ids: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the ``k`` + 1 best candidates that each query visits; ties at the end by smallest id.

    A matrix product finds them; the scores of those found are summed one by one, alike in every block.
    """
    rough = np.where(visited, queries @ x.T, -np.inf)
    keep = min(k + 1, len(x))
    bound = np.partition(rough, len(x) - keep, axis=1)[:, len(x) - keep]
    q, c = np.nonzero((rough >= (bound - 1e-9 * np.abs(bound))[:, None]) & np.isfinite(rough))
    score = np.einsum("ij,ij->i", queries[q], x[c])
    order = np.lexsort((np.array([i[0] for i in ids])[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < keep], c[rank < keep], score[rank < keep]


def _nearest_in_blocks(routed: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """(class, score, ids): the best of each query in each block of leaves that it visits."""
    here = placed.groupBy("block").agg(F.count("*").alias("held"))
    there = routed.groupBy("block").agg(F.count("*").alias("asked"))
    cuts = here.join(there, "block").select("block", F.ceil(F.col("held") / BLOCK).alias("a"), F.ceil(F.col("asked") / BLOCK).alias("b"))
    zero = F.lit(0).cast("bigint")
    x = (placed.join(F.broadcast(cuts), "block")  # one row a block: bounded by the sample
         .select("block", "leaf", "x", "ids", F.pmod(F.xxhash64("class"), F.col("a")).alias("i"), F.explode(F.sequence(zero, F.col("b") - 1)).alias("j")))
    q = (routed.join(F.broadcast(cuts), "block")
         .select("block", "class", "x", "leaves", F.pmod(F.xxhash64("class"), F.col("b")).alias("j"), F.explode(F.sequence(zero, F.col("a") - 1)).alias("i")))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"class": [], "score": [], "ids": []})
        ids = right["ids"].tolist()
        names, number = np.unique(right["leaf"].to_numpy(), return_inverse=True)
        candidates, out = np.stack(right["x"].to_numpy()), []
        for start in range(0, len(left), 256):
            part = left.iloc[start:start + 256]
            opened = np.stack([np.isin(names, v) for v in part["leaves"]])
            n, c, score = _best(np.stack(part["x"].to_numpy()), candidates, opened[:, number], ids, k)
            out.append(pd.DataFrame({"class": part["class"].to_numpy()[n], "score": score, "ids": [ids[i] for i in c]}))
        return pd.concat(out)

    keys = ["block", "i", "j"]
    return q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInPandas(meet, "class string, score double, ids array<bigint>")


def _calibrated(tree: Tree, placed: DataFrame, queries: DataFrame, k: int, width: int) -> int:
    """Leaves to visit: the fewest with which the calibration queries find ``RECALL`` of their true neighbours.

    The true ones come from comparing at most ``PROBES`` queries with every vector, block by block.
    """
    total = queries.count()
    draw = F.pmod(F.xxhash64(F.lit("probe"), "class"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * PROBES / max(1, total)))
    probes = queries.where(draw).limit(PROBES).collect()
    if not probes:
        return tree.leaves
    asked = np.array([r.x for r in probes], np.float64)

    def brute(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, leaf, weight = _matrix(batch.column(0), width), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            scores = asked @ x.T
            keep = min(k + 1, len(x))
            top = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
            n = np.repeat(np.arange(len(asked)), keep)
            j = top.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(scores[n, j], pa.float64()), pa.array(leaf[j], pa.int64()),
                                              pa.array(weight[j], pa.int64())], names=["n", "score", "leaf", "held"])

    rows = placed.select("x", "leaf", F.size("ids").cast("bigint").alias("held"))
    every = rows.mapInArrow(brute, "n bigint, score double, leaf bigint, held bigint")
    order = Window.partitionBy("n").orderBy(F.desc("score"), "leaf")
    truth = every.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).collect()  # k + 1 rows a probe
    needed = []
    by_probe: dict[int, list] = {}
    for r in sorted(truth, key=lambda r: r.r):
        by_probe.setdefault(r.n, []).append(r)
    for n, wanted in by_probe.items():
        at = {leaf: i + 1 for i, leaf in enumerate(tree.visits(asked[n], tree.leaves))}
        left = k + 1
        for r in wanted:
            times = min(left, r.held)
            needed += [at[r.leaf]] * times
            left -= times
            if not left:
                break
    needed.sort()
    wanted = needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)]
    visits = 1
    while visits < wanted:  # widened step by step, a quarter each time
        visits += max(1, visits // 4)
    return min(visits, tree.leaves)
