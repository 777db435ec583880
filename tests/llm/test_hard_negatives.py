"""Hard negatives against plain Python, and the boxes' intervals."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom.llm import hard_negatives as hn
from creditloom.llm.catalog import ORACLES, QUERIES
from tests.check import compare, connect

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank int, block string, score string, q string"


def plain(rows, anchor, label, k=5, m=10):
    best = {}
    width = len(next(iter(e for _, e, *_ in rows if e)))
    for i, e, lab in rows:
        if i is None or lab is None or not e or len(e) != width or any(x is None or not math.isfinite(x) for x in e):
            continue
        one = (label(i, lab), [math.floor(256 * x) for x in e])
        if max(map(abs, one[1])) > math.isqrt(2 ** 56 // width):
            continue
        best[i] = min(best.get(i, one), one)
    out = []
    for a, (la, qa) in best.items():
        if not anchor(a):
            continue
        score = {v: sum(x * y for x, y in zip(qa, q)) for v, (_, q) in best.items() if v != a}
        order = sorted(score, key=lambda v: (-score[v], v))
        for p in [v for v in order if best[v][0] == la][:k]:
            good = [v for v in order if best[v][0] != la and 30 * score[p] <= 100 * score[v] <= 90 * score[p]]
            out += [(a, p, r + 1, v, score[p], score[v]) for r, v in enumerate(good[:m])]
    return sorted(out)


def odd_rows(n=900, width=5, seed=3, spread=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.4, spread) for _ in range(width)], rng.choice([0, 0, 0, 0, 1, 2, 9])) for i in range(-20, n)]
    hot = [0.5] * width
    rows += [(5000 + i, hot, i % 3) for i in range(400)]  # ties
    rows += [(40, hot, 4), (40, hot, 1), (41, hot, 2), rows[60], rows[60]]  # repeated ids and rows
    rows += [(None, hot, 1), (9001, None, 1), (9002, [], 1), (9003, hot, None), (9004, [None] + hot[1:], 1), (9005, [float("nan")] + hot[1:], 1),
             (9006, [float("-inf")] + hot[1:], 1), (9007, [1.0], 1), (9100, [0.0] * width, 1), (9101, [1e30] * width, 1), (9200, [-x for x in hot], 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "x", "x") for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("spread", [1.0, 3e4])  # the second beyond the doubles' whole numbers
def test_against_plain_search(spark, monkeypatch, spread):
    monkeypatch.setattr(hn, "BLOCK", 150)
    monkeypatch.setattr(hn, "ANCHORS", 40)
    monkeypatch.setattr(hn, "BOXES", 3)
    rows = odd_rows(spread=spread)
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    monkeypatch.setattr(hn.blocks_of, "__defaults__", (150,))
    got = hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, label).collect()
    want = plain(rows, lambda v: v % 20 == 0, lambda v, lab: (lab + 1) % 10 if v % 7 == 0 else lab)
    assert sorted(tuple(r) for r in got) == want and len(want) > 500


def test_empty_and_lonely(spark):
    label, anchor = F.col("label"), F.col("vec_id") % 2 == 0
    assert hn.hard_negatives(frame(spark, []), anchor, label).count() == 0
    assert hn.hard_negatives(frame(spark, [(0, [1.0], 1)]), anchor, label).count() == 0
    assert hn.hard_negatives(frame(spark, [(0, [1.0], 1), (1, [1.0], 2)]), anchor, label).count() == 0
    pair = [(0, [1.0], 1), (1, [2.0], 1), (3, [1.0], 2)]
    assert [tuple(r) for r in hn.hard_negatives(frame(spark, pair), anchor, label).collect()] == [(0, 1, 1, 3, 131072, 65536)]


def test_packing_keeps_every_row_and_boxes_bound():
    rng = np.random.default_rng(5)
    x, labels = np.floor(rng.normal(0, 80, (1000, 6))), rng.integers(0, 3, 1000)
    frame_ = pd.DataFrame({"block": 1, "vec_id": np.arange(1000), "label": labels, "q": list(x)})
    leaves = hn._pack(frame_)
    assert sorted(i for ids in leaves["ids"] for i in ids) == list(range(1000)) and max(map(len, leaves["ids"])) <= hn.LEAF
    assert leaves["first"].eq(leaves["last"]).mean() > 0.8  # leaves hold one label, but at the seams
    anchors = np.floor(rng.normal(0, 80, (20, 6)))
    tree = hn.Packed(leaves)
    for low, high, first, last in tree.levels:
        least, most = hn.intervals(anchors, low, high)
        per = len(leaves) / len(low)
        assert (least <= most).all() and per >= 1
    least, most = hn.intervals(anchors, *tree.levels[0][:2])
    for leaf, rows in enumerate(tree.rows):
        scores = anchors @ rows.T
        assert (scores >= least[:, [leaf]]).all() and (scores <= most[:, [leaf]]).all()
    assert len(tree.levels[-1][0]) == 1


def test_query_matches_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        assert compare(QUERIES["op12_hard_negatives"](spark, sf), connect(sf), ORACLES["op12_hard_negatives"]) == []
