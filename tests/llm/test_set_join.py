"""The set join against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import set_join as sj
from creditloom.llm.wordhash import shingle_hashes, split_words, word_hashes
from tests.llm import brute


def plain_set(text, size=4):
    w = brute.words((text or "").translate(brute.LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def plain(rows, percent=85, size=4):
    """Sorted (doc, n, component) of every row, pair by pair."""
    sets = [plain_set(t, size) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and top(i) != top(j):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    group[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min((x for x in (least.get(top(i)), doc) if x is not None), default=None)
    return sorted(((d, len(s), least[top(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows_and_documents(odd, empty, documents):
    for docs in (odd, documents):
        assert answer(sj.similar_groups(docs)) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sj.similar_groups(empty).count() == 0


def planted(seed=6):
    """Near copies at every distance about the limit, of short, middling and long texts, in chains and in one large group."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = []

    def edited(words, changes):
        w = list(words)
        for _ in range(changes):
            at = rng.randrange(len(w))
            kind = rng.random()
            if kind < 0.4:
                w[at] = word()
            elif kind < 0.7:
                del w[at]
            else:
                w.insert(at, word())
        return w

    for length in (3, 4, 5, 8, 9, 10, 12, 16, 17, 20, 23, 24, 30, 40, 60, 90, 150):
        for _ in range(4):
            base = [word() for _ in range(length)]
            texts.append(base)
            for _ in range(5):
                texts.append(edited(base, rng.randint(0, max(1, length // 25))))
            texts += [base + [word()], base[1:], [word(), *base], base + [word() for _ in range(max(1, length // 12))]]
    base = [word() for _ in range(120)]
    texts += [edited(base, rng.randint(1, 4)) for _ in range(150)]  # one list holds many
    walk = [word() for _ in range(70)]
    for _ in range(30):
        walk = edited(walk, 1)
        texts.append(walk)
    passage = [word() for _ in range(50)]
    texts += [[word() for _ in range(20)] + passage + [word() for _ in range(rng.randint(5, 40))] for _ in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, rows[i][1].upper()) for i in range(0, 200, 5)] + [(None, rows[3][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("centres", [1])
def test_planted_near_copies(spark, monkeypatch, centres):
    monkeypatch.setattr(sj, "CENTRES", centres)
    rows = planted()
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "doc_id bigint, text string, id string, root string").repartition(4)
    assert answer(sj.similar_groups(df)) == plain(rows)


@pytest.mark.parametrize("most", [9, 22])
def test_any_boundary_gives_the_same(spark, monkeypatch, most):
    monkeypatch.setattr(sj, "boundary", lambda *a: most)
    rows = [r for r in planted(9) if len(r[1].split()) < 45]
    assert answer(sj.similar_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))) == plain(rows)


def test_subsets_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    for n in range(1, 21):
        one = np.sort(rng.integers(1, 1 << 60, n).astype(np.uint64))
        keys, sizes = sj.subset_keys(one)
        assert len(keys) == sj.ways(n) == len(set(zip(keys.tolist(), sizes.tolist())))
        for gone in range(n - sj.shared_least(n) + 1):
            other = np.sort(np.r_[one[gone:], rng.integers(1, 1 << 60, 1).astype(np.uint64)])
            common = n - gone
            linked = 100 * common >= 85 * (n + len(other) - common)
            met = {(k, c) for k, c in zip(*map(np.ndarray.tolist, sj.subset_keys(other)))} & set(zip(keys.tolist(), sizes.tolist()))
            assert linked <= any(185 * c >= 85 * (n + len(other)) for _, c in met)


def test_shingles_are_those_of_the_words():
    texts = ["a b c d e", "A  B\tc D", "a b", "b a", None, "", " \n", "a b c d a b c d", "x\x1cy é 🙂 İ"]
    sets = sj.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(plain_set(t)) for t in texts]
    assert sets[1][0] in sets[0] and sets[2][0] != sets[3][0]
    words, bounds = split_words(texts, lower=True)
    _, cuts = shingle_hashes(word_hashes(words), bounds, 4)
    assert np.diff(cuts).tolist() == [2, 1, 1, 1, 0, 0, 0, 5, 1]


def test_linked_sets_share_their_lead():
    rng = np.random.default_rng(3)
    for n in [*range(14, 60), 100, 160, 161, 400]:
        assert sj.lead(n) <= sj.shared_least(n) and sj.head(n) <= n
        for m in range(sj.shared_least(n), n + 1, max(1, n // 20)):
            common = -(-85 * (n + m) // 185)
            if common > m:
                continue
            order = rng.permutation(n + m - common)  # a rank for every shingle of both; the first ones are in both
            a, b = np.r_[0:common, common:n], np.r_[0:common, n:n + m - common]
            one, two = (set(v[np.argsort(order[v])][:sj.head(len(v))].tolist()) for v in (a, b))
            assert len(one & two) >= sj.lead(m) >= sj.lead(sj.shared_least(n))


def test_bitmaps_differ_no_more_than_sets():
    rng = np.random.default_rng(2)
    for n in (0, 1, 20, 400, 3000):
        one = np.unique(rng.integers(1, 1 << 62, n).astype(np.uint64))
        other = np.unique(np.r_[one[n // 5:], rng.integers(1, 1 << 62, n // 7).astype(np.uint64)])
        a, b = sj.bitmaps([one, other])
        assert sum(bin(int(x) & (1 << 64) - 1).count("1") for x in a ^ b) <= len(np.setxor1d(one, other))


def test_the_boundary_is_the_cheapest(spark):
    rows = planted(4)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    heads = [(i, len(s), [hash(x) for x in list(s)[:len(s) - sj.shared_least(len(s)) + 1]]) for i, s in enumerate({plain_set(t) for _, t in rows} - {frozenset()})]
    most = sj.boundary(spark.createDataFrame(heads, "id bigint, size bigint, head array<bigint>"))
    assert 0 <= most <= sj.LIGHT_MOST and df.count() == len(rows)
    assert sj.boundary(spark.createDataFrame([], "id bigint, size bigint, head array<bigint>").where(F.lit(False))) == 0
