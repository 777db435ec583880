"""Operators over all documents: duplicates, repeats, search, mixing, packing, and the pipeline."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import mixing, packing, simhash, substrings, tree_search
from creditloom.llm.catalog import ORACLES, QUERIES, vocabulary
from creditloom.llm.components import components
from tests.check import compare, connect
from tests.llm import brute
from tests.llm.conftest import SF


def key(r):
    return (r[0] is None, r[0] or 0, *map(str, r[1:]))


def test_fingerprints_and_groups(odd, empty, documents):
    for docs in (odd, documents):
        rows = [(r.doc_id, brute.fingerprint(r.text)) for r in docs.collect()]
        want = sorted(((d, f, c) for (d, f), c in zip(rows, brute.components(rows)[0])), key=key)
        got = simhash.near_groups(docs).collect()
        assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=key) == want
    assert simhash.near_groups(empty).count() == 0


def test_links_lose_and_repeat_none(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-2 ** 63, 2 ** 63 - 1, 30)
    prints = {int(b) for b in base}
    for b in base.tolist():  # near ones in every pattern of segments, and some just too far
        for flips in range(1, 6):
            for _ in range(6):
                x = b & (1 << 64) - 1
                for bit in rng.choice(64, flips, replace=False).tolist():
                    x ^= 1 << bit
                prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    for distance in (0, 1, 2, 3):
        got = [(r.a, r.b) for r in simhash.links(df, distance=distance).collect()]
        want = {(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance}
        assert len(got) == len(set(got)) and set(got) == want


def test_one_of_each_group_stays(odd, empty):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, brute.fingerprint(r.text)) for r in odd.collect()]
    least, group = brute.components(rows)
    got = kept.collect()
    assert len(got) == len(set(group))
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, {g: m for g, m in zip(group, least)}.values()))
    assert simhash.one_of_each(empty).count() == 0


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000), (7, 7), (1, 0), (0, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1400)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_repeated_spans(odd, empty, documents):
    for docs in (odd, documents):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        want = sorted(((r[0], *v) for r, v in zip(rows, brute.repeats(rows))), key=key)
        assert sorted((tuple(r) for r in substrings.dedup_spans(docs).collect()), key=key) == want
    assert substrings.dedup_spans(empty).count() == 0


def test_words_of_one_pattern_are_told_apart(spark):
    pattern = "a"
    for _ in range(12):  # the pattern under which sums modulo 2**64 are blind
        pattern += pattern.translate(str.maketrans("ab", "ba"))
    words = [f"w{i}" for i in range(19)]
    rows = [(i, " ".join([*words, x])) for i, x in enumerate((pattern, pattern.translate(str.maketrans("ab", "ba")), pattern[:2048] + "c" * 2048, pattern))]
    got = substrings.dedup_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(0, 20, 0), (1, 20, 0), (2, 20, 0), (3, 20, 20)]


def test_anchors_are_chosen_by_content():
    text = "the quick brown fox jumps over a lazy dog and runs along the river bank to find some food for its young ones today"
    words = substrings.Words([text, "x " + text, None, "short"])
    which, hashes, first, spans = substrings.anchors(words)
    one, two = (hashes[which == k] for k in (0, 1))
    assert spans[which == 0].sum() == len(text.split()) - 19 and set(one) <= set(two) and not (which > 1).any()


def test_spans_query_matches_sql(spark):
    sf = SF
    assert compare(QUERIES["op9_repeated_spans"](spark, sf), connect(sf), ORACLES["op9_repeated_spans"]) == []


def _check_packing(got, docs, capacity=2048):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = collections.Counter()
    for d, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for i in range(0, len(ids), capacity):
            part = ids[i:i + capacity]
            want[d, i // capacity, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = collections.defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held), -(-sum(r.length for r in got) // capacity)


def test_packed_documents(odd, empty, documents):
    for docs in (odd, documents):
        used, bound = _check_packing(packing.packed_documents(docs, vocabulary("word_bpe_49k.json")).collect(), [(r.doc_id, r.text) for r in docs.collect()])
        assert used <= bound * 1.02 + 1
    assert packing.packed_documents(empty, vocabulary("word_bpe_49k.json")).count() == 0


def _least_sequences(items, capacity):
    best = [len(items)]

    def go(rest, bins):
        if len(bins) >= best[0]:
            return
        if not rest:
            best[0] = len(bins)
            return
        seen = set()
        for i, room in enumerate(bins):
            if rest[0] <= room and room not in seen:
                seen.add(room)
                go(rest[1:], bins[:i] + [room - rest[0]] + bins[i + 1:])
        go(rest[1:], [*bins, capacity - rest[0]])

    go(sorted(items, reverse=True), [])
    return best[0]


def test_reduction_keeps_a_best_packing():
    rng = np.random.default_rng(8)
    for _ in range(300):
        capacity = int(rng.integers(8, 25))
        items = rng.integers(1, capacity + 1, rng.integers(1, 10)).tolist()
        counts = dict(collections.Counter(items))
        fixed, left = packing.reduce_instance(counts, capacity)
        again = collections.Counter(left)
        for times, held in fixed:
            assert sum(s * n for s, n in held) <= capacity
            for s, n in held:
                again[s] += times * n
        assert +again == collections.Counter(items)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(t for t, _ in fixed) + _least_sequences(rest, capacity) == _least_sequences(items, capacity)
        groups = packing.plan(counts, capacity)
        used = collections.Counter()
        for times, held in groups:
            assert sum(s * n for s, n in held) <= capacity
            for s, n in held:
                used[s] += times * n
        assert used == collections.Counter(items)


def test_plan_of_many_pieces_is_small():
    rng = np.random.default_rng(9)
    counts = {s: int(n) for s, n in zip(range(1, 2049), rng.integers(1, 10 ** 7, 2048))}
    groups = packing.plan(counts, 2048)
    total = sum(s * n for s, n in counts.items())
    assert len(groups) < 6 * 2048 and sum(t for t, _ in groups) <= 1.02 * max(-(-total // 2048), sum(n for s, n in counts.items() if s > 1024)) + 1


def test_mixture(odd, empty, documents):
    counted = documents.select("doc_id", "source", mixing.word_count().alias("tokens"))
    got = mixing.mix(counted, most_repeats=3.0).collect()
    times = collections.Counter(r.doc_id for r in got)
    assert set(times) == {r.doc_id for r in documents.collect()} and max(times.values()) <= 4
    held, weight = collections.Counter(), {}
    for r in got:
        held[r.source] += r.tokens
        weight[r.source] = r.weight
    longest = max(r.tokens for r in got)
    for s, w in weight.items():  # within one document of the weight
        assert abs(held[s] - w * sum(held.values())) <= 2 * longest
    assert math.isclose(sum(weight.values()), 1, abs_tol=1e-6)
    limited = mixing.mix(counted, budget=5000).collect()
    assert sum(r.tokens for r in limited) <= 5000 + 20 * longest
    strange = mixing.mix(odd.select("doc_id", "source", mixing.word_count().alias("tokens"))).collect()
    assert {r.source for r in strange} == {r.source for r in odd.collect()} and len(strange) >= odd.count()
    assert mixing.mix(empty.select("doc_id", "source", mixing.word_count().alias("tokens"))).count() == 0


def test_exponent_meets_its_bounds(spark):
    shares = [0.7, 0.2, 0.06, 0.03, 0.01]
    sources = spark.createDataFrame([(str(i), int(1000 * s), s) for i, s in enumerate(shares)], "source string, tokens bigint, share double")

    def facts(t):
        raised = [s ** t for s in shares]
        p = [r / sum(raised) for r in raised]
        spread = [r / s for r, s in zip(raised, shares)]
        return -sum(x * math.log(x) for x in p), max(spread) / min(spread)

    free = mixing.find_exponent(sources, 0.5, 1e9)
    assert abs(facts(free)[0] - (facts(1)[0] + 0.5 * (facts(0)[0] - facts(1)[0]))) < 1e-4
    tight = mixing.find_exponent(sources, 0.5, 2.0)
    assert tight > free and abs(facts(tight)[1] - 2.0) < 1e-3


def test_mixture_matches_sql(spark):
    assert compare(QUERIES["op7_temperature_mix"](spark, SF), connect(SF), ORACLES["op7_temperature_mix"]) == []


def test_rules_match_sql(spark):
    assert compare(QUERIES["op4_adaptive_rules"](spark, SF), connect(SF), ORACLES["op4_adaptive_rules"]) == []


def test_mixed_rows_keep_every_row(odd, empty):
    got = mixing.mixed_rows(odd)
    assert got.columns == odd.columns
    want, have = (collections.Counter((r.doc_id, r.text, r.source) for r in d.collect()) for d in (odd, got))
    assert set(want) == set(have) and all(have[k] >= n for k, n in want.items())
    assert mixing.mixed_rows(empty).count() == 0


def _nearest(x, ids, asked, k):
    out = {}
    for q in asked:
        i = ids.index(q)
        score = [float(np.dot(x[i], v)) for v in x]
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-score[j], ids[j]))[:k]
        out[q] = [(ids[j], score[j]) for j in order]
    return out


def test_search_finds_the_nearest(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.collect()
    want = _nearest([np.array(r.embedding, float) for r in rows], [r.vec_id for r in rows], [r.vec_id for r in rows if r.vec_id % 20 == 0], 20)
    got = collections.defaultdict(list)
    for r in sorted(QUERIES["op5_kmeans_tree"](spark, SF).collect(), key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    exact = {r.vec_id: np.array(r.embedding, float) for r in rows}
    assert all(math.isclose(s, float(exact[q] @ exact[v]), abs_tol=1e-12) for q, hits in got.items() for v, s in hits)


def test_search_among_copies_and_broken_vectors(spark, monkeypatch):
    rng = np.random.default_rng(6)
    good = [(i, [float(np.float32(v)) for v in rng.normal(size=4)]) for i in range(0, 400, 2)]
    copies = [(i, [1.0, 2.0, 0.0, -1.0]) for i in range(1, 301, 2)]
    broken = [(1000, None), (1020, [0.0] * 4), (1040, [1.0, None, 0.0, 0.0]), (1060, [float("nan"), 1.0, 0.0, 0.0]),
              (1080, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (1100, []), (1120, [1.0, 2.0])]
    table = spark.createDataFrame([*good, *copies, *broken, good[0]], "vec_id bigint, embedding array<float>").withColumn("class", F.lit(1))
    monkeypatch.setattr(tree_search, "BLOCK", 50)  # leaves and queries in blocks
    monkeypatch.setattr(tree_search, "RECALL", 1.0)
    got = collections.defaultdict(list)
    for r in sorted(tree_search.search(table, F.col("vec_id") % 20 < 2, 7).collect(), key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    rows = [*good, *copies]
    want = _nearest([np.array(v) for _, v in rows], [i for i, _ in rows], [i for i, _ in rows if i % 20 < 2], 7)
    found = sum(got[q] == [(v, round(s, 9)) for v, s in want[q]] for q in want)
    assert set(got) == set(want) and found >= 0.97 * len(want)
    assert tree_search.search(table.where("vec_id > 500"), F.col("vec_id") % 20 == 0).count() == 0
    assert tree_search.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark, odd, empty):
    docs, counts = odd, []
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF)
        if name != "pack":
            assert out.columns == odd.columns
        docs = out.cache()
        counts.append((name, docs.count()))
    assert all(n > 0 for _, n in counts)
    docs = empty
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        assert docs.count() == 0


def test_pipeline_keeps_clean_documents(spark):
    result = QUERIES_AND_PIPELINE["pipeline"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [(d, brute.fingerprint(t)) for d, t in docs.items()]
    assert {r.doc_id for r in result} == set(brute.components(rows)[0])
    held = collections.defaultdict(int)
    for r in result:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 2048 and len(held) <= 1.03 * -(-sum(held.values()) // 2048) + 1


QUERIES_AND_PIPELINE = {**QUERIES, "pipeline": corpus_pipeline.run}


def test_registered_names():
    from __spark_entry__ import oracle_sql, queries
    names = set(queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {q.split("_")[0] + "_" for q in names if q.startswith("op")} and "pipeline" in names
    assert set(oracle_sql()) <= names


@pytest.mark.parametrize("name", ["op3_cached_token_counts", "op6_personal_data", "op10_packed_sequences"])
def test_one_row_or_more_per_document(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
