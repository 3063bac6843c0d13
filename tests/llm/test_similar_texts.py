import itertools
import random

import numpy as np
import pytest

from cartomark.llm import similar_texts as T


def brute_groups(rows, similarity=0.8):
    """Smallest id of each group of texts that exact Jaccard of five-word shingles joins."""
    sets = {}
    for d, t in rows:
        w = (t or "").lower().split()
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if (sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])) or sets[a] == sets[b]:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {find(d) for d in sets}


def groups(spark, rows, **more):
    docs = T.with_node(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = T.similar_nodes(docs, **more).groupBy("component").agg({"leader": "min"}).collect()
    return {r[1] for r in got}


def edited(rng, words, n):
    copy = list(words)
    for _ in range(n):
        copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
    return copy


@pytest.mark.parametrize("tile", [8, 8192])
def test_groups_equal_brute_force(spark, tile):
    rng = random.Random(7)
    rows = []
    for _ in range(8):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([6, 60, 200]))]
        for _ in range(9):
            copy = edited(rng, words, rng.randrange(1 + len(words) // 40))
            rows.append((len(rows), " ".join(copy[: len(copy) - rng.randrange(2)])))
    assert groups(spark, rows, tile=tile) == brute_groups(rows)


def test_family_around_one_text_whose_members_are_not_alike(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_ROWS", 16)
    rng = random.Random(8)
    hub = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(0, " ".join(hub))] + [(i, " ".join(edited(rng, hub, 7))) for i in range(1, 70)]
    # One group through the hub in small tiles; without it most members stay apart.
    assert groups(spark, rows, tile=20) == {0} == brute_groups(rows)
    assert groups(spark, rows[1:], tile=20) == brute_groups(rows[1:])


def test_many_candidates_below_the_similarity_stay_apart():
    rng = np.random.default_rng(9)
    shared = np.arange(700, dtype=np.uint64)
    sets = [np.append(shared, np.sort(rng.choice(10**9, 300, replace=False).astype(np.uint64) + np.uint64(1000))) for _ in range(60)]
    sets[41] = np.sort(np.append(sets[40][:950], np.arange(2 * 10**9, 2 * 10**9 + 50, dtype=np.uint64)))
    both = [np.stack([s, s * np.uint64(0x9E3779B97F4A7C15)], axis=1) for s in sets]
    two, eight = zip(*(T.sketch(h) for h in both), strict=True)
    node = np.arange(60)
    rows = T.Rows(node, np.full(60, 1000), node, np.array(two).view(np.uint64), np.array(eight).view(np.uint64))
    links = T.tested_links(rows, rows, sets, sets, True, 0.8, 128)
    assert links == [(40, 41)]
    assert T.tested_links(rows, rows, sets, sets, True, 0.5, 128).__len__() == 59


def test_counts_of_shared_members_are_exact():
    rng = np.random.default_rng(1)
    a, b = ([np.unique(rng.integers(0, 9000, rng.integers(1, 6000)).astype(np.uint64)) for _ in range(7)] for _ in range(2))
    want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert T.shared_counts(a, b).tolist() == want
    assert T.shared_counts([np.array([1], np.uint64)], [np.array([2], np.uint64)]).tolist() == [[0]]


def test_sketches_of_similar_sets_pass_the_screen():
    rng = np.random.default_rng(2)
    passed = 0
    for _ in range(200):
        union = rng.integers(0, 2**64, (300, 2), dtype=np.uint64)
        (two_a, eight_a), (two_b, eight_b) = T.sketch(union[:270]), T.sketch(union[30:])
        rows = [T.Rows(np.array([i]), np.array([270]), np.array([i]), two.view(np.uint64)[None], eight.view(np.uint64)[None]) for i, two, eight in ((0, two_a, eight_a), (1, two_b, eight_b))]
        passed += any(True for _ in T.screened(*rows, False, 0.8, T.RADIUS))
    assert passed >= 196


def test_odd_documents(spark, odd_docs, no_docs):
    got = {r["leader"]: r["component"] for r in T.similar_nodes(T.with_node(odd_docs)).collect()}
    # 2, 3 and 4 have no words and are one node; three times a sentence and the sentence share 11 of 15 shingles.
    assert set(got) == {1, 2, 5, 6, 7} and len(set(got.values())) == 5
    assert T.similar_nodes(T.with_node(no_docs)).count() == 0
    replaced = T.with_node(spark.createDataFrame([(1, "A  b", "x")], "doc_id long, text string, _node string"))
    assert replaced.columns == ["doc_id", "text", "_node"] and replaced.first()["_node"] == T.with_node(spark.createDataFrame([(1, " a\tB ")], "doc_id long, text string")).first()["_node"]
