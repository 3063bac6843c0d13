import collections
import math
import random
import re

import numpy as np

from cartomark.llm import lexical_search as S

DOCS = "doc_id long, text string, score string, rank string, item_id string"
ITEMS = "item_id long, text string, doc_id string, score string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_rank(docs, items, k=10):
    docs = [(i, collections.Counter(terms(t))) for i, t, *_ in docs if i is not None]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    own = collections.defaultdict(set)
    for i, t, *_ in items:
        if i is not None:
            own[i].update(terms(t))
    out = []
    for item, words in own.items():
        scored = []
        for i, c in docs:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if c[w])
            if score > 0:
                scored.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def got_rank(docs, items, **more):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in S.rank_documents(docs, items, **more).collect())


def corpus(rng, n):
    words = [f"W{i}" for i in range(60)] + ["naïve", "über", "東京", "x1", "_", "..."]
    texts = [" ".join(rng.choice(words[: rng.choice([5, 66])]) for _ in range(rng.randrange(1, 40))) for _ in range(n)]
    return [(i, rng.choice(texts), "s", "r", "i") for i in range(n)], words


def test_ranks_equal_brute_force(spark):
    rng = random.Random(5)
    rows, words = corpus(rng, 400)
    rows += [(500 + i, rows[7][1], "s", "r", "i") for i in range(150)] + [rows[3], (3, "other w1 text", "s", "r", "i")]
    items = [(i, " ".join(rng.sample(words, rng.randrange(1, 12))), "d", "s") for i in range(25)] + [(4, "w1, w2", "d", "s"), (30, "nowhere", "d", "s"), (31, "...", "d", "s"), (32, None, "d", "s"), (None, "w1", "d", "s")]
    docs, asked = spark.createDataFrame(rows, DOCS).repartition(4), spark.createDataFrame(items, ITEMS)
    want = brute_rank(rows, items)
    assert got_rank(docs, asked) == want
    assert got_rank(docs, asked, k=3) == brute_rank(rows, items, 3)


def test_small_segments_lists_and_item_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(6)
    rows, words = corpus(rng, 150)
    items = [(i, " ".join(rng.sample(words, 6)), "d", "s") for i in range(12)]
    docs, asked = spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(S, "QUERY_BYTES", 120)
    assert got_rank(docs, asked) == brute_rank(rows, items)


def test_searching_short_lists_one_after_the_other_keeps_the_best():
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 3000, 40)
    weights[7] = 0
    parts, best = [], (np.empty(0, np.int64), np.empty(0, np.int64))
    asked, everything = np.array([1, 4, 7, 9, 33]), []
    for at in range(0, 3000, 500):
        own = [np.sort(rng.choice(40, rng.integers(1, 12), replace=False)) for _ in range(500)]
        part = (np.arange(at, at + 500), rng.integers(1, 30, 500), np.append(0, np.cumsum([len(o) for o in own])), np.concatenate(own).astype(np.int32), rng.integers(1, 4, sum(map(len, own))).astype(np.int32))
        lists = S.lists_of([part], weights=weights, n_docs=3000, n_terms=40_000)
        best = lists.search(asked, *best, 10)[:2]
        assert not lists.seen.any() and not lists.member.any()
        parts.append(part)
        kept = np.isin(lists.terms, asked)
        everything += np.bincount(np.repeat(np.arange(500), np.diff(lists.starts))[kept], weights=lists.impacts[kept], minlength=500).astype(int).tolist()
    whole = S.lists_of(parts, weights=weights, n_docs=3000, n_terms=40_000)
    ids, scores, evaluated = whole.search(asked, np.empty(0, np.int64), np.empty(0, np.int64), 10)
    want = sorted((-s, i) for i, s in enumerate(everything))[:10]
    assert list(zip(ids.tolist(), scores.tolist(), strict=True)) == [(i, -s) for s, i in want]
    assert list(zip(best[0].tolist(), best[1].tolist(), strict=True)) == [(i, -s) for s, i in want]
    # Rare heavy terms settle the ranks: most documents are never scored.
    assert evaluated < 2000


def test_equal_scores_are_read_to_the_smallest_id():
    n = 1000
    part = (np.arange(n)[::-1].copy(), np.full(n, 10), np.arange(n + 1), np.zeros(n, np.int32), np.ones(n, np.int32))
    lists = S.lists_of([part], weights=np.array([500]), n_docs=n, n_terms=10 * n)
    ids, _, evaluated = lists.search(np.array([0]), np.empty(0, np.int64), np.empty(0, np.int64), 10)
    assert ids.tolist() == list(range(10)) and evaluated == n


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 10)
    text = "Alpha beta-GAMMA déjà " * 20 + "x" * 50
    assert [w.decode() for piece in S.terms_of(text) for w in piece] == terms(text)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = [(1, "quick fox word naïve", "d", "s"), (2, "", "d", "s")]
    asked = spark.createDataFrame(items, ITEMS)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got_rank(odd_docs, asked) == brute_rank(rows, items)
    assert got_rank(no_docs, asked) == [] and got_rank(odd_docs, spark.createDataFrame([], ITEMS)) == []
