import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartomark.llm import lm_scoring as M
from cartomark.llm import vector_search as V


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [None]


class BackoffModel:
    """The same model, straight from its definition."""

    def __init__(self, texts, order, exponents):
        self.order, self.exponents = order, exponents
        self.counts = [collections.Counter() for _ in range(order)]
        for t in texts:
            row = ["<begin>", *tokens(t)]
            for k in range(order):
                self.counts[k].update(tuple(row[i : i + k + 1]) for i in range(len(row) - k))
        self.begins = self.counts[0].pop(("<begin>",), 0)
        self.n, self.v = sum(self.counts[0].values()), len(self.counts[0])

    def base(self, token):
        return (self.counts[0][(token,)] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def probability(self, context, token):
        if not context:
            return self.base(token)
        c = self.begins if context == ("<begin>",) else self.counts[len(context) - 1][context]
        shorter = self.probability(context[1:], token)
        if c == 0:
            return shorter
        left = 0.9 * c ** (self.exponents[len(context) - 1] - 1)
        if self.counts[len(context)][(*context, token)] == 0:
            return left * shorter
        return (1 - left) * self.counts[len(context)][(*context, token)] / c + left * shorter

    def score(self, text):
        row = ["<begin>", *tokens(text)]
        return sum(math.log10(self.probability(tuple(row[max(0, i - self.order + 1) : i]), row[i])) for i in range(1, len(row)))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_definition(spark, monkeypatch, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice(["a", "B", "c", "dé", "e\x0b", "F"]) for _ in range(rng.randrange(15))) for _ in range(60)] + [None, "", "unseen words only"]
    rows = spark.createDataFrame([(i, t, i % 3 != 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, learn boolean, block string").repartition(4)
    fitted = {}
    fit = M.fit
    monkeypatch.setattr(M, "fit", lambda answers, order: fitted.setdefault("model", fit(answers, order=order)))
    got = {r["doc_id"]: r for r in M.score_documents(rows, F.col("learn"), order=order, block_tokens=40, shard_requests=50).collect()}
    model = BackoffModel([t for i, t in enumerate(texts) if i % 3], order, fitted["model"].exponents)
    for i, t in enumerate(texts):
        r = got[i]
        assert r["n_tokens"] == len(tokens(t)) and r["n_known"] == sum(model.counts[0][(w,)] > 0 for w in tokens(t)) and r["train_tokens"] == model.n
        assert r["base_score"] == pytest.approx(sum(math.log10(model.base(w)) for w in tokens(t)))
        assert r["score"] == pytest.approx(model.score(t), rel=1e-9)


def test_probabilities_sum_to_one(spark):
    texts = ["a b a c", "b a a", "c c b a"]
    model = BackoffModel(texts, 2, (0.7,))
    for context in [(), ("a",), ("b",), ("<begin>",), ("nowhere",)]:
        total = sum(model.probability(context, w) for w in ["a", "b", "c", None, "unknown"])
        assert total == pytest.approx(1.0)


def test_scoring_odd_rows(spark, odd_docs, no_docs):
    got = M.score_documents(odd_docs, F.col("doc_id") != 3).collect()
    assert len(got) == 10 and sum(r["doc_id"] is None for r in got) == 2
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 4)} == {1}
    assert all(math.isfinite(r["score"]) for r in got)
    untrained = M.score_documents(odd_docs, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == pytest.approx(r["base_score"]) for r in untrained)
    assert M.score_documents(no_docs, F.lit(True)).count() == 0


def brute_top_k(vectors, is_query, k):
    whole = {i: np.floor(256 * np.array(v, dtype=np.float64)).astype(int) for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in whole:
        if is_query(q):
            scored = sorted((-int(whole[q] @ whole[x]), x) for x in whole if x != q and len(whole[x]) == len(whole[q]))
            out |= {(q, r + 1, x, -s) for r, (s, x) in enumerate(scored[:k])}
    return out


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(V, "SHARES", 3)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 8))
    vectors = [(int(i), (centres[i % 6] + 0.1 * rng.normal(size=8)).tolist()) for i in range(700)]
    vectors += [(i, vectors[3][1]) for i in range(700, 712)]
    vectors += [(800, None), (801, [None] + [1.0] * 7), (802, [math.nan] * 8), (803, [math.inf] * 8), (804, []), (850, [1.0, 2.0]), (900, [1e7] * 8), (901, [0.0] * 8)]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], "vec_id long, embedding array<double>, score string, id string").repartition(4)
    got = V.top_k(frame, F.col("id") % 50 == 0).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == brute_top_k(vectors, lambda q: q % 50 == 0, 5)


def test_few_candidates_and_empty_tables(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, -1.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [9.0, 9.0])], kind)
    got = V.top_k(few, F.col("id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 0), (2, 2, 0)]
    assert V.top_k(spark.createDataFrame([], kind), F.col("id") % 50 == 0).count() == 0


def test_large_components_stay_exact():
    a = np.array([[2**31 + 1, -3], [5, 2**30]])
    q = np.array([2**31 - 1, 2**31 + 7])
    assert V.products(a, q).tolist() == [int(x) for x in a.astype(object) @ q.astype(object)]
