import math

import numpy as np
from pyspark.sql import functions as F

from cartomark.llm import partition_index as N

KIND = "vec_id long, embedding array<double>, id string, vector string, part string"


def exact(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


def brute(vectors, is_query, k):
    """Every query's k nearest as (vec_id, score), by a plain loop over all vectors."""
    whole = [(i, v) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in whole:
        if is_query(q) and (q not in out or len(v) < len(out[q][0]) or v < out[q][0]):
            scored = sorted((-exact(v, x), i) for i, x in whole if i != q and len(x) == len(v))
            out[q] = (v, [(i, -s) for s, i in scored[:k]])
    return {q: found for q, (_, found) in out.items()}


def searched(frame, is_query, **more):
    out = {}
    for r in sorted(N.nearest_neighbours(frame, is_query, **more).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def frame_of(spark, vectors, parts=4):
    return spark.createDataFrame([(i, v, "i", "v", "p") for i, v in vectors], KIND).repartition(parts)


def recall(got, want):
    assert got.keys() <= want.keys()
    for q, found in got.items():
        scores = {i: s for i, s in want[q]}
        assert all(scores.get(i, s) == s for i, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0])) and len({i for i, _ in found}) == len(found)
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in found}) / len(found) for q, found in want.items() if found])


def test_recall_on_clusters_and_share_searched(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    vectors = [(int(i), (centres[i % 40] + 0.3 * rng.normal(size=16)).tolist()) for i in range(3000)]
    got = searched(frame_of(spark, vectors), F.col("id") % 20 == 0)
    assert recall(got, brute(vectors, lambda q: q % 20 == 0, 20)) >= 0.9
    router = N.fit(np.array([v for _, v in vectors]), 14, 20)
    assert router.probes <= 5


def test_recall_on_directions_without_structure(spark):
    rng = np.random.default_rng(5)
    vectors = [(int(i), v.tolist()) for i, v in enumerate(N.directions(rng.normal(size=(2500, 32))))]
    got = searched(frame_of(spark, vectors), F.col("id") % 50 == 0)
    assert recall(got, brute(vectors, lambda q: q % 50 == 0, 20)) >= 0.9


def test_copies_of_one_vector_tie_to_the_smallest_ids(spark):
    rng = np.random.default_rng(6)
    vectors = [(int(i), rng.normal(size=8).tolist()) for i in range(1500)]
    vectors = [(i, vectors[7][1] if i % 3 == 0 else v) for i, v in vectors]
    got = searched(frame_of(spark, vectors), F.col("id") % 60 == 0)
    want = brute(vectors, lambda q: q % 60 == 0, 20)
    # Every query is a copy and its best are the other copies.
    assert all(got[q] == found for q, found in want.items() if found[0][1] == found[-1][1])


def test_small_tables_are_searched_whole_and_odd_vectors_left_out(spark):
    rng = np.random.default_rng(7)
    vectors = [(i, rng.normal(size=4).tolist()) for i in range(30)]
    vectors += [(40, None), (60, []), (80, [0.0] * 4), (100, [None, 1.0, 1.0, 1.0]), (120, [math.nan] * 4), (140, [math.inf] * 4), (None, [9.0] * 4), (160, [1.0, 2.0]), (180, [1e200, 0.0, 0.0, 1.0])]
    vectors += [(20, vectors[20][1]), (3, vectors[4][1])]
    got = searched(frame_of(spark, vectors), F.col("id") % 20 == 0)
    want = brute(vectors, lambda q: q % 20 == 0, 20)
    assert {q: f for q, f in want.items() if f} == got
    few = frame_of(spark, vectors[:6])
    assert searched(few, F.col("id") == 0) == brute(vectors[:6], lambda q: q == 0, 20)
    assert searched(frame_of(spark, []), F.col("id") == 0) == {}


def test_partitions_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(8)
    x = N.directions(np.repeat(rng.normal(size=(8, 12)), 60, axis=0) + 0.2 * rng.normal(size=(480, 12)))
    near = N.nearest(x, x, 10, np.arange(480))
    part = N.balanced_partitions(near, 7)
    sizes = np.bincount(part, minlength=7)
    assert sizes.sum() == 480 and sizes.max() - sizes.min() <= 2
    assert (part[near] != part[:, None]).mean() < 0.35


def test_equal_rows_give_equal_bits():
    rng = np.random.default_rng(9)
    row, q = rng.normal(size=64), rng.normal(size=64)
    got = N.products(np.vstack([row] * 37), q)
    assert len(set(got.tolist())) == 1 and got[0] == exact(row.tolist(), q.tolist())
