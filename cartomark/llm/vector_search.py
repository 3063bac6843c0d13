"""Exact top-k inner products with pivot-table elimination."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartomark.session import materialize

#: Sampled vectors: the pivots are among them, and they give every query a first bound.
SAMPLE, PIVOTS = 256, 32
#: Queries compared with a block of candidates in one step, and candidates of a step.
QUERY_BLOCK, CHUNK = 512, 256
#: Shares of the candidate blocks that each query block meets in separate tasks.
SHARES = 32


def quantised(vectors: pa.Array, scale: float) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Rows and integer matrices by dimension of the vectors that take part."""
    rows: dict[int, list[int]] = {}
    values: dict[int, list[np.ndarray]] = {}
    for i, vector in enumerate(vectors):
        if not vector.is_valid or vector.values.null_count or not len(vector.values):
            continue
        x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
        if np.isfinite(x).all() and np.abs(x).max() < 2**62:
            rows.setdefault(len(x), []).append(i)
            values.setdefault(len(x), []).append(x.astype(np.int64))
    return {d: np.array(r) for d, r in rows.items()}, {d: np.vstack(v) for d, v in values.items()}


def products(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floating point only where it is exact."""
    if float(np.abs(matrix).max(initial=0)) * float(np.abs(vector).max(initial=0)) * len(vector) < 2**53:
        return (matrix.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
    return (matrix.astype(object) @ vector.astype(object)).astype(np.int64)


def distances(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table: Euclidean distances of every row to every pivot."""
    a, p = matrix.astype(np.float64), pivots.astype(np.float64)
    squared = (a * a).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * a @ p.T
    return np.sqrt(np.maximum(squared, 0.0))


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    keep = np.lexsort((ids, -scores))[:k]
    return ids[keep], scores[keep]


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, matrix: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The best ``k`` candidates of one block for each query.

    For a pivot p, ``|d(q,p) - d(x,p)|`` is a lower bound of ``d(q,x)``; the
    largest over all pivots gives an upper bound of the inner product. Candidates
    are evaluated in the order of that bound until it falls below the k-th score
    at hand, which starts from the sample.
    """
    pivots = sample[:PIVOTS]
    table = distances(matrix, pivots)
    of_queries = distances(queries, pivots)
    norms = (matrix.astype(np.float64) ** 2).sum(1)
    for qid, q, to_pivots in zip(query_ids, queries, of_queries, strict=True):
        norm = float((q.astype(np.float64) ** 2).sum())
        if len(pivots):
            gap = np.zeros(len(ids))
            for column, d in zip(table.T, to_pivots, strict=True):
                np.maximum(gap, np.abs(column - d), out=gap)
            # Rounding of distances must never hide a candidate.
            slack = 1e-6 * (norm + norms) + 1.0
            bound = (norm + norms - gap * gap) / 2 + slack
        else:
            bound = np.full(len(ids), np.inf)
        known = products(sample, q)[sample_ids != qid] if len(sample) else np.empty(0, np.int64)
        floor = float(np.sort(known)[-k]) if len(known) >= k else -math.inf
        order = np.flatnonzero((bound >= floor) & (ids != qid))
        order = order[np.argsort(-bound[order], kind="stable")]
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(order), CHUNK):
            if bound[order[at]] < floor:
                break
            part = order[at : at + CHUNK]
            best_ids, best = best_of(np.append(best_ids, ids[part]), np.append(best, products(matrix[part], q)), k)
            if len(best) == k:
                floor = max(floor, float(best[-1]))
        yield qid, best_ids, best


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products.

    Components become ``floor(scale * x)``; scores are integers; ties go to the
    smaller id; a query is never its own candidate. ``is_query`` may use ``id``.
    Queries with fewer candidates return all of them.

    Vectors that are null or empty, or hold null, non-finite or, once scaled,
    out-of-range components, and rows without an id, take no part. Only vectors of
    one length are compared. Rows repeating an id are candidates each; as queries
    they count once, with the smallest vector. Other columns are ignored.

    Candidates are packed in blocks and every query block meets every candidate
    block once, in a task of its own; a sample of fixed size is all that each
    task receives besides.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrices = quantised(batch.column(1), scale)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for dim, matrix in matrices.items():
                for a in range(0, len(matrix), 4096):
                    part = slice(a, a + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([dim], pa.int32()),
                            pa.array([ids[rows[dim][part]].astype("<i8").tobytes()]),
                            pa.array([matrix[part].astype("<i8").tobytes()]),
                        ],
                        ["dim", "ids", "matrix"],
                    )

    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector")).where("id is not null")
    blocks = materialize(named.mapInArrow(pack, "dim int, ids binary, matrix binary"), "blocks")

    few = named.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().combine_chunks()
    sample: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    if few.num_rows:
        rows, matrices = quantised(few.column("vector").combine_chunks(), scale)
        unique_ids = few.column("id").to_numpy()
        sample = {d: (unique_ids[rows[d]], m) for d, m in matrices.items()}

    def pack_queries(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for dim, of_dim in group.groupby("dim", sort=True):
            for a in range(0, len(of_dim), QUERY_BLOCK):
                part = of_dim.iloc[a : a + QUERY_BLOCK]
                parts.append((dim, part["id"].to_numpy(dtype="<i8").tobytes(), b"".join(part["v"])))
        return pd.DataFrame(parts, columns=["qdim", "qids", "qmatrix"])

    def vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrices = quantised(batch.column(1), scale)
            for dim, matrix in matrices.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[dim])),
                        pa.array([dim] * len(matrix), pa.int32()),
                        pa.array([v.astype("<i8").tobytes() for v in matrix], pa.binary()),
                    ],
                    ["id", "dim", "v"],
                )

    asked = (
        named.where(is_query).mapInArrow(vector_rows, "id long, dim int, v binary").groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.*")
    )
    asked = materialize(asked, "queries")
    parts = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    packed = (
        asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(pack_queries, "qdim int, qids binary, qmatrix binary")
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    )
    dealt = blocks.withColumn("share", F.pmod(F.xxhash64("ids"), F.lit(SHARES)).cast("int"))
    # Copies of a query block compress so well that their shuffled size would pass
    # for small; a merge join keeps them from being broadcast.
    pairs = dealt.join(packed.hint("merge"), (F.col("dim") == F.col("qdim")) & (dealt["share"] == packed["share"]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, matrix, qids, queries in zip(*(batch.column(c) for c in range(5)), strict=True):
                d = dim.as_py()
                ids, qids = np.frombuffer(ids.as_py(), "<i8"), np.frombuffer(qids.as_py(), "<i8")
                matrix = np.frombuffer(matrix.as_py(), "<i8").reshape(-1, d)
                queries = np.frombuffer(queries.as_py(), "<i8").reshape(-1, d)
                known = sample.get(d, (np.empty(0, np.int64), np.empty((0, d), np.int64)))
                found = list(search_block(qids, queries, ids, matrix, *known, k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                        pa.array(np.concatenate([f[1] for f in found])),
                        pa.array(np.concatenate([f[2] for f in found])),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    found = pairs.select("dim", "ids", "matrix", "qids", "qmatrix").mapInArrow(search, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
