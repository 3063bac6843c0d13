"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartomark.session import materialize

#: Vectors of a sample: half of them give the graph, half set the number of partitions searched.
SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 32 << 20
#: Neighbours of a vector in the graph, and the least vectors of a partition in it.
NEIGHBOURS, LEAST = 16, 32
#: Share of the held-out vectors' neighbours that the partitions searched must hold.
TARGET = 0.95
#: Vectors of a block of candidates, and of queries.
CANDIDATES, QUERIES = 1024, 512


def directions(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; huge and tiny ones too."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest(queries: np.ndarray, candidates: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
    """Places of the ``k`` candidates of largest product for each query, without place ``own`` (-1: none)."""
    found = np.empty((len(queries), k), dtype=np.int64)
    for a in range(0, len(queries), 512):
        part = queries[a : a + 512] @ candidates.T
        mine = np.flatnonzero(own[a : a + 512] >= 0)
        part[mine, own[a : a + 512][mine]] = -np.inf
        found[a : a + 512] = np.argpartition(-part, k - 1, axis=1)[:, :k]
    return found


def bisect(a: np.ndarray, b: np.ndarray, n: int, left: int, seed: int) -> np.ndarray:
    """True for ``left`` of ``n`` nodes, so that few of the links ``a, b`` are cut.

    Nodes are ordered along the graph's slowest mode, by power iteration, and cut
    at the wanted size; then equal numbers of nodes that gain most change sides
    as long as that cuts fewer links.
    """
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1e-9
    root = np.sqrt(degree)
    mode = np.random.default_rng(seed).normal(size=n)
    for _ in range(40):
        mode -= root * (root @ mode) / (root @ root)
        scaled = mode / root
        pushed = np.bincount(a, weights=scaled[b], minlength=n) + np.bincount(b, weights=scaled[a], minlength=n)
        mode = mode + pushed / root
        mode /= np.linalg.norm(mode) + 1e-300
    side = np.zeros(n, dtype=bool)
    side[np.argsort(mode / root, kind="stable")[:left]] = True
    for _ in range(20):
        crossing = np.where(side[a] != side[b], 1.0, -1.0)
        gain = np.bincount(a, weights=crossing, minlength=n) + np.bincount(b, weights=crossing, minlength=n)
        ins, outs = np.flatnonzero(side), np.flatnonzero(~side)
        ins, outs = ins[np.argsort(-gain[ins], kind="stable")], outs[np.argsort(-gain[outs], kind="stable")]
        pairs = min(len(ins), len(outs))
        better = int((gain[ins[:pairs]] + gain[outs[:pairs]] > 0).sum())
        moved = side.copy()
        moved[ins[: (better + 1) // 2]], moved[outs[: (better + 1) // 2]] = False, True
        if not better or (moved[a] != moved[b]).sum() >= (side[a] != side[b]).sum():
            break
        side = moved
    return side


def balanced_partitions(neighbours: np.ndarray, parts: int) -> np.ndarray:
    """A partition for each node of the neighbour graph; their sizes differ by one or two."""
    n, k = neighbours.shape
    a, b = np.repeat(np.arange(n), k), neighbours.ravel()
    out = np.zeros(n, dtype=np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:
        nodes, first, count = todo.pop()
        if count == 1:
            out[nodes] = first
            continue
        here = np.full(n, -1)
        here[nodes] = np.arange(len(nodes))
        inside = (here[a] >= 0) & (here[b] >= 0)
        half = count // 2
        side = bisect(here[a[inside]], here[b[inside]], len(nodes), round(len(nodes) * half / count), first)
        todo += [(nodes[side], first, half), (nodes[~side], first + half, count - half)]
    return out


@dataclass
class Router:
    """A classifier with one hidden layer: probabilities of the partitions from a vector's direction."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            inner = np.maximum(directions(x) @ self.hidden + self.hidden_bias, 0)
            return inner @ self.output + self.output_bias

    def partition(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x).argmax(axis=1)

    def route(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Partitions from the most to the least probable one, and which places of that order are searched.

        Those are the first ``probes``, and further ones until they hold ``least`` vectors.
        """
        order = np.argsort(-self.scores(x), axis=1, kind="stable")
        before = np.cumsum(sizes[order], axis=1) - sizes[order]
        return order, (before < least) | (np.arange(len(sizes)) < self.probes)


def train(x: np.ndarray, targets: np.ndarray, width: int = 128, epochs: int = 30, seed: int = 0) -> Router:
    """Fit the classifier to the partitions of each vector's neighbours, by Adam steps on cross-entropy."""
    rng = np.random.default_rng(seed)
    x = directions(x)
    n, d = x.shape
    p = targets.shape[1]
    weights = [rng.normal(size=(d, width)) * np.sqrt(2), np.zeros(width), rng.normal(size=(width, p)) / np.sqrt(width), np.zeros(p)]
    means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, total = 0, epochs * math.ceil(n / 256)
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            part = order[at : at + 256]
            step += 1
            inner = np.maximum(x[part] @ weights[0] + weights[1], 0)
            out = inner @ weights[2] + weights[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - targets[part]) / len(part)
            back = (error @ weights[2].T) * (inner > 0)
            slopes = [x[part].T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0)]
            rate = 0.01 * (1 - step / (total + 1))
            for w, g, m, s in zip(weights, slopes, means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= rate * (m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8) + 1e-3 * w)
    return Router(*weights)


def fit(sample: np.ndarray, parts: int, k: int, target: float = TARGET) -> Router | None:
    """Router over ``parts`` balanced partitions of the graph of half the sample; none where it is too small.

    The other half, which the router has not seen, is both queries and candidates of the
    search for the least number of partitions that hold ``target`` of the true ``k`` nearest.
    """
    sample = np.unique(sample, axis=0)
    sample = sample[np.random.default_rng(0).permutation(len(sample))]
    learn, held = sample[::2], sample[1::2]
    parts = min(parts, len(learn) // LEAST)
    if parts < 2:
        return None
    near = nearest(learn, learn, min(NEIGHBOURS, len(learn) - 1), np.arange(len(learn)))
    part_of = balanced_partitions(near, parts)
    targets = np.zeros((len(learn), parts))
    for column in (np.arange(len(learn)), *near.T):
        np.add.at(targets, (np.arange(len(learn)), part_of[column]), 1 / (near.shape[1] + 1))
    router = train(learn, targets)
    asked = np.arange(min(len(held), 1024))
    true = nearest(held[asked], held, min(k, len(held) - 1), asked)
    rank = np.argsort(np.argsort(-router.scores(held[asked]), axis=1, kind="stable"), axis=1)
    ranks = np.take_along_axis(rank, router.partition(held)[true], axis=1).ravel()
    reached = np.cumsum(np.bincount(ranks, minlength=parts)) / len(ranks)
    router.probes = int(np.searchsorted(reached, target) + 1) if reached[-1] >= target else parts
    return router


def usable(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix, by dimension, of the vectors that take part."""
    rows: dict[int, list[int]] = {}
    values: dict[int, list[np.ndarray]] = {}
    for i, vector in enumerate(vectors):
        if not vector.is_valid or vector.values.null_count or not len(vector.values):
            continue
        x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            rows.setdefault(len(x), []).append(i)
            values.setdefault(len(x), []).append(x)
    numbers = ids.to_numpy(zero_copy_only=False)
    for dim, places in rows.items():
        yield numbers[places], np.vstack(values[dim])


def products(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products added up from the first component on, so that equal rows give equal bits."""
    total = np.zeros(len(matrix))
    with np.errstate(all="ignore"):
        for column, v in zip(matrix.T, vector, strict=True):
            total += column * v
    return np.where(np.isnan(total), -np.inf, total)


def best_in(ids: np.ndarray, matrix: np.ndarray, qids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's ``k`` best candidates of a block that score its floor or more, by exact products.

    Candidates are first screened by a matrix product, whose rounding is allowed for.
    """
    with np.errstate(all="ignore"):
        rough = queries @ matrix.T
        slack = 1e-12 * matrix.shape[1] * np.abs(queries).max(axis=1) * np.abs(matrix).max()
    for row, qid, q, floor, s in zip(rough, qids, queries, floors, slack, strict=True):
        limit = floor
        if len(row) > k + 1:
            # One more than k, as the query may be among them.
            limit = max(limit, np.partition(row, -k - 1)[-k - 1] - s)
        at = np.flatnonzero(~(row < limit - s) & (ids != qid))
        if len(at):
            exact = products(matrix[at], q)
            at, exact = at[exact >= floor], exact[exact >= floor]
            keep = np.lexsort((ids[at], -exact))[:k]
            yield int(qid), ids[at][keep], exact[keep]


def reached(queries: np.ndarray, sample: np.ndarray, searched: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that ``k`` sampled vectors among those ``searched`` reach, the query aside."""
    if len(sample) <= k:
        return np.full(len(queries), -np.inf)
    with np.errstate(all="ignore"):
        rough = np.where(searched, queries @ sample.T, -np.inf)
        # One more than k, as the query itself may be in the sample.
        floors = np.partition(rough, -k - 1, axis=1)[:, -k - 1] - 1e-12 * queries.shape[1] * np.abs(queries).max(axis=1) * np.abs(sample).max()
    return np.where(np.isnan(floors), -np.inf, floors)


def parsed(rows: pa.Scalar) -> tuple[np.ndarray, ...]:
    """Columns of a list of structs of numbers and one binary vector, the last as a matrix."""
    fields = rows.values
    numbers = [fields.field(i).to_numpy(zero_copy_only=False) for i in range(fields.type.num_fields - 1)]
    joined = b"".join(v.as_py() for v in fields.field(fields.type.num_fields - 1))
    return *numbers, np.frombuffer(joined, "<f8").reshape(len(fields), -1)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    target: float = TARGET,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, by inner product in doubles.

    Every vector goes to the partition that the router holds most probable for
    it; a query is compared, exactly, with all vectors of its most probable
    partitions. How many those are is the least that held ``target`` of the true
    neighbours in the sample, and more where they hold too few vectors. Scores are
    sums in the order of the components; ties go to the smaller id. Queries with
    fewer than ``k`` candidates get all of them. ``is_query`` may use ``id``; a
    query is never its own candidate.

    Vectors that are null, empty or zero, or hold null or non-finite components,
    and rows without an id, take no part. Only vectors of one length are
    compared, the 64 most frequent lengths with a router each; other lengths, and
    those with few vectors, are one partition, searched whole. A sum that is no number counts as minus
    infinity. Rows repeating an id are candidates each; as queries they count once,
    with the smallest vector. Other columns are ignored; empty tables give no rows.

    The router is fitted in the driver on ``sample_rows`` vectors at most, of
    ``SAMPLE_BYTES`` at most, whatever the table's size; all rows are indexed.
    Partitions are cut into blocks, so that one of any size, say of copies of one vector, is
    searched by many tasks.
    """

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in usable(batch.column(0), batch.column(1)):
                dims = pa.array(np.full(len(ids), matrix.shape[1], dtype=np.int32))
                raw = pa.array([v.astype("<f8").tobytes() for v in matrix], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), dims, raw], ["id", "dim", "v"])

    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector")).where("id is not null")
    flat = materialize(named.mapInArrow(flatten, "id long, dim int, v binary"), "vectors")

    # The least hashes of the ids, among about twice as many as are wanted.
    sizes = {r["dim"]: r["n"] for r in flat.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(64).collect()}
    routers: dict[int, Router | None] = {}
    samples: dict[int, np.ndarray] = {}
    for dim, n in sizes.items():
        wanted = min(sample_rows, SAMPLE_BYTES // (8 * dim))
        share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= min(1.0, 2 * wanted / n) * (1 << 30)
        few = flat.where((F.col("dim") == dim) & share).orderBy(F.xxhash64("id"), "id", "v").limit(wanted).select("v").toArrow()
        samples[dim] = np.frombuffer(b"".join(few.column(0).to_pylist()), "<f8").reshape(-1, dim)
        routers[dim] = fit(samples[dim], math.ceil(math.sqrt(n) / 4), k, target)

    def rows_by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        dims = batch.column(1).to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            raw = b"".join(batch.column(2).take(pa.array(at)).to_pylist())
            yield int(dim), at, np.frombuffer(raw, "<f8").reshape(len(at), int(dim))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = np.zeros(batch.num_rows, dtype=np.int32)
            for dim, at, matrix in rows_by_dim(batch):
                if routers.get(dim):
                    parts[at] = routers[dim].partition(matrix)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts)], ["id", "dim", "v", "part"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and partition it searches, with a score that k others there reach."""
        places = {dim: r.partition(samples[dim]) for dim, r in routers.items() if r}
        for batch in batches:
            for dim, at, matrix in rows_by_dim(batch):
                router = routers.get(dim)
                for a in range(0, len(at), QUERIES):
                    some, own = matrix[a : a + QUERIES], at[a : a + QUERIES]
                    routed, floors = np.zeros(len(some), dtype=np.int64), np.full(len(some), -np.inf)
                    probes = np.ones(len(some), dtype=np.int64)
                    if router:
                        order, searched = router.route(some, held[dim], k + 1)
                        routed, probes = order[searched], searched.sum(axis=1)
                        by_part = np.zeros_like(searched)
                        np.put_along_axis(by_part, order, searched, axis=1)
                        floors = reached(some, samples[dim], by_part[:, places[dim]], k)
                    taken = pa.array(np.repeat(own, probes))
                    columns = [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(routed.astype(np.int32)), pa.array(np.repeat(floors, probes)), batch.column(2).take(taken)]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "dim", "part", "floor", "v"])

    # The number of a row deals copies of one row, too, to many blocks.
    numbered = flat.mapInArrow(assign, "id long, dim int, v binary, part int").withColumn("row", F.monotonically_increasing_id())
    index = materialize(numbered, "index")
    filled = index.groupBy("dim", "part").agg(F.count(F.lit(1)).alias("n"))
    blocks = filled.select("dim", "part", F.ceil(F.col("n") / CANDIDATES).cast("int").alias("blocks"))
    # A number for each partition of a router, so of bounded size.
    held = {dim: np.zeros(len(r.output_bias), dtype=np.int64) for dim, r in routers.items() if r}
    for r in filled.where(F.col("dim").isin(list(held))).collect():
        held[r["dim"]][r["part"]] = r["n"]
    candidates = (
        index.join(blocks, ["dim", "part"])
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        .groupBy("dim", "part", "block")
        .agg(F.collect_list(F.struct("id", "v")).alias("c"))
    )
    asked = flat.where(is_query).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.dim", "q.v")
    routed = materialize(asked.mapInArrow(route, "id long, dim int, part int, floor double, v binary"), "queries")
    groups = routed.groupBy("dim", "part").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("groups"))
    packed = (
        routed.join(groups, ["dim", "part"])
        .groupBy("dim", "part", F.pmod(F.xxhash64("id"), F.col("groups")).alias("group"))
        .agg(F.collect_list(F.struct("id", "floor", "v")).alias("q"))
        .join(blocks, ["dim", "part"])
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, q in zip(batch.column(0), batch.column(1), strict=True):
                ids, matrix = parsed(c)
                qids, floors, queries = parsed(q)
                found = list(best_in(ids, matrix, qids, queries, floors, k))
                if found:
                    owners = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
                    columns = [pa.array(owners), pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    # Copies of a query block compress so well that their shuffled size would pass
    # for small; a merge join keeps them from being broadcast.
    pairs = candidates.join(packed.select("dim", "part", "block", "q").hint("merge"), ["dim", "part", "block"]).select("c", "q")
    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
