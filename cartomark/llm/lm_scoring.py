"""Language-model scoring with a weighted backoff automaton.

The model is never held in one place. Documents are read into blocks; each block
asks, in one shuffle keyed by n-gram hash, for the training counts of just its
own n-grams, builds the part of the automaton that its texts can reach, and
traverses it. Memory of a task is bounded by a block or by a shard of requests;
both numbers grow with the corpus, their sizes do not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.llm.common import slices
from cartomark.session import materialize

#: Tokens of a block; a longer text is a block of its own.
BLOCK_TOKENS = 250_000
#: Requests a shard answers in one task.
SHARD_REQUESTS = 1_500_000
#: Local ids of the two marks that are no words.
BEGIN, END = 0, 1
BLOCKS = "block long, doc_ids binary, known binary, trained binary, lengths binary, tokens binary, words binary"


def squeeze(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: sorted or small values take little room."""
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T if len(values) else np.empty(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hash of its beginning and of its last token."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


@dataclass
class Ngrams:
    """The n-grams of a block by order; every order has its own types.

    ``at[k]`` is the type of the (k+1)-gram that ends at each position, or -1
    where it would reach over a text's beginning. Per type: hash, one position
    where it ends, and how often it ends in a training text.
    """

    at: list[np.ndarray]
    hashes: list[np.ndarray]
    where: list[np.ndarray]
    trained: list[np.ndarray]


@dataclass
class Block:
    """Texts as token ids; each text is BEGIN, its words, END."""

    ids: np.ndarray
    known: np.ndarray
    trained: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    words: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        return cls(
            unsqueeze(row["doc_ids"], "<i8"),
            unsqueeze(row["known"], "u1").astype(bool),
            unsqueeze(row["trained"], "u1").astype(bool),
            unsqueeze(row["lengths"], "<i8"),
            unsqueeze(row["tokens"], "<i4"),
            unsqueeze(row["words"], "<u8"),
        )

    def ngrams(self, order: int) -> Ngrams:
        place = np.arange(len(self.tokens)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        learn = np.repeat(self.trained, self.lengths)
        at, hashes, where, trained = [], [], [], []
        for k in range(order):
            if k == 0:
                types, first = np.arange(len(self.words)), np.full(len(self.words), -1)
                first[self.tokens[::-1]] = np.arange(len(self.tokens))[::-1]
                inverse, h = self.tokens.astype(np.int64), self.words
            else:
                fits = place >= k
                # (type of the beginning, last token) names the n-gram inside the block.
                pair = np.where(fits, (np.concatenate([[-1], at[-1][:-1]]) << 32) | self.tokens, -1)
                types, first, inverse = np.unique(pair, return_index=True, return_inverse=True)
                if len(types) and types[0] == -1:
                    types, first, inverse = types[1:], first[1:], inverse - 1
                h = combine(hashes[-1][types >> 32], self.words[types & 0xFFFFFFFF])
            at.append(inverse)
            hashes.append(h)
            where.append(first)
            trained.append(np.bincount(inverse[learn & (inverse >= 0)], minlength=len(types)))
        return Ngrams(at, hashes, where, trained)


def read_blocks(docs: DataFrame, is_training: Column, *, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Documents packed into blocks of token ids, written once."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        number = 0
        for batch in slices(batches, 2, 8 << 20):
            lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column(2), "")))
            flat = pc.list_flatten(lists)
            words_of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
            coded = flat.dictionary_encode()
            word = coded.indices.to_numpy(zero_copy_only=False)[filled].astype(np.int64)
            words_of = words_of[filled]
            vocabulary = coded.dictionary
            lengths = np.bincount(words_of, minlength=batch.num_rows) + 2
            ends = np.cumsum(lengths)
            tokens = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
            tokens[ends - lengths], tokens[ends - 1] = -2, -1
            tokens[np.arange(len(word)) + 2 * words_of + 1] = word
            cut = 0
            while cut < batch.num_rows:
                base = ends[cut] - lengths[cut]
                stop = max(cut + 1, int(np.searchsorted(ends, base + block_tokens, side="right")))
                part = tokens[base : ends[stop - 1]]
                used, local = np.unique(part, return_inverse=True)
                # -2 and -1 sort first: the marks are 0 and 1 in every block.
                hashes = [xxhash.xxh64_intdigest(vocabulary[int(u)].as_buffer()) for u in used[2:]]
                marks = [xxhash.xxh64_intdigest(m, seed=1) for m in (b"begin", b"end")]
                ids = batch.column(0).slice(cut, stop - cut)
                row = [
                    squeeze(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8")),
                    squeeze(pc.is_valid(ids).to_numpy(zero_copy_only=False).astype("u1")),
                    squeeze(batch.column(1).slice(cut, stop - cut).to_numpy(zero_copy_only=False).astype("u1")),
                    squeeze(lengths[cut:stop].astype("<i8")),
                    squeeze(local.astype("<i4")),
                    squeeze(np.array(marks + hashes, dtype="<u8")),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task + number]), *(pa.array([v], pa.binary()) for v in row)],
                    ["block", "doc_ids", "known", "trained", "lengths", "tokens", "words"],
                )
                number += 1
                cut = stop

    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(is_training, F.lit(False)).alias("trained"), F.col(f"`{text_col}`").alias("text")
    )
    return materialize(source.mapInArrow(blocks, BLOCKS), "blocks")


def count_ngrams(blocks: DataFrame, *, order: int, shards: int) -> DataFrame:
    """Corpus counts of each block's n-grams: ``block, gram_order, shard, totals``.

    A block sends each shard the sorted hashes of its n-gram types and their
    counts in its training texts; the shard adds up equal hashes over all blocks
    and sends every block its totals, in the order of the request. Shards are
    ranges of the hash, and a block sends a type once, so no n-gram is heavy.
    Alongside, a shard reports how many types it holds, by logarithm of the count.
    """
    width = 64 - (shards - 1).bit_length()

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = Block.read(row).ngrams(order)
                out = []
                for k in range(order):
                    sort = np.argsort(grams.hashes[k])
                    keys, counts = grams.hashes[k][sort], grams.trained[k][sort]
                    edges = shard_edges(keys, shards, width)
                    for s in range(shards):
                        a, b = edges[s], edges[s + 1]
                        if b > a:
                            out.append((s * order + k, row["block"], squeeze(np.diff(keys[a:b], prepend=np.uint64(0))), squeeze(counts[a:b].astype("<i4"))))
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], ["part", "block", "keys", "counts"]
                )

    def totals(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        keys = [np.cumsum(unsqueeze(k.as_py(), "<u8"), dtype=np.uint64) for k in group.column("keys")]
        counts = np.concatenate([unsqueeze(c.as_py(), "<i4") for c in group.column("counts")]).astype(np.int64)
        types, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(types)).astype(np.int64)
        answers = np.split(total[inverse], np.cumsum([len(k) for k in keys])[:-1])
        seen = total[total > 0]
        octaves = np.bincount(np.log2(seen).astype(np.int64), minlength=1)
        n = group.num_rows
        return pa.table(
            {
                "block": group.column("block"),
                "part": pa.array([part] * n, pa.int32()),
                "totals": pa.array([squeeze(a.astype("<i8")) for a in answers], pa.binary()),
                # One row of each shard carries its statistics.
                "octaves": pa.array([octaves.tolist()] + [None] * (n - 1), pa.list_(pa.int64())),
                "tokens": pa.array([int(seen.sum())] + [None] * (n - 1), pa.int64()),
            }
        )

    asked = blocks.mapInArrow(requests, "part int, block long, keys binary, counts binary")
    return asked.groupBy("part").applyInArrow(totals, "block long, part int, totals binary, octaves array<long>, tokens long")


def shard_edges(keys: np.ndarray, shards: int, width: int) -> np.ndarray:
    """Where each shard's range begins in sorted hashes."""
    if shards == 1:
        return np.array([0, len(keys)])
    starts = np.arange(shards, dtype=np.uint64) << np.uint64(width)
    return np.append(np.searchsorted(keys, starts), len(keys))


@dataclass(frozen=True)
class Smoothing:
    """Corpus figures and, per order, the exponent of unseen mass (see :func:`fit`)."""

    tokens: int
    types: int
    exponents: tuple[float, ...]

    def unseen(self, count: np.ndarray, order: int) -> np.ndarray:
        """Mass an n-gram context seen ``count`` times leaves to shorter contexts."""
        return 0.9 * np.power(np.maximum(count, 1).astype(float), self.exponents[order] - 1.0)


def fit(answers: DataFrame, *, order: int) -> Smoothing:
    """Smoothing from whole-corpus counts.

    A context seen c times is followed by about c**b distinct tokens (Heaps'
    law); b solves sum(c**b) = number of (k+1)-gram types over the corpus's own
    histogram of context counts. As in absolute discounting, 0.9 counts of each
    distinct follower go to the shorter context: the share 0.9 * c**(b - 1).
    """
    stats = (
        answers.where("octaves is not null")
        .select(F.pmod("part", F.lit(order)).alias("k"), "tokens", F.posexplode("octaves").alias("octave", "n"))
        .groupBy("k", "octave")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("octave") == 0, F.col("tokens"))).alias("tokens"))
        .collect()
    )
    types = [sum(r["n"] for r in stats if r["k"] == k) for k in range(order)]
    tokens = sum(r["tokens"] or 0 for r in stats if r["k"] == 0)
    exponents = []
    for k in range(order - 1):
        low, high = 0.0, 1.0
        for _ in range(50):
            b = (low + high) / 2
            # An octave's counts lie around 1.4 times its beginning, but for the first, which is 1.
            grown = sum(r["n"] * (1.0 if r["octave"] == 0 else 1.4 * 2.0 ** r["octave"]) ** b for r in stats if r["k"] == k)
            low, high = (b, high) if grown < types[k + 1] else (low, b)
        exponents.append(low)
    return Smoothing(tokens, types[0], tuple(exponents))


class Automaton:
    """States are the n-grams a block can reach, arcs their seen continuations.

    An arc carries log10 of the smoothed probability and leads to the longest
    n-gram the next state may be; a state without an arc for a token pays its
    backoff weight and fails over to the state of its ending, at last to the
    empty one, where every known token has an arc and any other pays the base.
    """

    def __init__(self, block: Block, grams: Ngrams, counts: list[np.ndarray], model: Smoothing, begins: int):
        order = len(counts)
        n, v = model.tokens - begins, model.types - (1 if begins else 0)
        base = (counts[0] + 0.5) / (n + 0.5 * (v + 1))
        self.base_of_token = np.log10(base)
        self.unknown = math.log10(0.5 / (n + 0.5 * (v + 1)))
        # State numbers: 0 is empty, then every type of the orders below the last.
        first = np.cumsum([1, *(len(c) for c in counts[: order - 1])])
        weights = [base]
        back, fail = [np.zeros(1)], [np.zeros(1, np.int64)]
        self.arcs: dict[int, int] = {}
        self.weight: list[float] = []
        self.target: list[int] = []
        self.scale = len(block.words)
        for k in range(order):
            seen = np.flatnonzero(counts[k] > 0) if k else np.flatnonzero((counts[0] > 0) & (np.arange(len(counts[0])) != BEGIN))
            ending = grams.at[k - 1][grams.where[k]] if k else np.zeros(len(counts[0]), np.int64)
            token = block.tokens[grams.where[k]].astype(np.int64) if k else np.arange(len(counts[0]))
            if k:
                context = grams.at[k - 1][grams.where[k] - 1]
                c = counts[k - 1][context]
                left = model.unseen(c, k - 1)
                seen = seen[c[seen] > 0]
                weights.append((1 - left) * counts[k] / np.maximum(c, 1) + left * weights[k - 1][ending])
            state = first[k - 1] + grams.at[k - 1][grams.where[k] - 1] if k else np.zeros(len(counts[0]), np.int64)
            if k < order - 1:
                target = first[k] + np.arange(len(counts[k]))
                back.append(np.log10(model.unseen(counts[k], k)))
                fail.append(first[k - 1] + ending if k else np.zeros(len(counts[0]), np.int64))
            else:
                target = first[k - 1] + ending if k else np.zeros(len(counts[0]), np.int64)
            at = len(self.weight)
            self.arcs.update(zip((state[seen] * self.scale + token[seen]).tolist(), range(at, at + len(seen)), strict=True))
            self.weight += np.log10(weights[k][seen]).tolist()
            self.target += target[seen].tolist()
        self.back = np.concatenate(back).tolist()
        self.fail = np.concatenate(fail).tolist()
        self.start = int(first[0]) + BEGIN if order > 1 and counts[0][BEGIN] > 0 else 0

    def score(self, tokens: list[int]) -> float:
        """log10 probability of a text's words and end, left to right."""
        arcs, weight, target, back, fail, scale = self.arcs, self.weight, self.target, self.back, self.fail, self.scale
        state, total = self.start, 0.0
        for token in tokens:
            arc = arcs.get(state * scale + token)
            while arc is None and state:
                total += back[state]
                state = fail[state]
                arc = arcs.get(state * scale + token)
            if arc is None:
                total += self.unknown
            else:
                total += weight[arc]
                state = target[arc]
        return total


def score_documents(
    docs: DataFrame,
    is_training: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 2,
    block_tokens: int = BLOCK_TOKENS,
    shard_requests: int = SHARD_REQUESTS,
) -> DataFrame:
    """Train on the rows ``is_training`` marks and score every row.

    Returns ``doc_id, n_tokens, n_known, train_tokens, base_score, score``, one
    row per input row. Tokens are words between ASCII white space, A-Z
    lower-cased, and one end. ``base_score`` is the add-half unigram model,
    ``score`` the backoff model over n-grams up to ``order``; both are log10 and
    count the end. Null texts are empty: only their end is scored. A null id
    stays null, and ``is_training`` null is false; repeated rows count as often
    as they stand there. Other columns are ignored. Without training rows every
    token is unknown; an empty table gives an empty table.
    """
    blocks = read_blocks(docs, is_training, id_col=id_col, text_col=text_col, block_tokens=block_tokens)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Block.read(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(b.tokens) for b in found], pa.int64()), pa.array([int(b.trained.sum()) for b in found], pa.int64())], ["tokens", "begins"]
            )

    # Begins are training texts; they are counted as tokens of the first order only as a context.
    size = blocks.mapInArrow(sizes, "tokens long, begins long").agg(F.sum("tokens"), F.sum("begins")).first()
    tokens, begins = size[0] or 0, size[1] or 0
    shards = 1 << max(3, math.ceil(math.log2(max(1, tokens / shard_requests))))
    answers = materialize(count_ngrams(blocks, order=order, shards=shards), "counts")
    model = fit(answers, order=order)
    width = 64 - (shards - 1).bit_length()

    def scored(_key, rows: pa.Table, answered: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []}
        parts = {p.as_py(): t.as_py() for p, t in zip(answered.column("part"), answered.column("totals"), strict=True)}
        for row in rows.to_pylist():
            block = Block.read(row)
            grams = block.ngrams(order)
            counts = []
            for k in range(order):
                sort = np.argsort(grams.hashes[k])
                total = np.zeros(len(sort), np.int64)
                edges = shard_edges(grams.hashes[k][sort], shards, width)
                for s in range(shards):
                    if edges[s + 1] > edges[s]:
                        total[sort[edges[s] : edges[s + 1]]] = unsqueeze(parts[s * order + k], "<i8")
                counts.append(total)
            automaton = Automaton(block, grams, counts, model, begins)
            ends = np.cumsum(block.lengths)
            base = np.concatenate([[0.0], np.cumsum(automaton.base_of_token[block.tokens])])
            known = np.concatenate([[0], np.cumsum(counts[0][block.tokens] > 0)])
            for i, (length, end) in enumerate(zip(block.lengths.tolist(), ends.tolist(), strict=True)):
                a = end - length + 1
                out["doc_id"].append(int(block.ids[i]) if block.known[i] else None)
                out["n_tokens"].append(length - 1)
                out["n_known"].append(int(known[end] - known[a]))
                out["base_score"].append(math.fsum(automaton.base_of_token[block.tokens[a:end]].tolist()) if length < 64 else float(base[end] - base[a]))
                out["score"].append(automaton.score(block.tokens[a:end].tolist()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    answered = answers.select("block", "part", "totals")
    result = (
        blocks.groupBy("block")
        .cogroup(answered.groupBy("block"))
        .applyInArrow(scored, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    )
    return result.withColumn("train_tokens", F.lit(model.tokens - begins).cast("long"))
