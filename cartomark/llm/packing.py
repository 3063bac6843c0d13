"""Best-fit packing of token sequences under several capacities at once."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartomark.session import materialize

#: Pieces packed together by one task. Only lengths and ids travel there, some
#: tens of bytes a piece, and a group wastes about one sequence.
GROUP_PIECES = 200_000
#: Texts of these characters are split alike by both tokenizer libraries; any
#: other character may depend on a library's Unicode tables.
COMMON_TEXT = r"[\t\n\r\x20-\x7e\u00a1-\u024f\u2010-\u2026\u20ac]*"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(
    docs: DataFrame,
    *,
    tokenizer_json: str,
    ranks_file: str,
    pattern: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token pieces of every text: ``doc_id, piece, start, length, ids_crc32``.

    A document is its ids followed by ``end_id``; a null text is empty, so it is
    one id long. Documents longer than ``capacity`` are cut so that all pieces but
    the first are full. Equal rows give equal pieces; a null id stays null.

    Ids are those of the ``tokenizers`` file. Texts of common characters are
    encoded with the same vocabulary's rank file, several times faster; the rest,
    and texts that spell a special token, go through ``tokenizers`` itself.
    """

    def encoders():
        import base64
        import re

        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(tokenizer_json)
        special = [t.content for t in exact.get_added_tokens_decoder().values()]
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        common = re.compile(COMMON_TEXT)

        def encode(text: str) -> np.ndarray:
            if common.fullmatch(text) and not any(s in text for s in special):
                return fast.encode_to_numpy(text, disallowed_special=())
            return np.array(exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        return encode

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoders()
        for batch in batches:
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    out["doc_id"].append(doc_id.as_py())
                    out["piece"].append(k)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return source.mapInArrow(pieces, PIECES)


def best_fit(
    lengths: np.ndarray,
    *,
    capacity: int,
    max_documents: int,
    max_attention: int,
    weights: tuple[float, float, float],
    rule: str,
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first, by vector best fit.

    A bin has three residuals: tokens, documents, attention cost (the sum of
    squared lengths). ``rule="norm"`` takes the bin that would be left with the
    smallest weighted residual norm; ``rule="dot"`` the one whose residual has the
    largest weighted dot-product with the piece. Both consider only bins with
    room in every residual. Pieces of one length are the same vector, so each
    length is one step over all open bins.
    """
    limit = np.array([capacity, max_documents, max_attention], dtype=np.float64)
    w = np.array(weights, dtype=np.float64)
    bins = np.empty(len(lengths), dtype=np.int64)
    room = np.empty((0, 3))
    order = np.argsort(-lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
        size = int(lengths[order[a]])
        need = np.array([size, 1, size * size], dtype=np.float64)
        todo = order[a:b]
        while len(todo):
            fits = np.flatnonzero((room >= need).all(axis=1))
            if not len(fits):
                # As many new bins as these pieces can fill.
                each = max(1, int(min(limit // np.maximum(need, 1))))
                room = np.vstack([room, np.tile(limit, (math.ceil(len(todo) / each), 1))])
                continue
            share = room[fits] / limit
            if rule == "dot":
                best = np.argsort(-(share * (need / limit) * w).sum(axis=1), kind="stable")
                takes = np.ones(len(fits), dtype=np.int64)
            else:
                # A bin that took a piece is tighter than before, so it stays best while it has room.
                best = np.argsort((((share - need / limit) ** 2) * w).sum(axis=1), kind="stable")
                takes = (room[fits] // np.maximum(need, 1)).min(axis=1).astype(np.int64)
            upto = np.cumsum(takes[best])
            last = int(np.searchsorted(upto, len(todo)))
            chosen, counts = fits[best[: last + 1]], takes[best[: last + 1]]
            counts[-1] -= max(0, int(counts.sum()) - len(todo))
            placed = np.repeat(chosen, counts)
            bins[todo[: len(placed)]] = placed
            room[chosen] -= counts[:, None] * need
            todo = todo[len(placed) :]
    by_bin = np.argsort(bins[order], kind="stable")
    rows = order[by_bin]
    ends = np.cumsum(lengths[rows])
    first = np.flatnonzero(np.diff(bins[rows], prepend=-1))
    base = np.repeat((ends - lengths[rows])[first], np.diff([*first, len(rows)]))
    offsets = np.empty(len(lengths), dtype=np.int64)
    offsets[rows] = ends - lengths[rows] - base
    return bins, offsets


def pack(
    pieces: DataFrame,
    *,
    capacity: int = 1024,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` column.

    Pieces are dealt evenly to groups of about ``group_pieces``; each group is
    packed on its own by :func:`best_fit`, so work and memory of a task stay
    fixed as the table grows. By default only tokens bind: a sequence may hold as
    many documents and as much attention as its tokens allow. Input columns named
    like the two results are replaced. Ties go to the older sequence.
    """
    pieces = materialize(pieces.drop("sequence_id", "offset"), "pieces")
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    limits = {
        "capacity": capacity,
        "max_documents": max_documents or capacity,
        "max_attention": max_attention or capacity * capacity,
        "weights": weights,
        "rule": rule,
    }

    def place(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) == 0:
            return group.assign(sequence_id=pd.Series(dtype="int64"), offset=pd.Series(dtype="int64")).drop(columns="_group")
        bins, offsets = best_fit(group["length"].to_numpy(), **limits)
        number = int(group["_group"].iloc[0])
        return group.drop(columns="_group").assign(sequence_id=number * 2**32 + bins, offset=offsets)

    schema = ", ".join([*(f"`{n}` {t}" for n, t in pieces.dtypes), "sequence_id long", "offset long"])
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    return dealt.groupBy("_group").applyInPandas(place, schema)
