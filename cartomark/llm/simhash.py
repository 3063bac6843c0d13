"""SimHash near-duplicates by exact comparison of tiles of fingerprints."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartomark.llm.common import FOLD
from cartomark.session import materialize

#: Fingerprints of a tile: two tiles and their comparison matrix take about 20 MB.
TILE = 2048
#: A cell is the four population counts of a fingerprint's 16-bit quarters.
QUARTER_COUNTS = 17


def fingerprint(text: str | None, shingle_words: int, seed: int) -> int:
    """Signed 64-bit SimHash: a bit is set if over half the shingle hashes set it."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: max(0, len(words) - shingle_words)]]
    stops = ends[shingle_words - 1 :] or ends[-1:]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[a : b - 1], seed) for a, b in zip(starts, stops, strict=True)]), dtype=np.uint8)
    votes = np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts)).view(">i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint`` (signed long) of every row; null and empty texts give 0."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle_words, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fingerprint"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return source.mapInArrow(rows, "doc_id long, fingerprint long")


def spanning_links(near: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) that connect what ``near`` connects, fewer than rows + columns.

    A family of near copies gives a tile full of links; its spanning forest
    keeps the family together without writing out all pairs.
    """
    links: list[tuple[int, int]] = []
    todo_rows, todo_columns = near.any(axis=1), near.any(axis=0)
    while todo_rows.any():
        front = np.array([np.flatnonzero(todo_rows)[0]])
        todo_rows[front] = False
        while len(front):
            columns = np.flatnonzero(todo_columns)
            seen = near[np.ix_(front, columns)]
            hit = seen.any(axis=0)
            found = columns[hit]
            links += zip(front[seen[:, hit].argmax(axis=0)].tolist(), found.tolist(), strict=True)
            todo_columns[found] = False
            rows = np.flatnonzero(todo_rows)
            seen = near[np.ix_(rows, found)]
            hit = seen.any(axis=1)
            front = rows[hit]
            links += zip(front.tolist(), found[seen[hit].argmax(axis=1)].tolist(), strict=True) if len(front) else []
            todo_rows[front] = False
    return links


def near_links(unique: DataFrame, *, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` between leaders of fingerprints ``radius`` bits apart or less.

    ``unique`` has one row per fingerprint: ``fingerprint, leader``. Fingerprints
    are laid out in cells by the population counts of their four quarters and
    cells are cut into tiles. Two tiles are compared, by exclusive-or and bit
    counts, only if those counts differ by ``radius`` or less in sum: counts that
    differ by more prove a larger distance. Links are a spanning forest of each
    tile pair, so components are exact.
    """
    quarters = [F.bit_count(F.shiftrightunsigned("fingerprint", k).bitwiseAND(F.lit(0xFFFF))) for k in (48, 32, 16, 0)]
    placed = unique.withColumn("_cell", F.array(*quarters))
    # At most 17**4 rows, whatever the table's size.
    cells = placed.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_tiles"))
    tiles = (
        placed.join(cells, "_cell")
        .withColumn("_tile", F.pmod(F.xxhash64("fingerprint"), F.col("_tiles")).cast("int"))
        .groupBy("_cell", "_tile")
        .agg(F.collect_list(F.struct("fingerprint", "leader")).alias("rows"))
    )
    tiles = materialize(tiles.select("_cell", "_tile", F.col("rows.fingerprint").alias("f"), F.col("rows.leader").alias("l")), "tiles")

    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]
    moves = F.array(*[F.array(*map(F.lit, s)) for s in steps])
    left = (
        tiles.select("_tile", "f", "l", "_cell", F.explode(moves).alias("_move"))
        .withColumn("_to", F.zip_with("_cell", "_move", lambda a, b: a + b))
        .where(F.forall("_to", lambda c: c.between(0, QUARTER_COUNTS - 1)))
        .select(F.col("_to").alias("_cell"), F.forall("_move", lambda m: m == 0).alias("_own"), F.col("_tile").alias("_t"), F.col("f").alias("fa"), F.col("l").alias("la"))
    )
    pairs = left.join(tiles, "_cell").where(~F.col("_own") | (F.col("_t") <= F.col("_tile")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_out, b_out = [], []
            columns = [batch.column(k) for k in range(5)]
            for i in range(batch.num_rows):
                same = columns[0][i].as_py()
                fa, la, fb, lb = (np.asarray(c[i].values) for c in columns[1:])
                near = np.bitwise_count(fa.view(np.uint64)[:, None] ^ fb.view(np.uint64)[None, :]) <= radius
                if same:
                    near &= la[:, None] != lb[None, :]
                if not near.any():
                    continue
                for r, c in spanning_links(near):
                    a_out.append(int(la[r]))
                    b_out.append(int(lb[c]))
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    same = (F.col("_own") & (F.col("_t") == F.col("_tile"))).alias("same")
    return pairs.select(same, "fa", "la", F.col("f").alias("fb"), F.col("l").alias("lb")).mapInArrow(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every linked node; the component is its smallest node.

    Alternates large-star and small-star steps: each hangs a node's neighbours
    on the smallest of them, and a few rounds (growing with the logarithm of the
    longest chain) leave stars. Every round is a written table, so lineage stays
    short; the driver sees two numbers a round.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        edges = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u <> v").distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("_m"))
        small = edges.join(low, "u")
        edges = small.select("u", F.col("_m").alias("v")).union(small.select("v", "_m").where("v <> _m")).distinct()
        edges = materialize(edges, "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked;
    a component's id is the smallest doc_id reachable. Equal fingerprints are one
    node, so copies are never paired with each other. Null and empty texts have
    fingerprint zero and link like any other. Rows without an id keep their
    fingerprint, link nothing and have a null component. Rows repeating an id
    are one document with several fingerprints only if their texts differ; each
    row then reports its own fingerprint's component. Other columns are ignored;
    an empty table gives an empty table.
    """
    marked = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, seed=seed), "fingerprints")
    unique = marked.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("leader"))
    unique = materialize(unique, "unique")
    found = components(near_links(unique, radius=radius))
    named = unique.join(found, unique["leader"] == found["node"], "left").select(
        "fingerprint", F.coalesce("component", "leader").alias("component_id")
    )
    return marked.join(named, "fingerprint", "left").select(
        "doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
