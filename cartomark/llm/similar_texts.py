"""Groups of near copies: SimHash candidates compared in tiles, linked by exact Jaccard."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartomark.llm.common import SPACE, ascii_lower, slices
from cartomark.llm.simhash import components, spanning_links, words_of
from cartomark.session import materialize

#: Texts of a tile, and rows of it compared in one step.
TILE, STEP = 8192, 64
#: Bits of 128 that may differ: texts of similarity 0.8 differ in 19, give or take 4; below ``SURE`` no sketch is asked.
RADIUS, SURE = 34, 20
#: Words of eight one-byte MinHash values; a candidate's share of equal bytes may be that much below the similarity.
SKETCH_WORDS, SKETCH_SLACK = 8, 0.15
#: Texts and shingles of a chunk: two chunks are all that one exact test holds in memory.
CHUNK_ROWS, CHUNK_SHINGLES = 2048, 1 << 20
#: Rows of a table of candidate texts that may be broadcast (two numbers each); beyond that they are joined.
SMALL = 500_000

_RANDOM = np.random.default_rng(20)
_TURNS = _RANDOM.integers(0, 2**64, 8 * SKETCH_WORDS, dtype=np.uint64)
_FACTORS = _RANDOM.integers(0, 2**64, 8 * SKETCH_WORDS, dtype=np.uint64) | np.uint64(1)
_LOW_BITS = np.uint64(0x0101010101010101)


def with_node(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """All rows with ``_node``, a hash of the text's words: copies, but for A-Z and spaces, have the same.

    Null and blank texts share one node. A column ``_node`` of the input is replaced.
    """
    trimmed = F.btrim(ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), F.lit(SPACE))
    return docs.withColumn("_node", F.xxhash64(F.regexp_replace(trimmed, "[\\x20\\x09-\\x0D]+", " ")))


def shingle_hashes(words: list[bytes], shingle_words: int) -> np.ndarray:
    """Distinct shingles as rows of two 64-bit hashes, sorted by the first; a shorter text is one shingle."""
    import xxhash

    if not words:
        return np.empty((0, 2), dtype=np.uint64)
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: max(0, len(words) - shingle_words)]]
    stops = ends[shingle_words - 1 :] or ends[-1:]
    digest = xxhash.xxh128_digest
    hashes = np.frombuffer(b"".join([digest(joined[a : b - 1]) for a, b in zip(starts, stops, strict=True)]), dtype=np.uint64).reshape(-1, 2)
    return hashes[np.unique(hashes[:, 0], return_index=True)[1]]


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of 128 bits (two words) and 64 one-byte MinHash values (eight words) of a set of shingles."""
    votes = np.zeros(128, dtype=np.int64)
    least = np.full(len(_TURNS), 2**64 - 1, dtype=np.uint64)
    for a in range(0, len(hashes), 2048):
        part = np.ascontiguousarray(hashes[a : a + 2048])
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 16), axis=1).sum(axis=0, dtype=np.int64)
        np.minimum(least, ((part[:, 0] ^ _TURNS[:, None]) * _FACTORS[:, None]).min(axis=1), out=least)
    small = (least >> np.uint64(24)).astype(np.uint8)
    return np.packbits(votes * 2 > len(hashes)).view(np.int64), small.view(np.int64)


def sketches(docs: DataFrame, *, shingle_words: int) -> DataFrame:
    """``doc_id, node, n, bits, mins`` of every row: sketches of its ``n`` distinct shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], 1):
                sizes, bits, mins = [], [], []
                for t in part.column(1):
                    hashes = shingle_hashes(words_of(t.as_py()), shingle_words)
                    two, eight = sketch(hashes)
                    sizes.append(len(hashes))
                    bits.append(two)
                    mins.append(eight)
                kind = pa.list_(pa.int64())
                columns = [part.column(0), part.column(2), pa.array(sizes, pa.int32()), pa.array(bits, kind), pa.array(mins, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", "bits", "mins"])

    return docs.select("doc_id", "text", "_node").mapInArrow(rows, "doc_id long, node long, n int, bits array<long>, mins array<long>")


class Rows(NamedTuple):
    """Texts of a tile or a chunk: node, set size, component, SimHash and MinHash words."""

    node: np.ndarray
    n: np.ndarray
    comp: np.ndarray
    bits: np.ndarray
    mins: np.ndarray

    @classmethod
    def of(cls, columns: list[pa.Array]) -> Rows:
        plain = [c.to_numpy(zero_copy_only=False) for c in columns[:3]]
        words = [c.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for c in columns[3:]]
        return cls(*plain, words[0].reshape(-1, 2), words[1].reshape(-1, SKETCH_WORDS))

    def take(self, at) -> Rows:
        return Rows(*(c[at] for c in self))


def equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes of the words in each row are equal."""
    x = a ^ b
    for shift in (4, 2, 1):
        x |= x >> np.uint64(shift)
    return 8 * SKETCH_WORDS - np.bitwise_count(x & _LOW_BITS).sum(axis=1, dtype=np.int64)


def screened(a: Rows, b: Rows, same: bool, similarity: float, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in ``a`` and ``b`` of the candidate pairs, and their differing bits, a few rows at a time.

    Candidates are in different components, differ in ``radius`` bits or fewer,
    have sizes that allow the similarity and, from ``SURE`` bits on, sketches
    that make it likely (see ``SKETCH_SLACK``).
    """
    for r in range(0, len(a.node), STEP):
        far = np.bitwise_count(a.bits[r : r + STEP, None, 0] ^ b.bits[None, :, 0])
        far += np.bitwise_count(a.bits[r : r + STEP, None, 1] ^ b.bits[None, :, 1])
        lines, columns = np.nonzero(far <= radius)
        far, lines = far[lines, columns], lines + r
        x, y = a.n[lines], b.n[columns]
        good = (np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9) & (a.comp[lines] != b.comp[columns])
        if same:
            good &= columns > lines
        lines, columns, far = lines[good], columns[good], far[good]
        unsure = np.flatnonzero(far >= SURE)
        out = np.ones(len(lines), dtype=bool)
        for k in range(0, len(unsure), 1 << 15):
            some = unsure[k : k + (1 << 15)]
            out[some] = equal_bytes(a.mins[lines[some]], b.mins[columns[some]]) >= (similarity - SKETCH_SLACK) * 8 * SKETCH_WORDS
        if out.any():
            yield lines[out], columns[out], far[out]


def chunks_of(sizes: np.ndarray) -> np.ndarray:
    """A chunk number for each text, by their count and the shingles before them."""
    before = np.cumsum(sizes) - sizes
    return np.maximum(np.arange(len(sizes)) // CHUNK_ROWS, before // CHUNK_SHINGLES)


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b``, by matrix products."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    counts = np.zeros((len(a), len(b)))

    def members(sets: list[np.ndarray], some: np.ndarray) -> np.ndarray:
        out = np.zeros((len(sets), len(some)), dtype=np.float32)
        for row, s in zip(out, sets, strict=True):
            inside = s[np.searchsorted(s, some[0]) : np.searchsorted(s, some[-1], "right")]
            at = np.searchsorted(some, inside)
            row[at[some[at] == inside]] = 1
        return out

    for k in range(0, len(both), 2048):
        some = both[k : k + 2048]
        counts += members(a, some) @ members(b, some).T
    return counts


def tested_links(a: Rows, b: Rows, sets_a: list[np.ndarray], sets_b: list[np.ndarray], same: bool, similarity: float, radius: int) -> list[tuple[int, int]]:
    """Links (node, node) of exact similarity that join all the components they can.

    Three times every text is tested against its nearest candidate in another
    component, which joins families of near copies by about as many tests as they have texts. What
    is still apart is tested pair by pair if that is little, else all at once.
    """
    live = np.zeros((len(a.node), len(b.node)), dtype=bool)
    far = np.full(live.shape, 255, dtype=np.uint8)
    for lines, columns, bits in screened(a, b, same, similarity, radius):
        live[lines, columns] = True
        far[lines, columns] = bits
    labels = np.unique(np.append(a.comp, b.comp), return_inverse=True)[1]
    of_a = np.arange(len(a.node))
    of_b = np.arange(len(b.node)) + (0 if same else len(a.node))
    links: list[tuple[int, int]] = []

    def alike(shared: float, x: int, y: int) -> bool:
        return shared >= similarity * (x + y - shared) - 1e-9

    def join(i: int, j: int) -> None:
        links.append((int(a.node[i]), int(b.node[j])))
        labels[labels == labels[of_b[j]]] = labels[of_a[i]]

    def test(pairs: Iterator[tuple[int, int]]) -> None:
        for i, j in pairs:
            live[i, j] = False
            if labels[of_a[i]] != labels[of_b[j]]:
                x, y = sets_a[i], sets_b[j]
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                if alike(int((y[at] == x).sum()), len(x), len(y)):
                    join(i, j)

    for _ in range(3):
        np.logical_and(live, labels[of_a][:, None] != labels[of_b][None, :], out=live)
        lines, columns = np.flatnonzero(live.any(axis=1)), np.flatnonzero(live.any(axis=0))
        if not len(lines):
            return links
        bits = np.where(live, far, 255)
        test(zip(lines.tolist(), bits[lines].argmin(axis=1).tolist(), strict=True))
        test(zip(bits[:, columns].argmin(axis=0).tolist(), columns.tolist(), strict=True))
    np.logical_and(live, labels[of_a][:, None] != labels[of_b][None, :], out=live)
    lines, columns = np.flatnonzero(live.any(axis=1)), np.flatnonzero(live.any(axis=0))
    if live.sum() <= 16 * (len(lines) + len(columns)):
        test(np.argwhere(live).tolist())
        return links
    shared = shared_counts([sets_a[i] for i in lines], [sets_b[j] for j in columns])
    x, y = a.n[lines][:, None], b.n[columns][None, :]
    good = live[np.ix_(lines, columns)] & (shared >= similarity * (x + y - shared) - 1e-9)
    links += [(int(a.node[lines[i]]), int(b.node[columns[j]])) for i, j in spanning_links(good)]
    return links


def tested_pairs(docs: DataFrame, nodes: DataFrame, left: DataFrame, right: DataFrame, pairs: DataFrame, *, similarity: float, shingle_words: int, radius: int) -> DataFrame:
    """``a, b``: exact links between the texts of tiles ``left.tile = ta`` and ``right.tile = tb``.

    ``left`` and ``right`` have a row per text. Tiles are compared by their sketches
    first. Texts with a candidate are cut into chunks by their shingles, and two chunks at a time
    meet with their sets, which come once to each such meeting.
    """
    fields = ("node", "n", "comp", "bits", "mins")

    def packed(side: DataFrame, key: str) -> DataFrame:
        # Sorted: a tile that meets itself must come in one order from either side.
        tiles = side.groupBy(F.col("tile").alias(key)).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("e"))
        return pairs.join(tiles, key).select(F.concat_ws("|", "ta", "tb").alias("pair"), (F.col("ta") == F.col("tb")).alias("same"), F.col("e").alias(f"e_{key}"))

    met = packed(left, "ta").join(packed(right, "tb").drop("same").hint("merge"), "pair")

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair, same, ea, eb in zip(*(batch.column(c) for c in range(4)), strict=True):
                same = same.as_py()
                a, b = (Rows.of([e.values.field(k) for k in range(5)]) for e in (ea, eb))
                hit_a, hit_b = np.zeros(len(a.node), dtype=bool), np.zeros(len(b.node), dtype=bool)
                for lines, columns, _ in screened(a, b, same, similarity, radius):
                    hit_a[lines] = hit_b[columns] = True
                if same:
                    hit_a = hit_b = hit_a | hit_b
                if not hit_a.any():
                    continue
                a, b = a.take(hit_a), b.take(hit_b)
                for ca, cb in itertools.product(np.unique(chunks_of(a.n)), np.unique(chunks_of(b.n))):
                    if same and ca > cb:
                        continue
                    meeting = [(a.take(chunks_of(a.n) == ca), 2 if same and ca == cb else 0)]
                    if not (same and ca == cb):
                        meeting.append((b.take(chunks_of(b.n) == cb), 1))
                    for rows, side in meeting:
                        size = len(rows.node)
                        kind = pa.list_(pa.int64())
                        words = [pa.ListArray.from_arrays(np.arange(size + 1, dtype=np.int32) * w.shape[1], pa.array(np.ascontiguousarray(w).view(np.int64).ravel())).cast(kind) for w in (rows.bits, rows.mins)]
                        unit = pa.array([f"{pair.as_py()}|{ca}|{cb}"] * size, pa.string())
                        plain = [pa.array(rows.node), pa.array(rows.n.astype(np.int32)), pa.array(rows.comp)]
                        yield pa.RecordBatch.from_arrays([unit, pa.array([side] * size, pa.int32()), *plain, *words], ["unit", "side", *fields])

    kinds = "node long, n int, comp long, bits array<long>, mins array<long>"
    units = materialize(met.select("pair", "same", "e_ta", "e_tb").mapInArrow(screen, f"unit string, side int, {kinds}"), "candidates")
    used = materialize(units.select("node").distinct().join(nodes.select("node", "leader"), "node"), "nodes_used")
    if used.count() <= SMALL:
        used = F.broadcast(used)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], 1, 4 << 20):
                found = [shingle_hashes(words_of(t.as_py()), shingle_words)[:, 0].view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "set"])

    # Of many copies only the leader's text is cut into shingles.
    texts = docs.join(used, (F.col("doc_id") == F.col("leader")) & (F.col("_node") == F.col("node")), "left_semi").select("_node", "text")
    hashed = texts.mapInArrow(sets, "node long, set array<long>").groupBy("node").agg(F.first("set").alias("set"))

    def verify(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        columns = {c: (group.column(c).chunk(0) if group.num_rows else None) for c in group.column_names}
        rows = Rows.of([columns[c] for c in fields])
        side = columns["side"].to_numpy()
        sets_of = [s.values.to_numpy(zero_copy_only=False).view(np.uint64) for s in columns["set"]]
        same = bool((side == 2).any())
        one, two = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        links = tested_links(rows.take(one), rows.take(two), [sets_of[i] for i in one], [sets_of[i] for i in two], same, similarity, radius)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return units.join(hashed, "node").select("unit", "side", *fields, "set").groupBy("unit").applyInArrow(verify, "a long, b long")


def with_links(found: DataFrame, new: DataFrame) -> DataFrame:
    """Components ``found`` joined further by ``new`` links."""
    new = materialize(new, "links")
    if new.isEmpty():
        return found
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return materialize(components(stars.unionByName(new)), "components")


def similar_nodes(docs: DataFrame, *, similarity: float = 0.8, shingle_words: int = 5, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``node, leader, component`` of every text with an id; ``docs`` comes from :func:`with_node`.

    Texts are linked if their sets of ``shingle_words`` shingles have Jaccard ``similarity``
    or more, tested on the sets themselves; a text of fewer words is one
    shingle, and texts without words are one node, linked to nothing. Only pairs whose 128-bit SimHashes differ in ``radius`` bits or
    fewer are tested, and of those that differ in ``SURE`` bits or more only
    pairs whose share of equal MinHash bytes is at most ``SKETCH_SLACK`` below the similarity. ``leader`` is the smallest id
    of a text, ``component`` the smallest node it is linked to, itself included.
    Rows without an id take no part; an empty table gives an empty table.

    Texts are cut into tiles by the size of their sets; sizes that rule the
    similarity out keep tiles apart. Links are sought in three steps, with
    components in between: inside each tile; between tiles for one text of each
    component in a tile; and for the others, where components still differ.
    A family of near copies, however large, thus costs a few tests and links
    for each of its texts.
    """
    marked = sketches(docs.where("doc_id is not null"), shingle_words=shingle_words)
    # All but the id follows from the text.
    columns = [F.first(c).alias(c) for c in ("n", "bits", "mins")]
    nodes = materialize(marked.groupBy("node").agg(F.min("doc_id").alias("leader"), *columns), "nodes")

    # Sizes of similar sets are one cell apart at most.
    cell = F.floor(F.log(F.col("n").cast("double")) / -math.log(similarity)).cast("int")
    sized = nodes.where("n > 0").withColumn("_cell", cell)
    cells = sized.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_tiles"))
    placed = sized.join(cells, "_cell").withColumn("_tile", F.pmod(F.xxhash64("node"), F.col("_tiles")).cast("int"))
    placed = materialize(placed.select("node", "n", "bits", "mins", "_cell", "_tile", F.concat_ws("/", "_cell", "_tile").alias("tile")), "placed")
    names = placed.select("tile", "_cell", "_tile").distinct()
    ahead = names.select(F.col("tile").alias("ta"), F.col("_cell").alias("_from"), F.col("_tile").alias("_t"), F.explode(F.array("_cell", F.col("_cell") + 1)).alias("_cell"))
    across = ahead.join(names.withColumnRenamed("tile", "tb"), "_cell").where("_from < _cell or _t < _tile")
    across = materialize(across.select("ta", "tb"), "tile_pairs")

    docs = docs.where("doc_id is not null")
    exact = {"similarity": similarity, "shingle_words": shingle_words, "radius": radius}
    alone = placed.withColumn("comp", F.col("node"))
    links = tested_pairs(docs, nodes, alone, alone, names.select(F.col("tile").alias("ta"), F.col("tile").alias("tb")), **exact)
    found = materialize(components(links), "components")
    if not across.isEmpty():
        named = placed.join(found, "node", "left").withColumn("comp", F.coalesce("component", "node"))
        first = placed.join(found, "node").groupBy("tile", "component").agg(F.min("node").alias("node")).select("node", F.lit(True).alias("first"))
        named = materialize(named.join(first, "node", "left").withColumn("rep", F.col("component").isNull() | F.col("first").isNotNull()).drop("component", "first"), "named")
        reps = named.where("rep")
        found = with_links(found, tested_pairs(docs, nodes, reps, reps, across, **exact))
        rest = named.drop("comp").join(found, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        both = across.unionByName(across.select(F.col("tb").alias("ta"), F.col("ta").alias("tb")))
        found = with_links(found, tested_pairs(docs, nodes, rest.where("not rep"), rest, both, **exact))
    return nodes.select("node", "leader").join(found, "node", "left").select("node", "leader", F.coalesce("component", "node").alias("component"))
