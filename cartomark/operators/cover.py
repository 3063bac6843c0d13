"""Compact covers of shapes: quadtree cells, large inside and fine along the outline.

A cover is a table ``(fid, level, cell)``; a cell of level k holds ``4**k`` base
cells and no cell of a cover lies in another. Rows grow with the outline of a
shape, not with its area, and no list of cells is ever built.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions.grid import cell_id, parent_cell
from cartomark.operators.raster import merge_runs

#: The coarsest level: runs of ``2**TOP`` rows are merged in one group.
TOP = 10


def cell_runs(features: DataFrame, size: float, geom: str = "geom") -> DataFrame:
    """``fid, row, c0, c1``: base cells touched by the outline, or inside, as runs.

    Each edge is cut by grid row before any grouping; the columns it touches in
    that row follow from its ends there. Inside cells come from the crossings of the
    row's middle by the even-odd rule. Runs of a row neither overlap nor touch.
    """
    segments = F.when(
        F.col(geom)["kind"] == "point",
        F.transform(
            F.flatten(F.col(geom)["rings"]),
            lambda p: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2")),
        ),
    ).otherwise(G.geometry_segments(F.col(geom)))
    edges = features.select("fid", (F.col(geom)["kind"] == "polygon").alias("_fill"), F.inline(segments))
    edges = edges.withColumns({c: F.col(c) / F.lit(float(size)) for c in ("x1", "y1", "x2", "y2")})
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("row", F.explode(F.sequence(F.floor(low).cast("bigint"), F.floor(high).cast("bigint"))))
    flat = F.col("y1") == F.col("y2")

    def x_at(y: Column) -> Column:
        x = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
        # Rounding must not leave the edge: its end may lie on a cell's border.
        return F.greatest(F.least("x1", "x2"), F.least(F.greatest("x1", "x2"), x))

    def run(c0: Column, c1: Column) -> Column:
        return F.struct(F.floor(c0).cast("bigint").alias("c0"), F.floor(c1).cast("bigint").alias("c1"))

    y = F.col("row").cast("double")
    xa, xb = x_at(F.greatest(low, y)), x_at(F.least(high, y + 1.0))
    touched = run(
        F.when(flat, F.least("x1", "x2")).otherwise(F.least(xa, xb)),
        F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(xa, xb)),
    )
    mid = y + 0.5
    crosses = F.col("_fill") & ~flat & (mid >= low) & (mid < high)
    per_row = (
        rows.select("fid", "row", touched.alias("_run"), F.when(crosses, x_at(mid)).alias("_x"))
        .groupBy("fid", "row")
        .agg(F.collect_list("_run").alias("_runs"), F.array_sort(F.collect_list("_x")).alias("_xs"))
    )
    inside = F.when(
        F.size("_xs") >= 2,
        F.transform(
            F.sequence(F.lit(1), F.floor(F.size("_xs") / 2).cast("int")),
            lambda i: run(F.element_at("_xs", i * 2 - 1), F.element_at("_xs", i * 2)),
        ),
    ).otherwise(F.array().cast("array<struct<c0:bigint,c1:bigint>>"))
    return per_row.select("fid", "row", F.inline(merge_runs(F.concat("_runs", inside))))


def stretches(rows: np.ndarray, xs: np.ndarray, steps: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches ``row, from, to`` (end excluded) where the steps up to there add up to ``wanted``."""
    order = np.lexsort((xs, rows))
    rows, xs, height = rows[order], xs[order], np.cumsum(steps[order])
    at = np.flatnonzero((height[:-1] == wanted) & (rows[1:] == rows[:-1]) & (xs[1:] > xs[:-1]))
    return rows[at], xs[at], xs[at + 1]


def quadtree_runs(rows: np.ndarray, c0: np.ndarray, c1: np.ndarray, top: int = TOP) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of base cells as ``(level, rows, c0, c1)`` of the largest aligned cells.

    Two rows give a row of the next level where both are full; what that leaves
    of them stays at their level.
    """
    out = []
    for level in range(top + 1):
        if level == top:
            out.append((level, rows, c0, c1))
            break
        # Steps of +1 where a run begins and -1 where it ended: 2 means full in both rows.
        up, down = np.ones(len(rows), dtype=np.int64), -np.ones(len(rows), dtype=np.int64)
        parents, x0, x1 = stretches(np.tile(rows >> 1, 2), np.append(c0, c1 + 1), np.append(up, down), 2)
        p0, p1 = (x0 + 1) >> 1, (x1 >> 1) - 1
        parents, p0, p1 = parents[p0 <= p1], p0[p0 <= p1], p1[p0 <= p1]
        children = np.append(parents * 2, parents * 2 + 1)
        gone = np.ones(len(children), dtype=np.int64)
        left = stretches(
            np.concatenate([rows, rows, children, children]),
            np.concatenate([c0, c1 + 1, np.tile(p0 * 2, 2), np.tile(p1 * 2 + 2, 2)]),
            np.concatenate([up, down, -gone, gone]),
            1,
        )
        out.append((level, left[0], left[1], left[2] - 1))
        rows, c0, c1 = parents, p0, p1
        if not len(rows):
            break
    return out


def compact_cover(features: DataFrame, size: float, geom: str = "geom", top: int = TOP) -> DataFrame:
    """``fid, level, cell``: the quadtree cover of each geometry; ``size`` is that of a base cell.

    Cell ids are those of parents of base cells, so the id of the ancestor j
    levels up is :func:`parent_cell` of j. Features without a vertex have no row,
    and rows that repeat a ``fid`` are one feature. Runs are dealt by feature
    and band of ``2**top`` rows; what is merged at once is a batch of them, or
    one band's runs, whose number is that of the outline there.
    """

    kind = features.schema["fid"].dataType.simpleString()
    runs = cell_runs(features, size, geom).withColumn("_band", F.call_function("shiftright", "row", F.lit(top)))
    sorted_runs = runs.select("fid", "_band", "row", "c0", "c1").repartition("fid", "_band").sortWithinPartitions("fid", "_band")

    def merged(part: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        """Level runs of the groups that begin at ``starts``, all merged at once."""
        bands, rows, c0, c1 = (part.column(k).to_numpy() for k in range(1, 5))
        groups = np.zeros(part.num_rows, dtype=np.int64)
        groups[starts] = 1
        groups = np.cumsum(groups) - 1
        columns = []
        for level, at, x0, x1 in quadtree_runs(groups << top | rows & ((1 << top) - 1), c0, c1, top):
            group, left = at >> (top - level), top - level
            columns.append((starts[group], np.full(len(at), level), bands[starts[group]] << left | at & ((1 << left) - 1), x0, x1))
        first, levels, at, x0, x1 = (np.concatenate(c) for c in zip(*columns, strict=True))
        arrays = [part.column(0).take(pa.array(first)), pa.array(levels, pa.int32()), pa.array(at), pa.array(x0), pa.array(x1)]
        return pa.RecordBatch.from_arrays(arrays, ["fid", "level", "row", "c0", "c1"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group may go on in the next batch, so the last one waits."""
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch if held is None else pa.concat_batches([held, batch])
            names = part.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            bands = part.column(1).to_numpy()
            starts = np.append(0, np.flatnonzero((np.diff(names) != 0) | (np.diff(bands) != 0)) + 1)
            if starts[-1]:
                yield merged(part.slice(0, starts[-1]), starts[:-1])
            held = part.slice(starts[-1])
        if held is not None:
            yield merged(held, np.zeros(1, dtype=np.int64))

    levels = sorted_runs.mapInArrow(merge, f"fid {kind}, level int, row bigint, c0 bigint, c1 bigint")
    cells = levels.withColumn("_col", F.explode(F.sequence("c0", "c1")))
    return cells.select("fid", "level", cell_id(F.col("_col"), F.col("row"), F.col("level")).alias("cell"))


def base_cells(cover: DataFrame) -> DataFrame:
    """The base cells of a cover, one row each; grows with the area."""
    below = F.pow(F.lit(4), F.col("level")).cast("bigint")
    first = F.col("cell") * below
    unfolded = F.explode(F.sequence(first, first + below - 1)).alias("cell")
    return cover.select(*[c for c in cover.columns if c not in ("level", "cell")], unfolded)


def _lifted(cover: DataFrame, keys: Sequence[str], top: int) -> DataFrame:
    """The ancestors of a cover's cells, up to the coarsest level, without repeats."""
    above = F.explode(F.when(F.col("level") < top, F.sequence(F.col("level") + 1, F.lit(top)))).alias("_to")
    lifted = cover.select(*keys, "fid", "level", "cell", above)
    return lifted.select(*keys, "fid", F.col("_to").alias("level"), parent_cell(F.col("cell"), F.col("_to") - F.col("level")).alias("cell")).distinct()


def meeting(side: DataFrame, other: DataFrame, keys: Sequence[str], top: int = TOP) -> DataFrame:
    """``keys, fid`` of the covers of ``side`` that share a base cell with one of ``other``.

    Two cells share base cells only if one is the other's ancestor, or the same:
    each side's own cells meet the other's own cells and ancestors.
    """
    on = [*keys, "level", "cell"]
    theirs = other.select(*on).distinct()
    above = _lifted(other, keys, top).select(*on).distinct()
    own = side.join(theirs.unionByName(above).distinct(), on, "left_semi").select(*keys, "fid")
    finer = _lifted(side, keys, top).join(theirs, on, "left_semi").select(*keys, "fid")
    return own.unionByName(finer).distinct()


def cover_prefilter(perf: DataFrame, truth: DataFrame, perf_cover: DataFrame, truth_cover: DataFrame, keys: Sequence[str], top: int = TOP) -> tuple[DataFrame, DataFrame]:
    """Features of either side whose covers meet; covers carry ``keys``."""
    on = [*keys, "fid"]
    kept = perf.join(meeting(perf_cover, truth_cover, keys, top), on, "left_semi")
    return kept, truth.join(meeting(truth_cover, perf_cover, keys, top), on, "left_semi")


def cover_index(cover: DataFrame, keys: Sequence[str], page_rows: int = 10_000) -> DataFrame:
    """Per level and cell the features found there, in pages of bounded size."""
    cell = [*keys, "level", "cell"]
    pages = (
        cover.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > page_rows)
        .select(*cell, F.ceil(F.col("_n") / page_rows).cast("bigint").alias("_pages"))
    )
    return (
        cover.join(pages, cell, "left")
        .withColumn("page", F.pmod(F.xxhash64("fid"), F.coalesce("_pages", F.lit(1).cast("bigint"))))
        .groupBy(*cell, "page")
        .agg(F.array_sort(F.collect_list("fid")).alias("refs"))
    )
