"""Spatial candidate joins over the hierarchical grid.

Feature tables carry ``fid`` and a ``bbox`` struct; vertices stay out of the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions.grid import axis_cell, bbox_cover, parent_cell
from cartomark.session import materialize

#: Squares a feature may span along one axis before it moves to a coarser level.
SPAN = 8
#: Base cells along a square of the join. A box as large as a cell touches four cells, but seldom two squares.
GRAIN = 4
#: Base cells along an area of the prefilter, whose cells are one row of masks, and the bits of a cell's number there.
AREA_BITS = 5
AREA = 1 << AREA_BITS
#: Levels are taken in steps of three (eight times the cell size each).
LEVEL_STEP = 3
MAX_LEVEL = 30


def with_cells(df: DataFrame, size: float, levels: int, box: str = "bbox") -> DataFrame:
    """Add the fine cells of the box and their distinct coarse parents as arrays.

    For boxes of a bounded number of cells; joins use :func:`spatial_pairs`, which
    places larger ones at a coarser level.
    """
    b = F.col(box)
    cells = bbox_cover(b["xmin"], b["ymin"], b["xmax"], b["ymax"], size)
    return df.withColumn("fine_cells", cells).withColumn(
        "coarse_cells",
        F.array_distinct(F.transform("fine_cells", lambda c: parent_cell(c, levels))),
    )


def cell_prefilter(
    perf: DataFrame,
    truth: DataFrame,
    keys: Sequence[str],
    cell_cols: Sequence[str] = ("coarse_cells", "fine_cells"),
) -> tuple[DataFrame, DataFrame]:
    """Features that share cells with the other side at every listed level.

    Each level is an independent semi join on an exploded cell; the truth side is
    then reduced against what is left of the performer side.
    """

    def keep(side: DataFrame, other: DataFrame) -> DataFrame:
        for col in cell_cols:
            there = other.select(*keys, F.explode(col).alias("_cell")).distinct()
            ids = (
                side.select(*keys, "fid", F.explode(col).alias("_cell"))
                .join(there, [*keys, "_cell"], "left_semi")
                .select(*keys, "fid")
                .distinct()
            )
            side = side.join(ids, [*keys, "fid"], "left_semi")
        return side

    kept_perf = keep(perf, truth)
    return kept_perf, keep(truth, kept_perf)


def _shl(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by.cast("int"))


def _bits(first: Column, last: Column) -> Column:
    """The bits ``first..last`` of a number."""
    ones = F.lit(-1).cast("bigint")
    return F.call_function("shiftrightunsigned", ones, (F.lit(63) - last).cast("int")).bitwiseAND(_shl(ones, first))


def _in_areas(side: DataFrame, size: float) -> DataFrame:
    """Boxes once per area of ``AREA`` by ``AREA`` cells they touch (``_ac``, ``_ar``), with the cells ``_x0..``, ``_y0..`` there."""
    b = F.col("bbox")
    side = side.where(F.forall(F.array(*[b[c] for c in ("xmin", "ymin", "xmax", "ymax")]), lambda v: v.isNotNull()))
    for at, low, high in (("c", "xmin", "xmax"), ("r", "ymin", "ymax")):
        ends = axis_cell(b[low], size), axis_cell(b[high], size)
        side = side.withColumns({f"_{at}0": F.least(*ends), f"_{at}1": F.greatest(*ends)})
    area = [F.floor(F.col(c) / AREA).cast("bigint") for c in ("_c0", "_c1", "_r0", "_r1")]
    side = side.withColumn("_ac", F.explode(F.sequence(*area[:2]))).withColumn("_ar", F.explode(F.sequence(*area[2:])))
    none, last = F.lit(0).cast("bigint"), F.lit(AREA - 1).cast("bigint")
    local = {}
    for to, at, first in (("_x", "_c", "_ac"), ("_y", "_r", "_ar")):
        local[f"{to}0"] = F.greatest(F.col(f"{at}0") - F.col(first) * AREA, none)
        local[f"{to}1"] = F.least(F.col(f"{at}1") - F.col(first) * AREA, last)
    return side.withColumns(local).drop("bbox", "_c0", "_c1", "_r0", "_r1")


def _occupied(side: DataFrame, keys: Sequence[str], size: float) -> DataFrame:
    """Per key and area the cells that any box touches: one row of masks, combined before the exchange."""
    placed = _in_areas(side, size).withColumn("_bits", _bits(F.col("_x0"), F.col("_x1")))
    placed = placed.withColumn("_high", F.shiftleft("_bits", AREA))

    def row(k: int, bits: str) -> Column:
        return F.when((F.col("_y0") <= k) & (F.col("_y1") >= k), F.col(bits)).otherwise(F.lit(0).cast("bigint"))

    # Two rows of cells are one number.
    masks = [F.bit_or(row(k, "_bits").bitwiseOR(row(k + 1, "_high"))).alias(f"_m{k}") for k in range(0, AREA, 2)]
    met = placed.groupBy(*keys, "_ac", "_ar").agg(*masks)
    return met.select(*keys, "_ac", "_ar", F.array(*[f"_m{k}" for k in range(0, AREA, 2)]).alias("_touched"))


def box_prefilter(
    perf: DataFrame, truth: DataFrame, keys: Sequence[str], size: float
) -> tuple[DataFrame, DataFrame]:
    """Features of either side whose boxes share a cell of ``size`` with one of the other.

    What a side touches is a row of masks per key and area of ``AREA`` by ``AREA``
    cells, so boxes travel to their area once, with their cells there in one number, and
    are never compared with each other. Boxes of more than ``SPAN`` areas along
    an axis, and those that may meet them, are placed as in :func:`spatial_pairs`.
    """
    sides = [side.select(*keys, "fid", "bbox") for side in (perf, truth)]
    square = size * AREA
    left, right, on = _placed_sides(*sides, keys, size, any_cell=True, square=square)
    left, right = left.where("_lv > 0"), right.where("_g_lv > 0")

    def few(placed: DataFrame, fid: str) -> DataFrame:
        return placed.drop(fid).distinct()

    coarse = (
        left.join(few(right, "g_fid"), on, "left_semi").select(*keys, F.col("p_fid").alias("fid")),
        right.join(few(left, "p_fid"), on, "left_semi").select(*[F.col(f"_g{k}").alias(k) for k in keys], F.col("g_fid").alias("fid")),
    )
    small = [side.where(_level(F.col("bbox"), square) == 0) for side in sides]
    parts = ("_x0", "_x1", "_y0", "_y1")

    def keep(side: DataFrame, own: DataFrame, other: DataFrame, met_above: DataFrame) -> DataFrame:
        packed = F.lit(0).cast("bigint")
        for k, c in enumerate(parts):
            packed = packed + F.shiftleft(F.col(c), AREA_BITS * k)
        placed = _in_areas(own, size).select(*keys, "fid", "_ac", "_ar", packed.cast("int").alias("_cells"))
        unpacked = {
            c: F.shiftright("_cells", AREA_BITS * k).bitwiseAND(F.lit(AREA - 1)).cast("bigint") for k, c in enumerate(parts)
        }
        met = placed.join(_occupied(other, keys, size), [*keys, "_ac", "_ar"]).withColumns(unpacked)
        own_bits = _bits(F.col("_x0"), F.col("_x1"))

        def touched(r: Column) -> Column:
            two = F.get("_touched", F.floor(r / 2).cast("int"))
            return F.call_function("shiftrightunsigned", two, (r % 2 * AREA).cast("int")).bitwiseAND(own_bits) != 0

        met = met.where(F.exists(F.sequence("_y0", "_y1"), touched))
        ids = met.select(*keys, "fid").unionByName(met_above).distinct()
        return side.join(ids, [*keys, "fid"], "left_semi")

    return keep(perf, *small, coarse[0]), keep(truth, *small[::-1], coarse[1])


def _level(box: Column, size: float) -> Column:
    """Coarsest-needed level: a box spans at most ``SPAN`` cells per axis there."""
    extent = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    steps = F.ceil(F.log2(F.greatest(extent / F.lit(size * SPAN), F.lit(1.0))) / LEVEL_STEP)
    return F.least(steps * LEVEL_STEP, F.lit(MAX_LEVEL)).cast("int")


def _oversize(side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coarse levels in use per key: a handful of integers per key that has any.

    Written once, so its size is known: while it is small, the sides get their
    levels where they are, without an exchange by key.
    """
    levels = side.where("_level > 0").groupBy(*keys).agg(F.collect_set("_level").alias("_coarser"))
    return materialize(levels, "coarse-levels")


def _place(side: DataFrame, size: float, slots: Column) -> DataFrame:
    """One row per (slot, level, cell) the box touches."""
    b = F.col("bbox")
    placed = side.withColumn("_at", F.explode(slots)).select(
        "*",
        F.col("_at.slot").alias("_slot"),
        F.col("_at.level").alias("_lv"),
        (F.lit(float(size)) * F.pow(F.lit(2.0), F.col("_at.level"))).alias("_size"),
    )
    placed = placed.withColumns(
        {
            "_c0": axis_cell(b["xmin"], F.col("_size")),
            "_r0": axis_cell(b["ymin"], F.col("_size")),
            "_c1": axis_cell(b["xmax"], F.col("_size")),
            "_r1": axis_cell(b["ymax"], F.col("_size")),
        }
    )
    return (
        placed.withColumn("_col", F.explode(F.sequence("_c0", "_c1")))
        .withColumn("_row", F.explode(F.sequence("_r0", "_r1")))
        .drop("_at", "_size", "_c0", "_r0", "_c1", "_r1", "_level", "_coarser")
    )


def _placed_sides(
    perf: DataFrame, truth: DataFrame, keys: Sequence[str], size: float, oversize: bool = True, any_cell: bool = False, square: float | None = None
) -> tuple[DataFrame, DataFrame, list[Column]]:
    """Both sides with a row per cell, columns prefixed, and the conditions of their join.

    A pair meets in the first square of ``GRAIN`` cells it shares if the covers meet, or
    with ``any_cell``, for semi joins, in each shared cell; boxes then travel only where a
    coarser level asks for them. ``square`` sets another size of the squares.
    """
    square = square or (size if any_cell else size * GRAIN)
    sides = [
        side.withColumn("_level", _level(F.col("bbox"), square) if oversize else F.lit(0))
        for side in (perf, truth)
    ]

    def slot(name: str, level: Column) -> Column:
        return F.struct(F.lit("ab".index(name)).cast("tinyint").alias("slot"), level.cast("int").alias("level"))

    own = F.col("_level")
    at_home = F.array(slot("a", own))
    if oversize:
        coarse_of_perf, coarse_of_truth = (_oversize(s, keys) for s in sides)
        p = sides[0].join(coarse_of_truth, list(keys), "left")
        g = sides[1].join(coarse_of_perf, list(keys), "left")

        def visits(name: str) -> Column:
            above = F.filter("_coarser", lambda lv: lv > own)
            return F.transform(above, lambda lv: slot(name, lv))

        # Most keys have no oversize feature; their rows take the short branch.
        plain = F.col("_coarser").isNull()
        p_slots = F.when(plain, at_home).otherwise(F.concat(at_home, visits("b")))
        host = F.filter(F.array(slot("b", own)), lambda s: s["level"] > 0)
        g_slots = F.when(plain & (own == 0), at_home).otherwise(
            F.concat(at_home, F.when(plain, F.array().cast("array<struct<slot:tinyint,level:int>>")).otherwise(visits("a")), host)
        )
    else:
        p, g = sides
        p_slots = g_slots = at_home

    placed_p = _place(p, square, p_slots)
    placed_g = _place(g, square, g_slots)
    if any_cell:
        placed_p, placed_g = (s.withColumn("bbox", F.when(F.col("_lv") > 0, F.col("bbox"))) for s in (placed_p, placed_g))
    join_cols = [*keys, "_slot", "_lv", "_col", "_row"]
    left = placed_p.select(
        *join_cols, *[F.col(c).alias(f"p_{c}") for c in placed_p.columns if c not in join_cols]
    )
    right = placed_g.select(
        *[F.col(c).alias(f"_g{c}") for c in join_cols],
        *[F.col(c).alias(f"g_{c}") for c in placed_g.columns if c not in join_cols],
    )
    on = [F.col(c) == F.col(f"_g{c}") for c in join_cols]
    a, b = F.col("p_bbox"), F.col("g_bbox")
    if not any_cell:
        # Covers begin at the boxes' corners, so they are not carried along.
        step = F.lit(float(square)) * F.pow(F.lit(2.0), F.col("_lv"))
        for at, lo in (("_col", "xmin"), ("_row", "ymin")):
            on.append(F.col(at) == F.greatest(axis_cell(a[lo], step), axis_cell(b[lo], step)))
    if oversize or not any_cell:
        # Boxes met in a square or at a coarser level count only if their covers meet at the base size too.
        for lo, hi in (("xmin", "xmax"), ("ymin", "ymax")):
            for c, d in ((a, b), (b, a)):
                meet = axis_cell(c[lo], size) <= axis_cell(d[hi], size)
                on.append((F.col("_lv") == 0) | meet if any_cell else meet)
    return left, right, on


def spatial_pairs(
    perf: DataFrame,
    truth: DataFrame,
    keys: Sequence[str],
    size: float,
    *,
    condition: Column | None = None,
    oversize: bool = True,
) -> DataFrame:
    """Performer and truth features of equal ``keys`` whose covers share a cell.

    Columns of the two sides come back prefixed ``p_`` and ``g_``; ``keys`` keep
    their names. The join is an equi-join on (keys, level, square of ``GRAIN``
    cells); the covers are compared there. A pair is emitted only in the first square
    the two share, so no pair de-duplication shuffle follows. Boxes too large for the base cell size are
    placed at a coarser level; smaller ones visit that level only for keys where
    the other side has such boxes. ``condition`` (over ``p_bbox``/``g_bbox``)
    is evaluated inside the join.
    """
    left, right, on = _placed_sides(perf, truth, keys, size, oversize)
    scratch = ("_slot", "_lv", "_col", "_row")
    out = left.join(right, on if condition is None else [*on, condition], "inner")
    return out.drop(*scratch, *[c for c in right.columns if c.startswith("_g")])


def score_boxes(pairs: DataFrame, predicate: str = "intersects") -> DataFrame:
    """Exact predicate and IoU on candidate pairs; a failed test keeps the row at 0."""
    p, g = F.col("p_bbox"), F.col("g_bbox")
    test = {"intersects": G.boxes_intersect, "overlaps": G.boxes_overlap}[predicate](p, g)
    return pairs.withColumn("success_overlap", test).withColumn(
        "iou_units",
        F.when(F.col("success_overlap"), G.box_iou_units(p, g)).otherwise(F.lit(0).cast("bigint")),
    )


def cell_index_table(
    features: DataFrame, keys: Sequence[str], ref: str = "fid", page_rows: int = 10_000
) -> DataFrame:
    """Per coarse and fine cell, the features found there, in bounded pages.

    ``coarse_cells``/``fine_cells`` are exploded as in the index file of the
    evaluation set. A crowded cell is cut into as many pages as its count needs,
    so that no list outgrows a row.
    """
    rows = features.select(*keys, F.explode("coarse_cells").alias("coarse_cell"), "fine_cells", ref)
    rows = rows.select(*keys, "coarse_cell", F.explode("fine_cells").alias("fine_cell"), ref)
    cell = [*keys, "coarse_cell", "fine_cell"]
    # Counted where the cell's rows already are, so they are made and exchanged once. Keys that are null are one page.
    here = F.count(F.lit(1)).over(Window.partitionBy(*cell))
    known = F.lit(True)
    for c in cell:
        known = known & F.col(c).isNotNull()
    pages = F.when(known, F.ceil(here / page_rows)).otherwise(1).cast("bigint")
    return (
        rows.withColumn("page", F.pmod(F.xxhash64(ref), pages))
        .groupBy(*cell, "page")
        .agg(F.array_sort(F.collect_list(ref)).alias("refs"))
    )


def near_squares(df: DataFrame, places: dict[str, str], reach: int, side: int) -> DataFrame:
    """Rows once per square of ``side`` that holds places within ``reach`` of theirs.

    ``places`` names the square's number per whole-number coordinate. Numbers are those
    of ``div``, so a place's own square is its coordinates ``div side``.
    """
    for at, square in places.items():
        within = F.expr(f"sequence((`{at}` - {reach}) div {side}, (`{at}` + {reach}) div {side})")
        df = df.withColumn(square, F.explode(within))
    return df


def z_order_layout(df: DataFrame, x: Column, y: Column, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the Z-order key of two integer columns."""
    from cartomark.functions.grid import morton

    keyed = df.withColumn("z_index", morton(x, y))
    ranged = (
        keyed.repartitionByRange(partitions, "z_index")
        if partitions
        else keyed.repartitionByRange("z_index")
    )
    return ranged.sortWithinPartitions("z_index")
