"""Rasterising as rows of pixel runs, and pixel-set overlap of pairs.

A run ``(fid, row, c0, c1)`` stands for the pixels ``c0..c1`` of one image row, so
work grows with outline length and row count, never with area, and no dense mask
exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.functions import geometry as G

_RUNS = "array<struct<c0:bigint,c1:bigint>>"


def _nearest(value: Column) -> Column:
    return F.floor(value + 0.5).cast("bigint")


def _run(c0: Column, c1: Column) -> Column:
    return F.struct(c0.cast("bigint").alias("c0"), c1.cast("bigint").alias("c1"))


def merge_runs(runs: Column) -> Column:
    """Sort runs and join those that overlap or touch."""

    def absorb(done: Column, run: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        grows = F.size(done) > 0
        joined = F.concat(
            F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
            F.array(_run(last["c0"], F.greatest(last["c1"], run["c1"]))),
        )
        return F.when(grows & (run["c0"] <= last["c1"] + 1), joined).otherwise(
            F.concat(done, F.array(run))
        )

    return F.aggregate(F.array_sort(runs), F.array().cast(_RUNS), absorb)


def _interior_runs(crossings: Column, first: callable, last: callable) -> Column:
    """Even-odd fill: runs between the 1st and 2nd, 3rd and 4th, ... crossing."""
    xs = F.array_sort(crossings)
    pairs = F.transform(
        F.sequence(F.lit(1), F.floor(F.size(xs) / 2).cast("int")),
        lambda i: _run(first(F.element_at(xs, i * 2 - 1)), last(F.element_at(xs, i * 2))),
    )
    inside = F.filter(pairs, lambda r: r["c0"] <= r["c1"])
    return F.when(F.size(xs) >= 2, inside).otherwise(F.array().cast(_RUNS))


def _crossing_x(row_y: Column) -> Column:
    slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    return F.col("x1") + (row_y - F.col("y1")) * slope


def _rows_between(low: Column, high: Column, height: str | None) -> Column:
    """Row numbers from ``low`` to ``high``, none outside an image of ``height`` rows."""
    if height is not None:
        low, high = F.greatest(low, F.lit(0).cast("bigint")), F.least(high, F.col(height).cast("bigint") - 1)
    return F.when(low <= high, F.sequence(low, high))


#: Image rows of a band, whose edges meet in one task.
BAND_ROWS = 64


def _in_bands(edges: DataFrame, keep: Sequence[str], height: str | None) -> DataFrame:
    """Edges once per band of image rows they cross (``_band``), those of a feature's band together."""
    low, high = _nearest(F.least("y1", "y2")), _nearest(F.greatest("y1", "y2"))
    first, last = (F.floor(at / BAND_ROWS).cast("bigint") for at in (low, high))
    if height is not None:
        top = F.floor((F.col(height).cast("bigint") - 1) / BAND_ROWS).cast("bigint")
        first, last = F.greatest(first, F.lit(0).cast("bigint")), F.least(last, top)
    bands = F.when(first <= last, F.sequence(first, last))
    return edges.withColumn("_band", F.explode(bands)).repartition(*keep, "_band")


def edge_rows(
    features: DataFrame, keep: Sequence[str], geom: str, height: str | None = None, together: bool = False, eights: bool = False
) -> DataFrame:
    """``keep, row, _run, _x``: each edge cut by image row, before any grouping.

    ``_run`` has the outline's pixels in that row (none where ``c0 > c1``) and
    ``_x`` the place where a polygon's edge crosses it, if it does. Given the image
    ``height`` (a column), rows outside it are never unfolded. ``together`` adds
    ``_band`` and brings each feature's band to one task before rows unfold. With
    ``eights`` an upright edge, alike in all rows, comes once per eight image rows:
    it holds from ``row`` to ``_to``, and ``_x`` from ``_from_x`` to ``_to_x``.
    """
    is_polygon = F.col(geom)["kind"] == "polygon"
    segments = F.when(
        F.col(geom)["kind"] == "point",
        F.transform(
            F.flatten(F.col(geom)["rings"]),
            lambda p: F.struct(
                p["x"].alias("x1"), p["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2")
            ),
        ),
    ).otherwise(G.geometry_segments(F.col(geom)))
    edges = features.select(*keep, is_polygon.alias("_fill"), F.inline(segments))

    low_y, high_y = F.least("y1", "y2"), F.greatest("y1", "y2")
    from_row, to_row, out = _nearest(low_y), _nearest(high_y), list(keep)
    if together:
        edges, out = _in_bands(edges, keep, height), [*keep, "_band"]
        from_row = F.greatest(from_row, F.col("_band") * BAND_ROWS)
        to_row = F.least(to_row, F.col("_band") * BAND_ROWS + (BAND_ROWS - 1))
    flat = F.col("y1") == F.col("y2")
    if eights:
        upright = ~flat & (F.col("x1") == F.col("x2"))
        if height is not None:
            from_row, to_row = F.greatest(from_row, F.lit(0).cast("bigint")), F.least(to_row, F.col(height).cast("bigint") - 1)
        edges = edges.withColumns({"_upright": upright, "_low": from_row, "_high": to_row}).where("_low <= _high")
        steps = F.when(F.col("_upright"), F.expr("sequence(shiftright(_low, 3), shiftright(_high, 3))")).otherwise(F.expr("sequence(_low, _high)"))
        rows = edges.withColumn("_step", F.explode(steps)).withColumns(
            {
                "row": F.expr("if(_upright, greatest(_low, _step * 8), _step)"),
                "_to": F.expr("if(_upright, least(_high, _step * 8 + 7), _step)"),
            }
        )
    else:
        rows = edges.withColumn("row", F.explode(_rows_between(from_row, to_row, height)))
    y = F.col("row").cast("double")
    low_x, high_x = F.least("x1", "x2"), F.greatest("x1", "x2")
    steep = (high_y - low_y) >= (high_x - low_x)
    at_row = F.when(flat, F.col("x1")).otherwise(
        _crossing_x(F.greatest(low_y, F.least(high_y, y)))
    )
    # A shallow edge owns the columns where its height rounds to this row.
    slab_low = F.greatest(y - 0.5, low_y)
    slab_high = F.least(y + 0.5, high_y)
    xa, xb = _crossing_x(slab_low), _crossing_x(slab_high)
    shallow_from = F.ceil(F.round(F.least(xa, xb), 9))
    shallow_to = F.floor(F.round(F.greatest(xa, xb), 9))
    run = (
        F.when(flat, _run(_nearest(low_x), _nearest(high_x)))
        .when(steep, _run(_nearest(at_row), _nearest(at_row)))
        .otherwise(_run(shallow_from, shallow_to))
    )
    crosses = F.col("_fill") & ~flat & (y >= low_y) & (y < high_y)
    if eights:
        # An upright edge crosses the rows from its lower end to before its upper one.
        first = F.when(F.col("_upright"), F.greatest("row", F.ceil(low_y).cast("bigint"))).otherwise(F.col("row"))
        last = F.when(F.col("_upright"), F.least("_to", F.ceil(high_y).cast("bigint") - 1)).otherwise(F.col("row"))
        crosses = F.when(F.col("_upright"), F.col("_fill") & (first <= last)).otherwise(crosses)
        return rows.select(*out, "row", "_to", run.alias("_run"), F.when(crosses, _crossing_x(y)).alias("_x"), first.alias("_from_x"), last.alias("_to_x"))
    return rows.select(*out, "row", run.alias("_run"), F.when(crosses, _crossing_x(y)).alias("_x"))


def outline_runs(
    features: DataFrame, carry: Sequence[str] = (), geom: str = "px_geom", height: str | None = None
) -> DataFrame:
    """Runs of polygons (filled), lines and points given in whole-pixel coordinates.

    The outline takes the pixel nearest to it on every step of its major axis;
    a polygon adds the pixels inside by the even-odd rule over all its rings.
    Edges are cut into bands of image rows, which are dealt out, and there into one
    row per image row: a large outline spreads over many tasks, and no image row
    travels. Given the image ``height`` (a
    carried column), rows outside it are never unfolded.
    """
    keep = ["fid", *carry]
    per_row = (
        edge_rows(features, keep, geom, height, together=True)
        .groupBy(*keep, "_band", "row")
        .agg(F.collect_list("_run").alias("_edges"), F.collect_list("_x").alias("_xs"))
    )
    inside = _interior_runs(F.col("_xs"), F.ceil, F.floor)
    outline = F.filter("_edges", lambda r: r["c0"] <= r["c1"])
    return per_row.select(*keep, "row", F.inline(merge_runs(F.concat(outline, inside))))


def box_runs(
    features: DataFrame, pixel: float, carry: Sequence[str] = (), box: str = "bbox", stacked: bool = False
) -> DataFrame:
    """Runs of axis-parallel boxes: closed form, no shuffle.

    ``stacked`` gives equal runs of a band of ``BAND_ROWS`` image rows as one row,
    from ``row`` to ``to_row``.
    """
    b = F.col(box)

    def at(value: Column) -> Column:
        return F.floor(value / F.lit(float(pixel))).cast("bigint")

    if stacked:
        low, high = F.least(at(b["ymin"]), at(b["ymax"])), F.greatest(at(b["ymin"]), at(b["ymax"]))
        known = b["ymin"].isNotNull() & b["ymax"].isNotNull()
        bands = F.sequence(F.floor(low / BAND_ROWS).cast("bigint"), F.floor(high / BAND_ROWS).cast("bigint"))
        stacks = features.select(
            "fid", *carry, low.alias("_low"), high.alias("_high"), at(b["xmin"]).alias("c0"), at(b["xmax"]).alias("c1"), F.explode(F.when(known, bands)).alias("_band")
        )
        first = F.col("_band") * BAND_ROWS
        return stacks.select(
            "fid", *carry, F.greatest("_low", first).alias("row"), F.least("_high", first + (BAND_ROWS - 1)).alias("to_row"), "c0", "c1"
        )
    return features.select(
        "fid",
        *carry,
        F.explode(F.sequence(at(b["ymin"]), at(b["ymax"]))).alias("row"),
        at(b["xmin"]).alias("c0"),
        at(b["xmax"]).alias("c1"),
    )


def buffer_runs(
    features: DataFrame,
    radius: str,
    carry: Sequence[str] = (),
    geom: str = "px_geom",
    height: str | None = None,
) -> DataFrame:
    """Runs of pixels whose centre lies within ``radius`` pixels of a point or line.

    The neighbourhood of one segment is convex, so each row holds one run per
    segment: from the leftmost to the rightmost end of its two discs and band.
    """
    keep = ["fid", *carry]
    segments = F.when(
        F.col(geom)["kind"] == "point",
        F.transform(
            F.flatten(F.col(geom)["rings"]),
            lambda p: F.struct(
                p["x"].alias("x1"), p["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2")
            ),
        ),
    ).otherwise(G.geometry_segments(F.col(geom)))
    seg = features.select(*keep, F.col(radius).cast("double").alias("_r"), F.inline(segments))
    r = F.col("_r")
    rows = seg.withColumn(
        "row",
        F.explode(
            _rows_between(
                F.ceil(F.least("y1", "y2") - r).cast("bigint"),
                F.floor(F.greatest("y1", "y2") + r).cast("bigint"),
                height,
            )
        ),
    )
    y = F.col("row").cast("double")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = F.sqrt(dx * dx + dy * dy)

    def disc(cx: str, cy: str) -> Column:
        gap = y - F.col(cy)
        half = F.sqrt(r * r - gap * gap)
        return F.when(F.abs(gap) <= r, F.array(F.col(cx) - half, F.col(cx) + half))

    def side(sign: float) -> Column:
        # Where this row meets the long side of the band, offset by the radius.
        ox = F.lit(sign) * r * F.try_divide(-dy, length)
        oy = F.lit(sign) * r * F.try_divide(dx, length)
        t = F.try_divide(y - (F.col("y1") + oy), dy)
        return F.when((t >= 0) & (t <= 1), F.array(F.col("x1") + ox + t * dx))

    ends = F.flatten(
        F.filter(
            F.array(disc("x1", "y1"), disc("x2", "y2"), side(1.0), side(-1.0)),
            lambda a: a.isNotNull(),
        )
    )
    spans = (
        rows.withColumn("_ends", ends)
        .where(F.size("_ends") > 0)
        .select(*keep, "row", _run(F.ceil(F.array_min("_ends")), F.floor(F.array_max("_ends"))).alias("_run"))
        .where("_run.c0 <= _run.c1")
    )
    return (
        spans.groupBy(*keep, "row")
        .agg(F.collect_list("_run").alias("_runs"))
        .select(*keep, "row", F.inline(merge_runs(F.col("_runs"))))
    )


def clip_runs(runs: DataFrame, width: Column, height: Column) -> DataFrame:
    """Cut runs to an image of the given size."""
    return (
        runs.where((F.col("row") >= 0) & (F.col("row") < height))
        .withColumn("c0", F.greatest("c0", F.lit(0)))
        .withColumn("c1", F.least("c1", (width - 1).cast("bigint")))
        .where("c0 <= c1")
    )


def run_pixels(runs: DataFrame) -> DataFrame:
    """One row per pixel, for joins with other pixel tables."""
    cols = [c for c in runs.columns if c not in ("c0", "c1")]
    return runs.select(*cols, F.explode(F.sequence("c0", "c1")).alias("col"))


def _rows_of(runs: DataFrame) -> Column:
    """Image rows a run stands for: one, or those of its stack."""
    return F.col("to_row") - F.col("row") + 1 if "to_row" in runs.columns else F.lit(1).cast("bigint")


def run_sizes(runs: DataFrame, keys: Sequence[str] = ("fid",)) -> DataFrame:
    return runs.groupBy(*keys).agg(F.sum((F.col("c1") - F.col("c0") + 1) * _rows_of(runs)).alias("pixels"))


def pixel_overlap(
    pairs: DataFrame, perf_runs: DataFrame, truth_runs: DataFrame, pair_keys: Sequence[str] = ("p_fid", "g_fid")
) -> DataFrame:
    """Shared pixels per pair: runs meet on (feature, row), stacks of them on (feature, band); their overlaps are summed."""
    p, g = pair_keys
    stacked = "to_row" in perf_runs.columns and "to_row" in truth_runs.columns
    at = "_band" if stacked else "row"

    def placed(runs: DataFrame, fid: str, **names: str) -> DataFrame:
        if stacked:
            # A stack lies within one band.
            runs = runs.withColumn("_band", F.floor(F.col("row") / BAND_ROWS).cast("bigint"))
        return runs.select(F.col("fid").alias(fid), at, *[F.col(c).alias(to) for to, c in names.items()])

    spans = {"c0": "c0", "c1": "c1"} | ({"row": "row", "to_row": "to_row"} if stacked else {})
    p_rows = pairs.select(p, g).join(placed(perf_runs, p, **spans), p)
    g_rows = placed(truth_runs, g, **{f"_g_{to}": c for to, c in spans.items()})
    shared = F.least("c1", "_g_c1") - F.greatest("c0", "_g_c0") + 1
    met = p_rows.join(g_rows, [g, at]).where(shared > 0)
    if stacked:
        common = F.least("to_row", "_g_to_row") - F.greatest("row", "_g_row") + 1
        met, shared = met.where(common > 0), shared * common
    return met.groupBy(p, g).agg(F.sum(shared).alias("true_positives"))


def pixel_scores(
    pairs: DataFrame, perf_runs: DataFrame, truth_runs: DataFrame
) -> DataFrame:
    """Precision, recall and F1 of each pair's pixel sets, with the outcome message."""
    return overlap_scores(
        pairs, pixel_overlap(pairs, perf_runs, truth_runs), run_sizes(perf_runs), run_sizes(truth_runs)
    )


def overlap_scores(pairs: DataFrame, shared: DataFrame, perf_sizes: DataFrame, truth_sizes: DataFrame) -> DataFrame:
    """The same from counts: ``true_positives`` per pair, ``pixels`` per feature."""
    p_size = perf_sizes.select(F.col("fid").alias("p_fid"), F.col("pixels").alias("_lp"))
    g_size = truth_sizes.select(F.col("fid").alias("g_fid"), F.col("pixels").alias("_lg"))
    wide = (
        # By performer first: the overlap deals the pairs out in the same way.
        pairs.join(p_size, "p_fid", "left")
        .join(g_size, "g_fid", "left")
        .join(shared, ["p_fid", "g_fid"], "left")
        .select("g_fid", "p_fid", *[c for c in pairs.columns if c not in ("p_fid", "g_fid")], "true_positives", "_lp", "_lg")
        .withColumns(
            {
                "true_positives": F.coalesce("true_positives", F.lit(0).cast("bigint")),
                "len_pdf": F.coalesce("_lp", F.lit(0).cast("bigint")),
                "len_gdf": F.coalesce("_lg", F.lit(0).cast("bigint")),
            }
        )
        .drop("_lp", "_lg")
    )
    return with_f1(wide)


def with_f1(df: DataFrame) -> DataFrame:
    """Add precision, recall, f1 and f1_message from the three pixel counts."""
    tp, lp, lg = F.col("true_positives"), F.col("len_pdf"), F.col("len_gdf")
    return df.withColumns(
        {
            "precision": F.when(lp > 0, tp / lp).otherwise(F.lit(0.0)),
            "recall": F.when(lg > 0, tp / lg).otherwise(F.lit(0.0)),
            "f1": F.when(tp > 0, tp * 2 / (lp + lg)).otherwise(F.lit(0.0)),
            "f1_message": F.when((lp == 0) & (lg == 0), "zero-p_df & g_df")
            .when(lp == 0, "zero-p_df")
            .when(lg == 0, "zero-g_df")
            .when(tp == 0, "no-overlap")
            .otherwise("success-f1"),
        }
    )


def pixel_grid(rasters: DataFrame, band_rows: int = 256) -> DataFrame:
    """Every pixel of every raster with its map position.

    Rows are cut into bands that are spread over the cluster before the columns
    are unfolded.
    """
    bands = rasters.withColumn(
        "_band",
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("height") / band_rows).cast("int") - 1)),
    ).repartition("id", "_band")
    first = F.col("_band") * band_rows
    rows = bands.withColumn(
        "row",
        F.explode(F.sequence(first, F.least(first + band_rows, F.col("height").cast("int")) - 1)),
    ).drop("_band")
    pixels = rows.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("width").cast("int") - 1)))
    at = G.pixel_to_coord(F.col("transform"), F.col("row"), F.col("col"))
    return pixels.withColumn("_at", at).select("id", "row", "col", "_at.x", "_at.y")
