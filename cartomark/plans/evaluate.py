"""Scoring of performer features: candidates, IoU, pixel F1, best match.

Performer tables carry id, system columns, ``geo_value``, ``fid`` and ``bbox``;
truth tables carry id, ``geo_value``, ``fid`` and ``bbox``. Both may carry an
``epsg``, which then becomes part of the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions.geometry import USE_SPATIAL_INDEX
from cartomark.operators import blocks as B
from cartomark.operators import raster as R
from cartomark.operators.spatial import score_boxes, spatial_pairs
from cartomark.session import materialize

SYSTEM = ("system", "system_version")
MATCH = ("id", "geo_value")


def _axis_overlap(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    return F.greatest(F.least(high_a, high_b) - F.greatest(low_a, low_b) + 1, F.lit(0).cast("bigint"))


def box_pixel_counts(pairs: DataFrame, pixel: float) -> DataFrame:
    """Pixel counts of two boxes and of what they share, in closed form."""

    def at(value: Column) -> Column:
        return F.floor(value / F.lit(float(pixel))).cast("bigint")

    p = {c: at(F.col("p_bbox")[c]) for c in ("xmin", "ymin", "xmax", "ymax")}
    g = {c: at(F.col("g_bbox")[c]) for c in ("xmin", "ymin", "xmax", "ymax")}

    def size(b: dict[str, Column]) -> Column:
        return (b["xmax"] - b["xmin"] + 1) * (b["ymax"] - b["ymin"] + 1)

    shared = _axis_overlap(p["xmin"], p["xmax"], g["xmin"], g["xmax"]) * _axis_overlap(
        p["ymin"], p["ymax"], g["ymin"], g["ymax"]
    )
    return pairs.withColumns(
        {"true_positives": shared, "len_pdf": size(p), "len_gdf": size(g)}
    )


def best_match(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per performer feature its best truth feature and its number of candidates.

    One aggregation with map-side combine: highest IoU, then highest F1, then
    first truth feature, over the candidates that pass the predicate. A pair may
    stand for ``g_copies`` equal truth features.
    """
    pick = F.struct(
        (-F.col("iou_units")).alias("neg_iou"),
        (-F.col("f1")).alias("neg_f1"),
        F.col("g_fid").alias("g_fid"),
        *[F.col(c) for c in ("true_positives", "len_pdf", "len_gdf")],
    )
    best = pairs.groupBy(*keys, "p_fid").agg(
        (F.sum("g_copies") if "g_copies" in pairs.columns else F.count("*")).alias("num_cand_geom"),
        F.min(F.when(F.col("success_overlap"), pick)).alias("_best"),
    )
    return best.select(
        *keys,
        "p_fid",
        "num_cand_geom",
        F.col("_best.g_fid").alias("g_fid"),
        (-F.col("_best.neg_iou")).alias("iou_units"),
        *[F.col(f"_best.{c}").alias(c) for c in ("true_positives", "len_pdf", "len_gdf")],
    )


def _with_counts(best: DataFrame, perf: DataFrame, truth: DataFrame, group: Sequence[str], match: Sequence[str]) -> DataFrame:
    """Attach per-label feature counts and the number of performer candidates."""
    per_group = best.groupBy(*group).agg(F.count("*").alias("num_cand_perf"))
    inf = perf.groupBy(*group).agg(F.count("*").alias("inf_count"))
    grnd = truth.groupBy(*match).agg(F.count("*").alias("grnd_count"))
    counts = per_group.join(inf, list(group)).join(grnd, list(match))
    return best.where("g_fid is not null").join(counts, list(group))


def _distinct_boxes(perf: DataFrame, truth: DataFrame, match: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct boxes per label on either side; truth keeps its first key and number.

    A match depends on the box alone, so copies of one box are compared once,
    however many there are.
    """
    p = perf.select(*match, "bbox").distinct()
    g = truth.groupBy(*match, "bbox").agg(F.min("fid").alias("fid"), F.count("*").alias("copies"))
    return p, g


def _finish(rows: DataFrame) -> DataFrame:
    return R.with_f1(rows.withColumn("iou", G.iou_percent(F.col("iou_units"))))


def match_boxes(
    perf: DataFrame,
    truth: DataFrame,
    cell: float,
    pixel: float,
    match: Sequence[str],
    *,
    predicate: str = "intersects",
    oversize: bool = True,
) -> DataFrame:
    """Performer features with any candidate, their best match and candidate number.

    Distinct boxes of a label meet by cell, are reduced to the best match with a
    map-side combine, and the result is joined back to the features that have
    that box. ``g_fid`` is null where no candidate passes the predicate.
    """
    boxes_p, boxes_g = _distinct_boxes(perf, truth, match)
    pairs = spatial_pairs(boxes_p, boxes_g, match, cell, oversize=oversize)
    scored = R.with_f1(box_pixel_counts(score_boxes(pairs, predicate), pixel))
    best = best_match(scored.withColumn("p_fid", F.col("p_bbox")), match).withColumnRenamed("p_fid", "bbox")
    return perf.join(best, [*match, "bbox"]).withColumnRenamed("fid", "p_fid").drop("bbox")


def evaluate_boxes(
    perf: DataFrame,
    truth: DataFrame,
    cell: float,
    pixel: float,
    *,
    match: Sequence[str] = MATCH,
    predicate: str = "intersects",
    labelled: bool = True,
    oversize: bool = True,
) -> DataFrame:
    """Match metrics of axis-parallel features, one row per matched performer feature.

    Shuffles: each side once for its distinct boxes and once by (label keys,
    cell), candidate pairs by performer box after the combine, features by box,
    and the small count tables.
    """
    match = [*match, *(["epsg"] if "epsg" in perf.columns and "epsg" in truth.columns else [])]
    group = [*match, *[c for c in SYSTEM if c in perf.columns]]
    slim_p = perf.select(*group, "fid", "bbox")
    slim_g = truth.select(*match, "fid", "bbox")
    matched = match_boxes(slim_p, slim_g, cell, pixel, match, predicate=predicate, oversize=oversize)
    # Features without a match are only counted.
    matched = matched.withColumn("p_fid", F.when(F.col("g_fid").isNotNull(), F.col("p_fid")))
    # Read for the rows and again for the number of candidates per label; written, it is made once.
    matched = materialize(matched, "box-matches")
    rows = _finish(_with_counts(matched, slim_p, slim_g, group, match))
    return rows.withColumn("geo_value_query", F.lit(labelled))


def evaluate_unlabelled(perf: DataFrame, truth: DataFrame, cell: float, pixel: float, **options) -> DataFrame:
    """Features without a usable label, against every label of their map."""
    unknown = perf.where(F.col("geo_value") == USE_SPATIAL_INDEX)
    return evaluate_boxes(unknown, truth, cell, pixel, match=["id"], labelled=False, **options)


def evaluate_crude(perf: DataFrame, truth: DataFrame, cell: float, pixel: float, **options) -> DataFrame:
    """Whole files against truth of the same geometry kind (column ``feature_type``)."""
    return evaluate_boxes(
        perf, truth, cell, pixel, match=["id", "feature_type"], labelled=False, **options
    )


def unmatched_features(perf: DataFrame, metrics: DataFrame) -> DataFrame:
    """Performer features without a row in the metrics (false positives)."""
    found = metrics.select("id", F.col("p_fid").alias("fid"))
    return perf.join(found, ["id", "fid"], "left_anti")


def crs_mismatches(perf: DataFrame, truth: DataFrame) -> DataFrame:
    """Maps whose two sides are in different reference systems."""
    p = perf.select("id", F.col("epsg").alias("perf_epsg")).distinct()
    g = truth.select("id", F.col("epsg").alias("grnd_epsg")).distinct()
    return p.join(g, "id").where("perf_epsg <> grnd_epsg")


def to_pixels(features: DataFrame, rasters: DataFrame) -> DataFrame:
    """Add ``px_geom`` (whole-pixel vertices), image size and pixel width."""
    t = F.col("transform")

    def pixel(v: Column) -> Column:
        rc = G.coord_to_pixel(t, v["x"], v["y"])
        return F.struct(rc["col"].cast("double").alias("x"), rc["row"].cast("double").alias("y"))

    rings = F.transform(F.col("geom")["rings"], lambda ring: F.transform(ring, pixel))
    width = F.sqrt(F.abs(t["a"] * t["e"] - t["b"] * t["d"]))
    return (
        features.join(rasters.select("id", "transform", "width", "height", "total_pix"), "id")
        .withColumn("px_geom", G.geometry(F.col("geom")["kind"], rings))
        .withColumn("px_width", width)
        .drop("transform")
    )


def shape_key(geom: Column) -> Column:
    """The key under which equal geometries are compared once: 128 bits of hash.

    Hashes run over nested values without their borders and skip nulls, so ring
    lengths are hashed too and an unknown coordinate counts as NaN.
    """
    nan = F.lit(float("nan"))
    rings = F.transform(
        geom["rings"],
        lambda ring: F.transform(ring, lambda p: F.struct(F.coalesce(p["x"], nan).alias("x"), F.coalesce(p["y"], nan).alias("y"))),
    )
    parts = [geom["kind"], F.transform(geom["rings"], F.size), rings]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))


def evaluate_geometries(
    perf: DataFrame,
    truth: DataFrame,
    rasters: DataFrame,
    cell: float,
    *,
    scales: DataFrame | None = None,
    dynamic_buffer: float = 0.05,
    match: Sequence[str] = MATCH,
) -> DataFrame:
    """Match metrics of points, lines and polygons with full geometry.

    Points and lines are grown by the scale-dependent radius of ``scales`` (id,
    scale; of repeated ids the least scale counts); on maps without one they are
    compared as bare pixels. Boxes alone make the
    candidates; runs are made once per feature that has any, and IoU and F1 both
    come from the shared pixels.
    """
    group = [*match, *[c for c in SYSTEM if c in perf.columns]]
    rasters = rasters.dropDuplicates(["id"])

    def sized(side: DataFrame) -> DataFrame:
        if scales is None:
            return side.withColumn("_radius", F.lit(0.0))
        grown = F.when(
            F.col("geom")["kind"].isin("point", "line"),
            G.buffer_radius(F.col("scale"), dynamic_buffer),
        ).otherwise(F.lit(0.0))
        known = scales.groupBy("id").agg(F.min("scale").alias("scale"))
        return (
            side.join(known, "id", "left").withColumn("_radius", F.coalesce(grown, F.lit(0.0))).drop("scale")
        )

    def shaped(side: DataFrame) -> DataFrame:
        return sized(side).withColumn("shape", shape_key(F.col("geom")))

    perf, truth = shaped(perf), shaped(truth)
    shape_cols = [*match, "shape", "geom", "_radius"]
    # Read for the candidates and again for their pixels.
    shapes_p = materialize(perf.select(*shape_cols).distinct(), "shapes")
    shapes_g = materialize(
        truth.groupBy(*shape_cols).agg(F.min("fid").alias("fid"), F.count("*").alias("copies")), "shapes"
    )

    def boxed(shapes: DataFrame) -> DataFrame:
        grown = G.grown_box(G.geometry_box(F.col("geom")), F.col("_radius"))
        return shapes.withColumn("bbox", grown).drop("geom", "_radius")

    pairs = spatial_pairs(boxed(shapes_p), boxed(shapes_g), match, cell)
    meets = G.boxes_intersect(F.col("p_bbox"), F.col("g_bbox"))
    pairs = pairs.select(*match, "p_shape", "g_shape", "g_fid", "g_copies", meets.alias("_meets"))
    # Five branches read the pairs: which shapes to rasterise on either side, the
    # pixel join twice, and the candidate counts.
    pairs = materialize(pairs, "candidate-pairs")

    # A shape is rasterised on the image of its map, hence once per map, whichever side it is on.
    image = F.struct("id", "_shape")
    used = pairs.where("_meets").select("id", F.explode(F.array("p_shape", "g_shape")).alias("shape")).distinct()
    drawn = ["id", "shape", "geom", "_radius"]
    once = shapes_p.select(*drawn).unionByName(shapes_g.select(*drawn)).join(used, ["id", "shape"], "left_semi").distinct()
    px = to_pixels(once.withColumnRenamed("shape", "_shape"), rasters).withColumns(
        {"fid": image, "_px_radius": F.col("_radius") / F.col("px_width")}
    )
    blocks = B.outline_blocks(px.where("_radius = 0"), width="width", height="height")
    if scales is not None:
        grown = R.buffer_runs(px.where("_radius > 0"), "_px_radius", ["width", "height"], height="height")
        grown = R.clip_runs(grown, F.col("width"), F.col("height"))
        blocks = blocks.unionByName(B.run_blocks(grown.drop("width", "height")))
    # Read by the overlap and by the sizes, for either side.
    blocks = materialize(blocks, "pixel-blocks")

    def keyed(shape: str) -> Column:
        return F.struct("id", F.col(shape).alias("_shape"))

    meeting = pairs.where("_meets").select(keyed("p_shape").alias("p_fid"), keyed("g_shape").alias("g_fid")).distinct()
    scored = B.block_scores(meeting, blocks, blocks)
    tp = F.col("true_positives")
    union = (F.col("len_pdf") + F.col("len_gdf") - tp).cast("double")
    scored = scored.select(
        F.col("p_fid").alias("_p"), F.col("g_fid").alias("_g"),
        "true_positives", "len_pdf", "len_gdf", "f1",
        G.iou_units(tp.cast("double"), union).alias("iou_units"),
    )
    joined = (
        pairs.withColumns({"_p": keyed("p_shape"), "_g": keyed("g_shape")})
        .join(scored, ["_p", "_g"], "left")
        .withColumn("success_overlap", F.coalesce(F.col("true_positives") > 0, F.lit(False)))
    )
    best = best_match(joined.withColumn("p_fid", F.col("p_shape")), match).withColumnRenamed("p_fid", "shape")
    slim_p = perf.select(*group, "fid", "shape")
    matched = slim_p.join(best, [*match, "shape"]).withColumnRenamed("fid", "p_fid").drop("shape")
    rows = _with_counts(matched, slim_p, truth.select(*match, "fid"), group, list(match))
    return _finish(rows.join(rasters.select("id", "total_pix"), "id", "left"))
