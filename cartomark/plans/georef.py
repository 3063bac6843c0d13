"""Georeferencing: sampled pixels, affine fits, geodesic error and outcomes."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions import projection as P

#: Outcomes of an evaluation (fixed values).
SUCCESS = "success"
PERFORMER_BAD = "performer-Bad Transformer / Incompatible GCP format"
PERFORMER_MISSING = "performer-missing"
ANNOTATED_BAD = "annotated-Bad Transformer / Incompatible GCP format"
ANNOTATED_UNPARSED = "annotated-missing-GCP-parsing"
ANNOTATED_MISSING = "annotated-missing"
BOTH_MISSING = "annotated-performer-missing"


def fit_affine(gcps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least-squares ``x = a*col + b*row + c``, ``y = d*col + e*row + f`` per group.

    ``gcps``: keys, row, col, lon, lat. One pass of mergeable moments and a closed
    2x2 solve. ``transform`` is null for under three points, points on a line or
    any incomplete point; ``n_parsed`` counts complete points.
    """
    whole = (
        F.col("row").isNotNull() & F.col("col").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    )
    stats = gcps.groupBy(*keys).agg(
        F.count("*").alias("n_gcps"),
        F.count_if(whole).alias("n_parsed"),
        F.avg("col").alias("_mc"),
        F.avg("row").alias("_mr"),
        F.avg("lon").alias("_mx"),
        F.avg("lat").alias("_my"),
        F.var_pop("col").alias("_vcc"),
        F.var_pop("row").alias("_vrr"),
        F.covar_pop("col", "row").alias("_vcr"),
        F.covar_pop("col", "lon").alias("_vcx"),
        F.covar_pop("row", "lon").alias("_vrx"),
        F.covar_pop("col", "lat").alias("_vcy"),
        F.covar_pop("row", "lat").alias("_vry"),
    )
    v = {c: F.col(f"_v{c}") for c in ("cc", "rr", "cr", "cx", "rx", "cy", "ry")}
    det = v["cc"] * v["rr"] - v["cr"] * v["cr"]
    solvable = (
        (F.col("n_parsed") == F.col("n_gcps"))
        & (F.col("n_gcps") >= 3)
        & (det > v["cc"] * v["rr"] * 1e-9)
    )

    def axis(target: str) -> tuple[Column, Column, Column]:
        along_col = F.try_divide(v["c" + target] * v["rr"] - v["r" + target] * v["cr"], det)
        along_row = F.try_divide(v["r" + target] * v["cc"] - v["c" + target] * v["cr"], det)
        rest = F.col(f"_m{target}") - along_col * F.col("_mc") - along_row * F.col("_mr")
        return along_col, along_row, rest

    a, b, c = axis("x")
    d, e, f = axis("y")
    transform = F.struct(
        a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"), e.alias("e"), f.alias("f")
    )
    return stats.select(*keys, "n_gcps", "n_parsed", F.when(solvable, transform).alias("transform"))


def sample_axis(size: Column, key: Column, axis: str, k: int, seed: int) -> Column:
    """``k`` distinct numbers of ``1..size``, the same on every run and retry."""
    drawn = F.transform(
        F.sequence(F.lit(1).cast("bigint"), size.cast("bigint")),
        lambda v: F.struct(
            F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(axis), v.cast("string"))).alias("h"),
            v.alias("v"),
        ),
    )
    return F.transform(F.slice(F.array_sort(drawn), 1, k), lambda s: s["v"])


def sample_pixels(rasters: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """``k`` random pixels per raster, without replacement, as rows ``(id, k, row, col)``.

    Drawn inside each raster's row, so nothing is shuffled.
    """
    rows = sample_axis(F.col("height"), F.col("id"), "row", k, seed)
    cols = sample_axis(F.col("width"), F.col("id"), "col", k, seed)
    pairs = F.arrays_zip(rows.alias("row"), cols.alias("col"))
    return rasters.select("*", F.posexplode(pairs).alias("k", "_px")).select(
        *rasters.columns,
        (F.col("k") + 1).cast("bigint").alias("k"),
        F.col("_px.row").alias("random_pix_height"),
        F.col("_px.col").alias("random_pix_width"),
    )


def sampled_points(rasters: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """Sampled pixels with their map, degree and projected points.

    ``rasters``: id, width, height, transform, crs. Degrees and proj4 systems are
    re-projected to the UTM zone of the point; other systems stay as they are.
    """
    px = sample_pixels(rasters, k, seed)
    at = G.pixel_to_coord(F.col("transform"), F.col("random_pix_height"), F.col("random_pix_width"))
    facts = P.crs_facts(F.col("crs"))
    rows = px.withColumns({"orig_pnt": at, "_f": facts})
    code = P.epsg_code(F.col("_f.epsg"))
    is_utm = code.between(32601, 32660) | code.between(32701, 32760)
    deci = F.when(code == 4326, F.col("orig_pnt")).when(
        is_utm, P.utm_to_wgs84(F.col("orig_pnt.x"), F.col("orig_pnt.y"), code)
    )
    rows = rows.withColumn("deci_pnt", deci)
    moved = F.col("_f.needs_reprojection")
    new_epsg = F.when(moved, P.utm_epsg(F.col("deci_pnt.y"), F.col("deci_pnt.x"))).otherwise(F.col("_f.epsg"))
    rows = rows.withColumn("proj_epsg", new_epsg)
    proj = F.when(
        moved, P.wgs84_to_utm(F.col("deci_pnt.y"), F.col("deci_pnt.x"), P.epsg_code(F.col("proj_epsg")))
    ).otherwise(F.col("orig_pnt"))
    return rows.withColumns(
        {
            "proj_pnt": proj,
            "orig_epsg": F.col("_f.epsg"),
            "orig_unit": F.col("_f.unit"),
            "proj_unit": F.when(moved, F.lit("metre")).otherwise(F.col("_f.unit")),
            "same_epsgs": ~moved,
        }
    ).drop("_f")


def preferred_annotation(gcps: DataFrame, annotated: DataFrame) -> DataFrame:
    """Per map the first listed annotated system that has any GCP there.

    ``annotated``: priority, system, system_version.
    """
    present = gcps.select("cog_id", "system", "system_version").distinct()
    ranked = present.join(annotated, ["system", "system_version"])
    pick = F.min(F.struct("priority", "system", "system_version"))
    return ranked.groupBy("cog_id").agg(pick.alias("_p")).select(
        "cog_id",
        F.col("_p.system").alias("annotated_system"),
        F.col("_p.system_version").alias("annotated_version"),
    )


def presence(gcps: DataFrame, systems: DataFrame) -> DataFrame:
    """Per map whether annotated and performer points exist (``systems`` has ``role``)."""
    roles = gcps.join(systems.select("system", "system_version", "role").distinct(), ["system", "system_version"])
    return roles.groupBy("cog_id").agg(
        F.bool_or(F.col("role") == "annotated").alias("has_annotated"),
        F.bool_or(F.col("role") == "performer").alias("has_performer"),
    )


def distance_km(method: str):
    return {"geodesic": functools.partial(G.geodesic_km, near_antipode=True), "haversine": G.haversine_km}[method]


def evaluate_georeferencing(
    samples: DataFrame, gcps: DataFrame, systems: DataFrame, method: str = "geodesic"
) -> DataFrame:
    """RMSE in km per map and performer, with the outcome of each evaluation.

    ``samples``: cog_id, k, random_pix_height, random_pix_width; ``gcps``: cog_id,
    system, system_version, row, col, lon, lat; ``systems``: role, priority,
    system, system_version. Every map of ``samples`` appears.
    """
    fits = fit_affine(gcps, ["cog_id", "system", "system_version"])
    maps = samples.select("cog_id").distinct()
    annotated = systems.where("role = 'annotated'")
    performers = systems.where("role = 'performer'")
    wanted = performers.agg(
        F.collect_set(F.struct("system", "system_version")).alias("p")
    ).scalar()

    ann_fits = fits.select(
        "cog_id",
        F.col("system").alias("annotated_system"),
        F.col("system_version").alias("annotated_version"),
        F.col("n_parsed").alias("_ann_parsed"),
        F.col("transform").alias("_ann"),
    )
    base = (
        maps.join(presence(gcps, systems), "cog_id", "left")
        .join(preferred_annotation(gcps, annotated), "cog_id", "left")
        .join(ann_fits, ["cog_id", "annotated_system", "annotated_version"], "left")
    )
    has_ann = F.coalesce("has_annotated", F.lit(False))
    has_perf = F.coalesce("has_performer", F.lit(False))
    base = base.withColumn(
        "_map_log",
        F.when(~has_ann & ~has_perf, BOTH_MISSING)
        .when(~has_ann, ANNOTATED_MISSING)
        .when(~has_perf, PERFORMER_MISSING)
        .when(F.col("_ann_parsed") == 0, ANNOTATED_UNPARSED)
        .when(F.col("_ann").isNull(), ANNOTATED_BAD),
    )
    # Maps settled as a whole keep one row; the others get one per performer.
    none = F.array(F.lit(None).cast("struct<system:string,system_version:string>"))
    rows = base.withColumn(
        "_performer", F.explode(F.when(F.col("_map_log").isNull(), wanted).otherwise(none))
    ).select(
        "*",
        F.col("_performer.system").alias("performer"),
        F.col("_performer.system_version").alias("performer_version"),
    )
    perf_fits = fits.select(
        "cog_id",
        F.col("system").alias("performer"),
        F.col("system_version").alias("performer_version"),
        F.col("n_gcps").alias("_perf_gcps"),
        F.col("transform").alias("_perf"),
    )
    rows = rows.join(perf_fits, ["cog_id", "performer", "performer_version"], "left").withColumn(
        "log",
        F.coalesce(
            "_map_log",
            F.when(F.col("_perf_gcps").isNull(), PERFORMER_MISSING)
            .when(F.col("_perf").isNull(), PERFORMER_BAD)
            .otherwise(SUCCESS),
        ),
    )
    keys = ["cog_id", "performer", "performer_version"]
    errors = sample_errors(rows.where(F.col("log") == SUCCESS).select(*keys, "_ann", "_perf"), samples, method)
    scored = rmse(errors, keys)
    same = (
        (F.col("cog_id") == F.col("_s.cog_id"))
        & (F.col("performer") == F.col("_s.performer"))
        & (F.col("performer_version") == F.col("_s.performer_version"))
    )
    return (
        rows.join(scored.select(F.struct("*").alias("_s")), same, "left")
        .select(
            "cog_id", "annotated_system", "annotated_version", "performer", "performer_version", "log",
            *[F.col(f"_s.{c}").alias(c) for c in ("rmse", "geodesic_pnts", "annotated_pnts", "performer_pnts", "sample_pnts")],
        )
    )


def sample_errors(fitted: DataFrame, samples: DataFrame, method: str) -> DataFrame:
    """Distance of each sampled pixel under two transforms (``_ann``, ``_perf``)."""
    px = samples.select("cog_id", "k", "random_pix_height", "random_pix_width")
    row, col = F.col("random_pix_height"), F.col("random_pix_width")
    pts = fitted.join(px, "cog_id").withColumns(
        {
            "annotated_pnt": G.pixel_to_coord(F.col("_ann"), row, col),
            "performer_pnt": G.pixel_to_coord(F.col("_perf"), row, col),
        }
    )
    km = distance_km(method)(
        F.col("annotated_pnt.y"), F.col("annotated_pnt.x"), F.col("performer_pnt.y"), F.col("performer_pnt.x")
    )
    return pts.withColumn("km", km).drop("_ann", "_perf")


def rmse(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Root mean square of ``km`` per group, with the sampled points in order of ``k``.

    Null where a distance is unknown: a mean over fewer points than stated would mislead.
    """
    lists = F.array_sort(F.collect_list(F.struct("k", "km", "annotated_pnt", "performer_pnt")))
    out = errors.groupBy(*keys).agg(
        F.when(F.count("km") == F.count("*"), F.sqrt(F.avg(F.col("km") * F.col("km")))).alias("rmse"),
        F.count("*").alias("sample_pnts"),
        lists.alias("_l"),
    )
    return out.select(
        *keys,
        "rmse",
        F.transform("_l", lambda s: s["km"]).alias("geodesic_pnts"),
        F.transform("_l", lambda s: s["annotated_pnt"]).alias("annotated_pnts"),
        F.transform("_l", lambda s: s["performer_pnt"]).alias("performer_pnts"),
        "sample_pnts",
    )


def planar_rmse(points: DataFrame, keys: Sequence[str], units: DataFrame) -> DataFrame:
    """Planar RMSE per map in its own unit and in km.

    ``points``: keys, unit, x, y, pred_x, pred_y; ``units``: unit, metres.
    """
    dx, dy = F.col("x") - F.col("pred_x"), F.col("y") - F.col("pred_y")
    per_map = points.groupBy(*keys, "unit").agg(F.sqrt(F.avg(dx * dx + dy * dy)).alias("rmse"))
    return per_map.join(units, "unit", "left").withColumn(
        "rmse_km", F.col("rmse") * F.col("metres") / F.lit(1000.0)
    )


def rmse_summary(per_map: DataFrame, value: str = "rmse_km") -> DataFrame:
    """Count, min, max, standard deviation, mean and median over maps."""
    return per_map.agg(
        F.count(value).alias("count"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.stddev_samp(value).alias("std"),
        F.avg(value).alias("mean"),
        F.median(value).alias("median"),
    )


def georeferencing_report(metrics: DataFrame, eval_set: DataFrame) -> DataFrame:
    """Outcomes joined with the map facts of the evaluation set, lists left out."""
    slim = metrics.drop("geodesic_pnts", "annotated_pnts", "performer_pnts")
    return slim.join(eval_set.dropDuplicates(["cog_id"]), "cog_id")
