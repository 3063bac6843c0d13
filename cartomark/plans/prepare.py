"""Prepared tables: ground truth by label, and performer features with synopsis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions import nested as N
from cartomark.functions import projection as P
from cartomark.functions.text import strip_nonword


def to_geometry(kind: Column, rings: Column) -> Column:
    """Geometry struct from rings of coordinate arrays, third ordinates dropped."""
    return G.geometry(kind, F.transform(N.drop_z(rings), G.ring_from_pairs))


def reproject(geom: Column, code: Column, to_utm: bool) -> Column:
    """Every vertex from WGS-84 to the UTM system of ``code``, or back."""

    def move(p: Column) -> Column:
        return (
            P.wgs84_to_utm(p["y"], p["x"], code) if to_utm else P.utm_to_wgs84(p["x"], p["y"], code)
        )

    return G.geometry(geom["kind"], F.transform(geom["rings"], lambda ring: F.transform(ring, move)))


#: Parts that one edge is cut into at most.
MAX_PARTS = 4096


def reproject_edges(geom: Column, source: Column, target: Column, tolerance: float | Column) -> Column:
    """A geometry moved between systems, with vertices inserted where straight edges would bend.

    An edge whose middle lands ``d`` away from the middle of its moved ends is cut
    into ``sqrt(d / tolerance)`` parts, rounded up, as the deviation falls with the square of
    their number; ``tolerance`` is in units of the target. Edges stay whole between equal systems.
    """

    def move(points: Column) -> Column:
        return F.transform(points, lambda p: P.between_systems(p, source, target))

    def along(e: Column, t: Column) -> Column:
        a, b = e["a"], e["b"]
        return F.struct((a["x"] + (b["x"] - a["x"]) * t).alias("x"), (a["y"] + (b["y"] - a["y"]) * t).alias("y"))

    def parts(u: Column, m: Column, v: Column) -> Column:
        dx, dy = m["x"] - (u["x"] + v["x"]) / 2, m["y"] - (u["y"] + v["y"]) / 2
        n = F.ceil(F.sqrt(F.sqrt(dx * dx + dy * dy) / tolerance)).cast("int")
        return F.greatest(F.lit(1), F.least(F.lit(MAX_PARTS), n))

    def cut(ring: Column) -> Column:
        """The ring with all vertices that it needs, still in the source system."""
        first = F.slice(ring, F.lit(1), F.size(ring) - 1)
        edges = F.zip_with(first, F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        probes = move(F.flatten(F.transform(edges, lambda e: F.array(*[along(e, F.lit(t)) for t in (0.0, 0.5, 1.0)]))))
        counts = F.transform(F.array(probes), lambda m: F.transform(edges, lambda _, i: parts(m[i * 3], m[i * 3 + 1], m[i * 3 + 2])))
        counted = F.zip_with(edges, F.element_at(counts, 1), lambda e, n: F.struct(e["a"].alias("a"), e["b"].alias("b"), n.alias("n")))
        inner = F.transform(counted, lambda e: F.transform(F.sequence(F.lit(0), e["n"] - 1), lambda k: along(e, k / e["n"])))
        return F.concat(F.flatten(inner), F.slice(ring, F.lit(-1), F.lit(1)))

    whole = (geom["kind"] == "point") | (source == target)
    rings = F.transform(geom["rings"], lambda ring: F.when(whole | (F.size(ring) < 2), ring).otherwise(cut(ring)))
    return G.geometry(geom["kind"], F.transform(rings, move))


#: Deviation allowed for a moved edge: metres, and degrees of about as much.
METRES, DEGREES = 0.1, 1e-6


def into_systems(features: DataFrame, systems: DataFrame) -> DataFrame:
    """Features with ``epsg`` moved into the system that ``systems`` (id, epsg) has for their map.

    Geometry, box and ``epsg`` follow. Features of a map or a system that is not
    known stay as they are, so that a comparison can report them.
    """
    wanted = systems.groupBy("id").agg(F.min("epsg").alias("_epsg"))
    source, target = P.epsg_code(F.col("epsg")), P.epsg_code(F.col("_epsg"))
    goes = F.coalesce(P.is_known_system(source) & P.is_known_system(target) & (source != target), F.lit(False))
    moved = reproject_edges(F.col("geom"), source, target, F.when(target == 4326, DEGREES).otherwise(METRES))
    rows = features.join(wanted, "id", "left").withColumn("_goes", goes)
    rows = rows.withColumn("geom", F.when(F.col("_goes"), moved).otherwise(F.col("geom")))
    rows = rows.withColumns({"epsg": F.when(F.col("_goes"), F.col("_epsg")).otherwise(F.col("epsg")), "bbox": F.when(F.col("_goes"), G.geometry_box(F.col("geom"))).otherwise(F.col("bbox"))})
    return rows.select(*features.columns)


def truth_features(features: DataFrame, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ground-truth features per label, and label counts.

    ``features``: fid, id, field_name, value, geom_kind, geojson (type, coordinates);
    ``matches``: id, field_name, geo_value_vector, binary_value, matched_ratio.
    Multi-geometries are broken into parts before counting. Their cells are made
    by :func:`cartomark.operators.cover.compact_cover`.
    """
    parts = features.select(
        "*", F.posexplode(N.multi_parts(F.col("geojson"))).alias("part", "_g")
    ).drop("geojson")
    rings = N.geojson_rings(F.col("_g"), F.col("geom_kind"))
    parts = parts.select(
        F.concat_ws("#", "fid", "part").alias("fid"),
        "id",
        "field_name",
        F.col("value").alias("geo_value_vector"),
        F.col("geom_kind").alias("geom_type"),
        to_geometry(F.col("geom_kind"), rings).alias("geom"),
    )
    wanted = matches.select("id", "field_name", "geo_value_vector", "binary_value", "matched_ratio")
    labelled = parts.join(wanted.distinct(), ["id", "field_name", "geo_value_vector"]).withColumn(
        "geo_value", strip_nonword(F.col("geo_value_vector"))
    )
    labelled = labelled.withColumn("bbox", G.geometry_box(F.col("geom")))
    counts = (
        labelled.groupBy("id", "geo_value", "binary_value", "matched_ratio")
        .agg(F.count("*").alias("count"))
        .withColumn("match_binary", F.lit(True))
    )
    return labelled, counts


def performer_features(records: DataFrame, rasters: DataFrame, explode_rings: bool = False) -> DataFrame:
    """Feature rows of performer records with geometry, box and a stable key.

    ``records``: record, feature_type, source_file. The legend item's pixel box is
    carried as a map-space box through the raster's transform.
    """
    rows = N.with_data(N.projected_features(records, explode_rings))
    rows = rows.join(rasters.select("cog_id", "transform"), "cog_id", "left")
    rows = rows.withColumn("geom", to_geometry(F.col("feature_type"), F.col("rings")))
    return rows.withColumns(
        {
            "fid": F.sha2(
                F.to_json(
                    F.struct(
                        "cog_id", "system", "system_version", "feature_type", "abbreviation",
                        "feature_index", "ring_index", "rings",
                    )
                ),
                256,
            ),
            "bbox": G.geometry_box(F.col("geom")),
            "legend_box": G.pixel_box_to_coord(F.col("transform"), F.col("px_bbox")),
        }
    ).drop("transform", "rings")


FILE_KEYS = ["id", "cog_id", "system", "system_version", "feature_type"]


def synopsis(features: DataFrame) -> DataFrame:
    """Feature count and share per performer file, abbreviation and label."""
    counts = features.groupBy(*FILE_KEYS, "abbreviation", "geo_value").agg(
        F.count("*").alias("count"),
        F.max("matched_ratio").alias("matched_ratio"),
        F.bool_or("match_binary").alias("match_binary"),
    )
    totals = counts.groupBy(*FILE_KEYS).agg(F.sum("count").alias("_total"))
    return (
        counts.join(totals, FILE_KEYS)
        .withColumn("perc", F.col("count") / F.col("_total"))
        .drop("_total")
    )


def performer_schema(manifest: DataFrame, features: DataFrame, crs: DataFrame) -> DataFrame:
    """Status row per performer file.

    ``manifest``: file keys and message; ``crs``: cog_id, crs, crs_valid. The
    ``data`` value tells extracted from missing data and failed projections.
    """
    counts = features.groupBy(*FILE_KEYS).agg(F.count("*").alias("n_features"))
    rows = manifest.join(counts, FILE_KEYS, "left").join(crs, "cog_id", "left")
    n = F.coalesce("n_features", F.lit(0).cast("bigint"))
    data = (
        F.when(~F.col("message").eqNullSafe("success-done"), "no-data")
        .when(n == 0, "no-data extracted/missing features")
        .when(~F.coalesce("crs_valid", F.lit(False)), F.concat(F.lit("CRS failure - "), F.coalesce("crs", F.lit("none"))))
        .otherwise("extracted data")
    )
    return rows.select(*FILE_KEYS, "message", data.alias("data"), "crs", n.alias("n_features"))
