"""The four jobs a user runs, from landed tables to written results.

1. :func:`prepare_truth` - vector features and raster labels to labelled truth.
2. :func:`convert_performers` - landed result pages to labelled features.
3. :func:`evaluate_features` - routes, matches and match metrics.
4. :func:`evaluate_maps` - georeferencing error per map and performer.

Each returns a dict of DataFrames by table name; :func:`write_tables` stores them.
Feature kinds are a column throughout, so one plan serves all of them. A result
that several tables build on is written once to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions import nested as N
from cartomark.functions.geometry import USE_SPATIAL_INDEX
from cartomark.operators import cover
from cartomark.plans import evaluate, georef, labels, orchestrate, prepare
from cartomark.session import materialize
from cartomark.sources import writers


#: Label under which features without a usable one meet all truth of a map.
ANY_LABEL = "*"


def prepare_truth(
    features: DataFrame,
    raster_labels: DataFrame,
    ontology: DataFrame,
    *,
    cell: float,
    threshold: float = 0.9,
) -> dict[str, DataFrame]:
    """Match raster labels to field values and cut the truth by label.

    ``features``: fid, id, shp_file, field_name, field_pos, value, geom_kind,
    read_corrupt and geojson, one row per feature and text field.
    ``raster_labels``: id, binary_value. The table ``cover`` has the cells of
    the truth, ``cell`` wide at the base.
    """
    values = features.select(
        "id", "shp_file", "geom_kind", "field_name", "field_pos", "value", "read_corrupt"
    ).distinct()
    matches = materialize(
        labels.match_field_values(raster_labels, values, ontology, threshold), "label-matches"
    )
    unmatched = labels.unmatched_labels(raster_labels, matches)
    corrupt = values.groupBy("id").agg(F.bool_and(F.col("read_corrupt") != "no_corrupt").alias("_bad"))
    state = F.when(F.coalesce("_bad", F.lit(False)), "corrupted").otherwise("no_corrupt")
    unmatched = unmatched.join(corrupt, "id", "left").select("id", "unmatched_binary", state.alias("read_corrupt"))
    kind = (
        F.when(F.col("geom_kind") == "point", "Point")
        .when(F.col("geom_kind") == "line", "LineString")
        .otherwise("Polygon")
    )
    kinds = values.where("read_corrupt = 'no_corrupt'").select("id", "shp_file", kind.alias("geom_type")).distinct()
    crude, rest = labels.crude_matches(unmatched, kinds, ontology)
    clean = features.where("read_corrupt = 'no_corrupt'").drop("shp_file", "field_pos", "read_corrupt")
    truth, counts = prepare.truth_features(clean, matches)
    truth = materialize(truth, "truth")
    return {
        "matches": matches,
        "success": labels.success_rates(raster_labels, matches),
        "crude": crude,
        "unmatched": rest,
        "truth": truth,
        "cover": cover.compact_cover(truth, cell),
        "labels": counts,
    }


def convert_performers(
    records: DataFrame,
    systems: DataFrame,
    maps: DataFrame,
    manifest: DataFrame,
    matches: DataFrame,
    crude: DataFrame,
    legend: DataFrame,
    *,
    legend_cell: float,
    threshold: float = 0.9,
) -> dict[str, DataFrame]:
    """Landed records to labelled features, their synopsis and a status per file.

    ``records``: record, feature_type; ``maps``: id, cog_id, transform, crs,
    crs_valid; ``legend``: cog_id, item, px_bbox, abbreviation, label.
    Polygons take their label from the legend box, points and lines from the
    abbreviation.
    """
    kept = records.select("*", "record.system", "record.system_version")
    kept = N.match_systems(kept, systems).select("record", "feature_type")
    features = prepare.performer_features(kept, maps)
    features = features.join(maps.select("id", "cog_id", "crs_valid"), "cog_id").where("crs_valid").drop("crs_valid")

    boxes = legend.join(maps.select("cog_id", "transform"), "cog_id").withColumn(
        "bbox", G.pixel_box_to_coord(F.col("transform"), F.col("px_bbox"))
    )
    polygons = features.where("feature_type = 'polygon'").withColumnsRenamed(
        {"bbox": "feature_box", "legend_box": "bbox"}
    )
    polygons = labels.assign_by_legend(polygons, boxes, legend_cell).withColumn(
        "matched_ratio", F.lit(None).cast("double")
    )
    polygons = polygons.withColumnsRenamed({"bbox": "legend_box", "feature_box": "bbox"})
    others = labels.assign_by_abbreviation(
        features.where("feature_type <> 'polygon'"), matches, crude, threshold
    ).withColumn("legend_iou", F.lit(None).cast("double"))
    labelled = materialize(polygons.unionByName(others), "performer-features")
    status = prepare.performer_schema(
        manifest, N.with_data(N.projected_features(kept)).join(maps.select("id", "cog_id"), "cog_id"),
        maps.select("cog_id", "crs", "crs_valid"),
    )
    return {"features": labelled, "synopsis": prepare.synopsis(labelled), "schema": status}


def evaluate_features(
    features: DataFrame,
    truth: DataFrame,
    schema: DataFrame,
    truth_labels: DataFrame,
    synopsis: DataFrame,
    rasters: DataFrame,
    scales: DataFrame,
    *,
    cell: float,
    dynamic_buffer: float = 0.05,
    crude_kinds: tuple[str, ...] = ("point", "line"),
) -> dict[str, DataFrame]:
    """Match metrics of all feature kinds and routes in one pass.

    Files routed ``direct`` are matched per label, their unlabelled features
    against every label of the map; files routed ``crude`` against truth of the
    same kind, for the kinds listed. Truth therefore takes part under its own
    label and under ``ANY_LABEL``; only the latter meets features without one.

    Where both sides have ``epsg``, features are moved into the system of their
    map's truth and the system is part of the match; the table ``crs_mismatches``
    names the maps where that was not possible.
    """
    systems = {}
    if "epsg" in features.columns and "epsg" in truth.columns:
        features = materialize(prepare.into_systems(features, truth.select("id", "epsg")), "moved-features")
        systems = {"crs_mismatches": evaluate.crs_mismatches(features, truth)}
    files = orchestrate.file_orchestration(schema, truth_labels, synopsis)
    routed = features.join(files.select(*prepare.FILE_KEYS, "route"), prepare.FILE_KEYS)
    direct = F.col("route") == "direct"
    crude = (F.col("route") == "crude") & F.col("feature_type").isin(*crude_kinds)
    named = direct & (F.col("geo_value") != USE_SPATIAL_INDEX)
    perf = routed.where(direct | crude).withColumn(
        "match_label", F.when(named, F.col("geo_value")).otherwise(ANY_LABEL)
    )
    truth = truth.withColumnRenamed("geom_type", "feature_type")
    under = truth.withColumn("match_label", F.explode(F.array("geo_value", F.lit(ANY_LABEL))))
    metrics = evaluate.evaluate_geometries(
        perf, under, rasters, cell, scales=scales, dynamic_buffer=dynamic_buffer,
        match=("id", "feature_type", "match_label", *(["epsg"] if systems else [])),
    )
    route = files.select("id", "feature_type", *evaluate.SYSTEM, "route")
    any_label = F.col("match_label") == ANY_LABEL
    metrics = metrics.join(route, ["id", "feature_type", *evaluate.SYSTEM]).withColumns(
        {
            "match_type": F.when(~any_label, "matched")
            .when(F.col("route") == "crude", "crude")
            .otherwise("unlabelled"),
            "geo_value": F.when(~any_label, F.col("match_label")),
            "geo_value_query": ~any_label,
        }
    )
    metrics = materialize(metrics.drop("match_label", "route"), "match-metrics")
    return {
        "orchestration": files,
        "label_work": orchestrate.label_orchestration(schema, truth_labels, synopsis),
        "metrics": metrics,
        "unmatched_features": evaluate.unmatched_features(routed, metrics),
        **systems,
    }


def evaluate_maps(
    rasters: DataFrame,
    gcps: DataFrame,
    systems: DataFrame,
    eval_set: DataFrame,
    *,
    samples_per_map: int = 10,
    seed: int = 42,
    method: str = "geodesic",
) -> dict[str, DataFrame]:
    """Sampled points and georeferencing error, with the report rows.

    ``rasters``: id, cog_id, width, height, transform, crs.
    """
    points = georef.sampled_points(rasters, samples_per_map, seed)
    metrics = georef.evaluate_georeferencing(points, gcps, systems, method)
    return {
        "samples": points,
        "metrics": metrics,
        "report": georef.georeferencing_report(metrics, eval_set),
    }


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Store each table below ``folder`` under its name."""
    for name, table in tables.items():
        writers.write_table(table, f"{folder}/{name}")
