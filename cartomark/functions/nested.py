"""Nested JSON records to feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from cartomark import schemas
from cartomark.functions.text import abbreviation_or_id
from cartomark.session import materialize

_PAIRS = "array<array<double>>"


def match_systems(records: DataFrame, systems: DataFrame) -> DataFrame:
    """Records of the configured (system, version) pairs, none repeated.

    The pairs are written, so that their size is known: a few of them go to the
    records, which would otherwise all meet at the tasks of a few systems.
    """
    wanted = materialize(systems.select("system", "system_version").distinct(), "wanted-systems")
    return records.join(wanted, ["system", "system_version"], "left_semi")


def geojson_rings(geojson: Column, feature_type: Column) -> Column:
    """Rings of a point, line or polygon as arrays of coordinate arrays."""
    coords = geojson["coordinates"]
    return (
        F.when(coords.isNull(), F.lit(None))
        .when(
            feature_type == "point",
            F.array(F.array(F.from_json(coords, "array<double>"))),
        )
        .when(feature_type == "line", F.array(F.from_json(coords, _PAIRS)))
        .otherwise(F.from_json(coords, f"array<{_PAIRS}>"))
    )


def multi_parts(geojson: Column) -> Column:
    """Parts of a geometry as single geometries; simple ones give one part."""
    kind = F.regexp_replace(geojson["type"], "^Multi", "")
    coords = geojson["coordinates"]
    parts = F.when(
        geojson["type"].startswith("Multi"), F.from_json(coords, "array<string>")
    ).otherwise(F.array(coords))
    return F.transform(parts, lambda c: F.struct(kind.alias("type"), c.alias("coordinates")))


def drop_z(rings: Column) -> Column:
    """First two ordinates of every vertex."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.slice(p, 1, 2)))


def _feature_rows(df: DataFrame, geojson: str, explode_rings: bool, keep: Sequence[str]) -> DataFrame:
    """Unfold one geometry per row into ring rows with their vertex numbers."""
    kind = F.col("feature_type")
    rings = geojson_rings(F.col(geojson), kind)
    df = df.withColumn("_rings", rings)
    if explode_rings:
        as_rows = F.when(kind == "polygon", F.transform("_rings", lambda r: F.array(r))).otherwise(
            F.array("_rings")
        )
        df = df.select("*", F.posexplode_outer(as_rows).alias("ring_index", "rings"))
    else:
        df = df.withColumn("ring_index", F.lit(0)).withColumn("rings", F.col("_rings"))
    first = F.try_element_at("rings", F.lit(1))
    count = (
        F.when(F.col("rings").isNull(), F.lit(0))
        .when(kind == "point", F.lit(1))
        .when(kind == "line", F.size(F.try_element_at(first, F.lit(1))))
        .otherwise(F.size(first))
    )
    # Features without geometry carry the wanted kind as their type.
    return df.select(
        *keep,
        "feature_index",
        F.col("ring_index").cast("int").alias("ring_index"),
        F.coalesce(F.col(f"{geojson}.type"), kind).alias("type"),
        count.cast("bigint").alias("p_num_geom"),
        "rings",
    )


def projected_features(records: DataFrame, explode_rings: bool = False) -> DataFrame:
    """Feature rows of georeferenced records.

    ``records`` has ``record`` and ``feature_type``. Points and lines give one
    row each; polygons one row, or one per ring. A record without features
    keeps one row with null rings and a count of 0.
    """
    r = F.col("record")
    abbreviation = abbreviation_or_id(
        r["legend_item"]["abbreviation"], r["legend_id"], r["cog_id"], r["system"], r["system_version"]
    )
    keep = ["system", "system_version", "cog_id", "feature_type", "abbreviation", "color", "pattern", "px_bbox"]
    rows = records.select(
        r["system"].alias("system"),
        r["system_version"].alias("system_version"),
        r["cog_id"].alias("cog_id"),
        "feature_type",
        abbreviation.alias("abbreviation"),
        r["legend_item"]["color"].alias("color"),
        r["legend_item"]["pattern"].alias("pattern"),
        r["legend_item"]["px_bbox"].alias("px_bbox"),
        F.posexplode_outer(r["projected_feature"]).alias("feature_index", "_feature"),
    ).withColumn("_geojson", F.col("_feature.projected_geojson"))
    return _feature_rows(rows, "_geojson", explode_rings, keep)


def pixel_features(records: DataFrame, explode_rings: bool = False) -> DataFrame:
    """Feature rows of records in pixel space; points take the record's own box."""
    r = F.col("record")
    is_point = F.col("feature_type") == "point"
    item = r["legend_item"]
    keep = ["system", "system_version", "cog_id", "feature_type", "abbreviation", "color", "pattern", "px_bbox"]
    rows = records.select(
        r["system"].alias("system"),
        r["system_version"].alias("system_version"),
        r["cog_id"].alias("cog_id"),
        "feature_type",
        F.when(~is_point, item["abbreviation"]).alias("abbreviation"),
        F.when(~is_point, item["color"]).alias("color"),
        F.when(~is_point, item["pattern"]).alias("pattern"),
        F.when(is_point, r["px_bbox"]).otherwise(item["px_bbox"]).alias("px_bbox"),
        F.lit(0).alias("feature_index"),
        r["px_geojson"].alias("_geojson"),
    )
    return _feature_rows(rows, "_geojson", explode_rings, keep)


def with_data(features: DataFrame) -> DataFrame:
    """Rows that carry a geometry."""
    return features.where(F.col("rings").isNotNull() & (F.col("p_num_geom") > 0))


def flatten_struct(schema: StructType, prefix: str, path: str) -> list[Column]:
    """Leaf columns of a struct, named by their path joined with ``_``."""
    out: list[Column] = []
    for field in schema.fields:
        at = f"{path}.`{field.name}`"
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, StructType):
            out += flatten_struct(field.dataType, f"{name}_", at)
        else:
            out.append(F.col(at).alias(name))
    return out


def feature_documents(docs: DataFrame, feature_schema: StructType, text: str = "value") -> DataFrame:
    """Features of raw result documents, flattened.

    A document is a list of items, or an object whose first list-valued key
    holds them. The item key containing ``_features`` leads to ``features``, each
    unfolded to columns by ``feature_schema``; the item's other values stay in
    the map ``item``.
    """
    whole = F.col(text)
    entries = F.map_entries(F.from_json(whole, "map<string,string>"))
    first_list = F.try_element_at(
        F.filter(entries, lambda e: e["value"].startswith("[") & (e["value"] != "[]")), F.lit(1)
    )["value"]
    items = F.when(whole.rlike(r"^\s*\["), whole).otherwise(first_list)
    others = [c for c in docs.columns if c != text]
    item_rows = docs.select(
        *others,
        F.posexplode(F.from_json(items, "array<map<string,string>>")).alias("main_id", "_item"),
    )
    holder = F.try_element_at(
        F.filter(F.map_keys("_item"), lambda k: k.contains("_features")), F.lit(1)
    )
    features = F.from_json(
        F.try_element_at("_item", holder),
        StructType().add("features", ArrayType(feature_schema)),
    )["features"]
    rows = item_rows.select(
        *others,
        "main_id",
        F.map_filter("_item", lambda k, v: ~k.contains("_features")).alias("item"),
        F.posexplode(features).alias("feature_index", "_f"),
    )
    return rows.select(
        *others, "main_id", "item", "feature_index", *flatten_struct(feature_schema, "", "_f")
    )


def vertex_count(rings: Column) -> Column:
    return F.aggregate(rings, F.lit(0).cast("bigint"), lambda n, ring: n + F.size(ring))


def coordinate_size(rings: Column) -> Column:
    """Number of ordinates in all rings."""
    return F.aggregate(
        rings,
        F.lit(0).cast("bigint"),
        lambda n, ring: n + F.aggregate(ring, F.lit(0).cast("bigint"), lambda m, p: m + F.size(p)),
    )


def legend_items(text: Column) -> Column:
    """Annotated legend items of a JSON list; absent keys are null."""
    return F.from_json(text, f"array<{schemas.LEGEND_ITEM}>")


def gcps(text: Column) -> Column:
    """Ground control points of a JSON list."""
    return F.from_json(text, f"array<{schemas.GCP}>")


def stack_columns(df: DataFrame, index: Sequence[str], key: str, value: str, keys: Sequence[str]) -> DataFrame:
    """Key-value rows to one wide row per index; keys never seen become null."""
    return df.groupBy(*index).pivot(key, list(keys)).agg(F.first(value, ignorenulls=True))
