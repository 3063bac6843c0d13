"""Check queries for whole jobs and the arrival stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.operators import cover
from cartomark.plans import evaluate, georef, inventory, labels, prepare
from cartomark.session import materialize
from cartomark.sources import writers
from cartomark.streaming import arrivals
from cartomark.workload import logical as L
from cartomark.workload.geo_queries import sample_rasters
from cartomark.workload.aggregate_queries import labelled
from cartomark.workload.join_queries import CRUDE_SQL, DIRS_SQL, crude_tables, map_files
from cartomark.workload.registry import query
from cartomark.workload.scan_queries import scratch

BOXES = L.with_sql(L.BOXES_SQL)

FOUND_SQL = DIRS_SQL + """, hits AS (SELECT id, directory FROM tok JOIN ids USING (id) WHERE length(id) = n),
files AS (SELECT '/data/m' || o_orderpriority[1] || '/' || o_custkey || '/' AS directory, 'f_' || o_orderkey AS stem,
  CASE o_orderstatus WHEN 'F' THEN '.tif' WHEN 'O' THEN '.shp' ELSE '.feather' END AS file_ext FROM orders),
found AS (SELECT id, file_ext, stem FROM hits JOIN files USING (directory)),
seen AS (SELECT id, bool_or(file_ext = '.tif') AS tif, bool_or(file_ext = '.shp') AS shp, bool_or(file_ext = '.feather') AS fea FROM found GROUP BY id)
"""


def expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, "Map").otherwise("Topo").alias("source"),
    )


def found_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.files_of_ids(expected(spark, sf_dir), map_files(spark, sf_dir))


@query(
    "c01_inventory",
    FOUND_SQL + """SELECT ids.id, tif IS NOT NULL AS in_dir_t, shp IS NOT NULL AS in_dir_s, coalesce(tif, false) AS has_tif, coalesce(shp, false) AS has_shp,
      coalesce(fea, false) AS value_match, 'Feature Extraction' AS process_type, CASE WHEN ids.id::BIGINT % 2 = 0 THEN 'Map' ELSE 'Topo' END AS source
      FROM ids LEFT JOIN seen USING (id)""",
)
def c01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_features(expected(spark, sf_dir), found_files(spark, sf_dir))


@query(
    "c01_inventory_states",
    FOUND_SQL + """SELECT ids.id, CASE WHEN tif IS NULL THEN 'different' WHEN NOT tif THEN 'missing' ELSE 'present' END AS state, tif IS NOT NULL AS in_dir,
      coalesce(tif, false) AS has_file FROM ids LEFT JOIN seen USING (id)""",
)
def c01_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_files(spark, sf_dir).withColumn("has_file", F.col("file_ext") == ".tif")
    return inventory.inventory_ids(expected(spark, sf_dir).select("id"), found)


@query(
    "c02_map_inspection",
    "SELECT o_custkey::VARCHAR AS id, count(*) AS n_files FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
)
def c02(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = map_files(spark, sf_dir).withColumnRenamed("owner", "id")
    return inventory.inspect_maps(files)


@query(
    "c02_missing_maps",
    "SELECT count(DISTINCT o_custkey) AS found, (SELECT count(*) FROM customer) - count(DISTINCT o_custkey) AS total_missing FROM orders WHERE o_orderstatus = 'F'",
)
def c02_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = map_files(spark, sf_dir).withColumnRenamed("owner", "id")
    return inventory.missing_maps(inventory.inspect_maps(files), L.table(spark, sf_dir, "customer").count())


UPDATE_SQL = """WITH inv AS (SELECT c_custkey::VARCHAR AS id, bool_or(o_orderkey IS NOT NULL) AS in_dir, coalesce(bool_or(o_orderstatus = 'F'), false) AS has_tif
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY ALL),
arrived AS (SELECT DISTINCT o_custkey::VARCHAR AS id FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')
SELECT inv.id, in_dir OR a.id IS NOT NULL AS in_dir, has_tif OR a.id IS NOT NULL AS has_tif FROM inv LEFT JOIN arrived a ON a.id = inv.id"""

ARRIVAL_SCHEMA = "id string, path string, file_ext string"


def base_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = L.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "F", ".tif").otherwise(".shp").alias("file_ext"),
    )
    wanted = expected(spark, sf_dir)
    return inventory.inventory_georeferencing(wanted, urgent).select("id", "in_dir", "has_tif")


def arrived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "orders").where("o_orderpriority = '2-HIGH'").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.concat(F.lit("/new/"), F.col("o_orderkey").cast("string")).alias("path"),
        F.when(F.col("o_orderstatus") == "F", ".tif").otherwise(".shp").alias("file_ext"),
    )


@query("c03_inventory_update", UPDATE_SQL)
def c03(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = arrived_files(spark, sf_dir).where("file_ext = '.tif'")
    return inventory.update_inventory(base_inventory(spark, sf_dir), new, ["in_dir", "has_tif"])


@query("st1_arrival_stream", UPDATE_SQL)
def st1(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "arrivals")
    rows = arrived_files(spark, sf_dir)
    # Two landings; the second repeats every path of the first.
    writers.write_table(rows.where("file_ext = '.tif'"), f"{base}/in", mode="append")
    writers.write_table(rows, f"{base}/in", mode="append")
    stream = arrivals.arrival_stream(spark, f"{base}/in", ARRIVAL_SCHEMA)
    arrivals.track_arrivals(stream, f"{base}/table", f"{base}/state", ".tif").awaitTermination()
    return arrivals.current_inventory(
        spark, base_inventory(spark, sf_dir), f"{base}/table", ARRIVAL_SCHEMA, ["in_dir", "has_tif"]
    )


@query(
    "c04_label_field_matching",
    """WITH l AS (SELECT DISTINCT p_brand AS id, p_name AS v FROM part WHERE p_partkey % 2 = 0),
    f AS (SELECT DISTINCT p_brand AS id, p_name AS v, CASE WHEN p_size > 25 THEN 'point' ELSE 'polygon' END AS kind FROM part WHERE p_partkey % 2 = 1),
    onto AS (SELECT DISTINCT p_name AS v FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt')
    SELECT l.id, l.v AS binary_value, 'name' AS field_name, CASE WHEN o.v IS NULL THEN upper(l.v) ELSE l.v END AS geo_value_vector, kind || '.shp' AS shp_file,
      CASE WHEN o.v IS NULL THEN 'sequence' ELSE 'naive-regex-ontology' END AS match_method, CASE WHEN o.v IS NULL THEN 'Polygon' ELSE 'Point' END AS geom_type, 1.0::DOUBLE AS matched_ratio
    FROM l JOIN f ON f.id = l.id AND f.v = l.v LEFT JOIN onto o ON o.v = l.v WHERE (o.v IS NULL) = (kind = 'polygon')""",
)
def c04(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part")
    brand = F.col("p_brand").alias("id")
    wanted = part.where("p_partkey % 2 = 0").select(brand, F.col("p_name").alias("binary_value"))
    onto = part.where("p_name like 'red%' or p_name like '%bolt'").select(
        F.col("p_name").alias("label"), F.lit("Point").alias("feature_type"),
        F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("alias"),
    ).distinct()
    kind = F.when(F.col("p_size") > 25, "point").otherwise("polygon")
    field = F.inline(
        F.array(
            F.struct(F.lit("type").alias("field_name"), F.lit(0).alias("field_pos"), F.col("p_type").alias("value")),
            F.struct(
                F.lit("name").alias("field_name"), F.lit(1).alias("field_pos"),
                F.when(kind == "point", F.col("p_name")).otherwise(F.upper("p_name")).alias("value"),
            ),
        )
    )
    values = part.where("p_partkey % 2 = 1").select(
        brand, F.concat(kind, F.lit(".shp")).alias("shp_file"), kind.alias("geom_kind"),
        F.lit("no_corrupt").alias("read_corrupt"), field,
    )
    return labels.match_field_values(wanted, values, onto, 0.999).drop("read_corrupt")


@query("c04_similar_field_matching")
def c04_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part")
    wanted = part.where("p_partkey % 2 = 0").select(
        F.col("p_brand").alias("id"), F.concat_ws(" ", "p_name", F.lower("p_type")).alias("binary_value")
    )
    onto = labels.ontology_table(spark)
    values = part.where("p_partkey % 2 = 1").select(
        F.col("p_brand").alias("id"), F.lit("f.shp").alias("shp_file"), F.lit("polygon").alias("geom_kind"),
        F.lit("no_corrupt").alias("read_corrupt"), F.lit("name").alias("field_name"), F.lit(0).alias("field_pos"),
        F.concat_ws(" ", "p_name", "p_type").alias("value"),
    )
    return labels.match_field_values(wanted, values, onto, 0.8)


@query("c05_ontology_report")
def c05(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part")
    onto = labels.ontology_from_csv(
        part.where("p_partkey % 2 = 0").select(
            F.col("p_name").alias("label"), F.lower("p_type").alias("ftr_type"),
            F.when(F.col("p_size") % 2 == 0, "point").otherwise("line").alias("geometry_type"),
            F.concat_ws(", ", "p_name", "p_type").alias("alternate_example"),
        ).distinct()
    )
    values = part.where("p_partkey % 2 = 1").select(F.concat_ws("s ", "p_name").alias("geo_value"))
    return labels.ontology_report(values, onto)


@query("c06_crude_fallback", CRUDE_SQL + """SELECT DISTINCT id, unmatched_binary, CASE WHEN reason = 'Does Not Exist In Ground-Truth' THEN geom_type ELSE 'Unknown' END AS geom_type, reason FROM t WHERE reason IS NOT NULL""")
def c06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crude_tables(spark, sf_dir)[1]


@query(
    "c07_truth_partitions",
    BOXES + f""", parts AS (SELECT *, unnest(range(0, CASE WHEN x1 - x0 > 180 THEN 2 ELSE 1 END)) AS part FROM truth WHERE geo_value <> 'N')
    SELECT id, geo_value, count(*) AS "count", sum((x1 // {L.CELL} - x0 // {L.CELL} + 1) * (y1 // {L.CELL} - y0 // {L.CELL} + 1))::BIGINT AS n_cells FROM parts GROUP BY ALL""",
)
def c07(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = "[[%1$d,%2$d],[%3$d,%2$d],[%3$d,%4$d],[%1$d,%4$d],[%1$d,%2$d]]"
    wide = F.expr("x1 - x0 > 180")
    single = F.format_string(f"[{ring}]", "x0", "y0", "x1", "y1")
    double = F.format_string(f"[[{ring}],[{ring}]]", "x0", "y0", "x1", "y1")
    features = L.truths(spark, sf_dir).select(
        "fid", "id", F.lit("label").alias("field_name"), F.concat("geo_value", F.lit("-")).alias("value"),
        F.lit("polygon").alias("geom_kind"),
        F.struct(
            F.when(wide, "MultiPolygon").otherwise("Polygon").alias("type"),
            F.when(wide, double).otherwise(single).alias("coordinates"),
        ).alias("geojson"),
    )
    found = L.truths(spark, sf_dir).where("geo_value <> 'N'").select(
        "id", F.lit("label").alias("field_name"), F.concat("geo_value", F.lit("-")).alias("geo_value_vector"),
        F.col("geo_value").alias("binary_value"), F.lit(1.0).alias("matched_ratio"),
    ).distinct()
    rows, counts = prepare.truth_features(features, found)
    held = cover.compact_cover(rows, L.CELL).groupBy("fid").agg(F.sum(F.pow(F.lit(4), F.col("level"))).cast("bigint").alias("n"))
    cells = rows.select("id", "geo_value", "fid").join(held, "fid").groupBy("id", "geo_value").agg(F.sum("n").alias("n_cells"))
    return counts.select("id", "geo_value", "count").join(cells, ["id", "geo_value"])


@query(
    "c08_performer_conversion",
    BOXES + """, f AS (SELECT *, CASE WHEN geo_value = 'A' THEN 'A' WHEN geo_value = 'N' THEN 'N' ELSE 'Use Spatial Index' END AS v, geo_value = 'A' AS direct FROM perf WHERE id % 10 <> 3)
    SELECT id, system, v AS geo_value, direct AS match_binary, n AS "count", n / sum(n) OVER (PARTITION BY id, system)::DOUBLE AS perc
    FROM (SELECT id, system, v, direct, count(*) AS n FROM f GROUP BY ALL)""",
)
def c08(spark: SparkSession, sf_dir: str) -> DataFrame:
    perf = labelled(spark, sf_dir).where("id % 10 <> 3").drop("geo_value", "matched_ratio", "match_binary")
    tables = {}
    for name, label in (("geo_value_vector", "A"), ("unmatched_binary", "N")):
        tables[name] = L.truths(spark, sf_dir).where(F.col("geo_value") == label).select(
            "id", F.col("geo_value").alias(name)
        ).distinct()
    assigned = labels.assign_by_abbreviation(perf, tables["geo_value_vector"], tables["unmatched_binary"])
    per_value = prepare.synopsis(assigned).groupBy("id", "system", "geo_value", "match_binary")
    return per_value.agg(F.sum("count").alias("count"), F.sum("perc").alias("perc"))


@query(
    "c08_performer_status",
    BOXES + """, n AS (SELECT id, system, count(*) AS n FROM perf WHERE id % 10 <> 3 GROUP BY ALL)
    SELECT f.id, f.system, CASE WHEN f.id % 10 = 4 THEN 'failed' ELSE 'success-done' END AS message, CASE WHEN f.id % 10 = 4 THEN 'no-data' WHEN n IS NULL THEN 'no-data extracted/missing features'
      WHEN f.id % 10 = 5 THEN 'CRS failure - local' ELSE 'extracted data' END AS data, coalesce(n, 0) AS n_features FROM (SELECT DISTINCT id, system FROM perf) f LEFT JOIN n USING (id, system)""",
)
def c08_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    perf = labelled(spark, sf_dir)
    files = perf.select(*prepare.FILE_KEYS).distinct()
    manifest = files.withColumn("message", F.when(F.col("id") % 10 == 4, "failed").otherwise("success-done"))
    crs = files.select("cog_id", "id").distinct().select(
        "cog_id",
        F.when(F.col("id") % 10 == 5, "local").otherwise("epsg:4326").alias("crs"),
        (F.col("id") % 10 != 5).alias("crs_valid"),
    )
    out = prepare.performer_schema(manifest, perf.where("id % 10 <> 3"), crs)
    return out.select("id", "system", "message", "data", "n_features")


@query(
    "c10_unlabelled_features",
    L.with_sql(L.BOXES_SQL.replace(
        "perf AS (SELECT *,", "perf AS (SELECT * REPLACE ('any' AS geo_value),"
    ).replace("truth AS (SELECT *", "truth AS (SELECT * REPLACE ('any' AS geo_value)"), L.PAIRS_SQL, L.METRICS_SQL)
    + "SELECT id, system, p_fid, g_fid, iou_units, num_cand_geom, f1 FROM metrics",
)
def c10_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    perf = L.performers(spark, sf_dir).withColumn("geo_value", F.lit(G.USE_SPATIAL_INDEX))
    rows = evaluate.evaluate_unlabelled(perf, L.truths(spark, sf_dir), L.CELL, L.PIXEL)
    return rows.select("id", "system", "p_fid", "g_fid", "iou_units", "num_cand_geom", "f1")


@query(
    "c10_unmatched_features",
    L.with_sql(L.BOXES_SQL, L.PAIRS_SQL, L.METRICS_SQL) + "SELECT id, fid FROM perf WHERE fid NOT IN (SELECT p_fid FROM metrics)",
)
def c10_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    perf = L.performers(spark, sf_dir)
    rows = evaluate.evaluate_boxes(perf, L.truths(spark, sf_dir), L.CELL, L.PIXEL)
    return evaluate.unmatched_features(perf.select("id", "fid"), rows)


GEOMETRY_SQL = L.with_sql(L.BOXES_SQL, L.PAIRS_SQL) + """, hits AS (SELECT *, (2 * tp * 100000 + len_pdf + len_gdf - tp) // (2 * (len_pdf + len_gdf - tp)) AS u FROM pairs WHERE tp > 0),
best AS (SELECT *, row_number() OVER (PARTITION BY p_fid ORDER BY u DESC, CAST(2 * tp AS DOUBLE) / (len_pdf + len_gdf) DESC, g_fid) AS rn FROM hits WHERE hit)
"""


@query(
    "c10_polygon_evaluation",
    GEOMETRY_SQL + "SELECT id, geo_value, system, p_fid, g_fid, u AS iou_units, tp AS true_positives, len_pdf, len_gdf FROM best WHERE rn = 1",
)
def c10_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    def shaped(side: DataFrame) -> DataFrame:
        geom = G.geometry(F.lit("polygon"), F.array(G.box_ring(F.col("bbox"))))
        return side.withColumn("geom", geom)

    pixel = float(L.PIXEL)
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (pixel, 0.0, 0.0, 0.0, pixel, 0.0))])
    rasters = L.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), t.alias("transform"), F.lit(10_000).alias("width"),
        F.lit(10_000).alias("height"), F.lit(0).cast("bigint").alias("total_pix"),
    )
    rows = evaluate.evaluate_geometries(
        shaped(L.performers(spark, sf_dir)), shaped(L.truths(spark, sf_dir)), rasters, L.CELL
    )
    return rows.select(
        "id", "geo_value", "system", "p_fid", "g_fid", "iou_units", "true_positives", "len_pdf", "len_gdf"
    )


#: Parts as boxes on 13 maps in UTM metres, no corner on the border of a 20-metre pixel or of a box of the other side; truth lies beside each.
PLOTS_SQL = f"""WITH plots AS (
  SELECT p_partkey AS fid, p_partkey % 13 AS id, p_brand AS geo_value, 400010 + 20 * (p_partkey * 7919 % 4000) AS x0, 4300010 + 20 * (p_size * 61 + p_partkey * 104729 % 700) AS y0,
    200 + 20 * (p_size % 7) AS wide, 160 + 20 * (length(p_name) % 9) AS high FROM part),
perf AS (SELECT fid, id, geo_value, 'sys_1' AS system, '1.0' AS system_version, x0, y0, x0 + wide AS x1, y0 + high AS y1 FROM plots WHERE id % 4 <> 3),
truth AS (SELECT fid, id, geo_value, x0 + 45 AS x0, y0 + 65 AS y0, x0 + 45 + wide AS x1, y0 + 65 + high AS y1 FROM plots)
"""


def plots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Predictions, by map in UTM, in WGS-84 or in a system that cannot be moved, and truth in UTM."""
    key, size = F.col("p_partkey"), F.col("p_size")
    rows = L.table(spark, sf_dir, "part").select(
        key.alias("fid"), (key % 13).alias("id"), F.col("p_brand").alias("geo_value"),
        (key * 7919 % 4000 * 20 + 400_010).alias("x0"), ((size * 61 + key * 104_729 % 700) * 20 + 4_300_010).alias("y0"),
        (size % 7 * 20 + 200).alias("wide"), (F.length("p_name") % 9 * 20 + 160).alias("high"),
    )

    def shaped(side: DataFrame) -> DataFrame:
        b = G.box(F.col("x0"), F.col("y0"), F.col("x0") + F.col("wide"), F.col("y0") + F.col("high"))
        return side.withColumn("bbox", b).withColumn("geom", G.geometry(F.lit("polygon"), F.array(G.box_ring(F.col("bbox")))))

    kind = F.col("id") % 4
    there = prepare.reproject_edges(F.col("geom"), F.lit(32612), F.lit(4326), prepare.DEGREES)
    perf = shaped(rows).withColumns({"system": F.lit("sys_1"), "system_version": F.lit("1.0")})
    perf = perf.withColumn("epsg", F.when(kind == 1, "epsg:4326").when(kind == 3, "epsg:3857").otherwise("epsg:32612"))
    perf = perf.withColumn("geom", F.when(kind == 1, there).otherwise(F.col("geom"))).withColumn("bbox", G.geometry_box(F.col("geom")))
    truth = shaped(rows.withColumns({"x0": F.col("x0") + 45, "y0": F.col("y0") + 65})).withColumn("epsg", F.lit("epsg:32612"))
    return perf.drop("x0", "y0", "wide", "high"), truth.drop("x0", "y0", "wide", "high")


@query(
    "c10_mixed_systems",
    PLOTS_SQL + "," + L.PAIRS_SQL + """, hits AS (SELECT *, (2 * tp * 100000 + len_pdf + len_gdf - tp) // (2 * (len_pdf + len_gdf - tp)) AS u FROM pairs WHERE tp > 0),
best AS (SELECT *, row_number() OVER (PARTITION BY p_fid ORDER BY u DESC, CAST(2 * tp AS DOUBLE) / (len_pdf + len_gdf) DESC, g_fid) AS rn FROM hits WHERE hit)
SELECT id, geo_value, p_fid, g_fid, u AS iou_units, tp AS true_positives, len_pdf, len_gdf FROM best WHERE rn = 1""",
)
def c10_mixed_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions in three systems against truth in one: those in WGS-84 must match as if they had never left UTM."""
    perf, truth = plots(spark, sf_dir)
    perf = materialize(prepare.into_systems(perf, truth), "moved-plots")
    pixel = float(L.PIXEL)
    # The image begins at 400,000 E, 4,300,000 N, row 0 in the south.
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (pixel, 0.0, 400_000.0, 0.0, pixel, 4_300_000.0), strict=True)])
    rasters = truth.select("id").distinct().select(
        "id", t.alias("transform"), F.lit(10_000).alias("width"), F.lit(10_000).alias("height"), F.lit(0).cast("bigint").alias("total_pix")
    )
    rows = evaluate.evaluate_geometries(perf, truth, rasters, L.CELL, match=("id", "geo_value", "epsg"))
    return rows.select("id", "geo_value", "p_fid", "g_fid", "iou_units", "true_positives", "len_pdf", "len_gdf")


@query(
    "c10_system_mismatches",
    "SELECT p_partkey % 13 AS id, 'epsg:3857' AS perf_epsg, 'epsg:32612' AS grnd_epsg FROM part WHERE p_partkey % 13 % 4 = 3 GROUP BY ALL",
)
def c10_system_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps whose predictions stay in a system other than the truth's."""
    perf, truth = plots(spark, sf_dir)
    return evaluate.crs_mismatches(prepare.into_systems(perf, truth), truth)


@query("c10_point_evaluation")
def c10_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as buffered points on one map, in 0.1-unit pixels."""
    pts = L.points(spark, sf_dir)
    vertex = F.struct("x", "y")
    geom = G.geometry(F.lit("point"), F.array(F.array(vertex)))
    pts = pts.select("fid", F.lit(1).alias("id"), "geo_value", "is_truth", geom.alias("geom"))
    perf = pts.where("not is_truth").drop("is_truth").withColumn("system", F.lit("sys_1"))
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.1, 0.0, 0.0, 0.0, 0.1, 0.0))])
    maps = pts.select("id").distinct()
    rasters = maps.select(
        "id", t.alias("transform"), F.lit(100_000).alias("width"), F.lit(100_000).alias("height"),
        F.lit(0).cast("bigint").alias("total_pix"),
    )
    rows = evaluate.evaluate_geometries(
        perf, pts.where("is_truth").drop("is_truth"), rasters, 4.0,
        scales=maps.select("id", F.lit(24000).alias("scale")), dynamic_buffer=0.001,
    )
    return rows.select("geo_value", "p_fid", "g_fid", "iou_units", "true_positives", "len_pdf", "len_gdf")


GEOREF_SQL = L.with_sql(L.GCPS_SQL.replace("% 3 + 1", "% 4 + 1").replace("WHERE true", """WHERE NOT (l_linenumber = 2 AND l_suppkey % 3 = 0)
  AND NOT (l_linenumber IN (2, 4) AND l_suppkey % 7 = 0) AND NOT (l_linenumber IN (1, 3) AND l_suppkey % 11 = 0) AND NOT (l_linenumber = 1 AND l_suppkey % 13 = 0)""")) + """, m AS (
  SELECT cog_id, system, count(*) AS n, avg(col) AS mc, avg("row") AS mr, avg(lon) AS mx, avg(lat) AS my,
    var_pop(col) AS vcc, var_pop("row") AS vrr, covar_pop(col, "row") AS vcr, covar_pop(col, lon) AS vcx, covar_pop("row", lon) AS vrx,
    covar_pop(col, lat) AS vcy, covar_pop("row", lat) AS vry FROM gcps GROUP BY ALL),
fit AS (SELECT cog_id, system, mc, mr, mx, my, (vcx * vrr - vrx * vcr) / det AS a, (vrx * vcc - vcx * vcr) / det AS b,
    (vcy * vrr - vry * vcr) / det AS d, (vry * vcc - vcy * vcr) / det AS e
    FROM (SELECT *, vcc * vrr - vcr * vcr AS det FROM m) WHERE n >= 3 AND det > vcc * vrr * 1e-9),
fits AS (SELECT m.cog_id, m.system, f.a, f.b, f.d, f.e, f.mx - f.a * f.mc - f.b * f.mr AS c, f.my - f.d * f.mc - f.e * f.mr AS f
    FROM m LEFT JOIN fit f ON f.cog_id = m.cog_id AND f.system = m.system),
maps AS (SELECT s_suppkey AS cog_id FROM supplier),
ann AS (SELECT cog_id, min(system) AS system FROM fits WHERE system IN ('sys_2', 'sys_4') GROUP BY 1),
prf AS (SELECT DISTINCT cog_id FROM fits WHERE system IN ('sys_1', 'sys_3')),
state AS (SELECT cog_id, ann.system AS ann, prf.cog_id IS NOT NULL AS has_perf, fa.a AS aa, fa.b AS ab, fa.c AS ac, fa.d AS ad, fa.e AS ae, fa.f AS af
  FROM maps LEFT JOIN ann USING (cog_id) LEFT JOIN prf USING (cog_id) LEFT JOIN fits fa ON fa.cog_id = maps.cog_id AND fa.system = ann.system),
whole AS (SELECT *, CASE WHEN ann IS NULL AND NOT has_perf THEN 'annotated-performer-missing' WHEN ann IS NULL THEN 'annotated-missing'
  WHEN NOT has_perf THEN 'performer-missing' WHEN aa IS NULL THEN 'annotated-Bad Transformer / Incompatible GCP format' END AS log FROM state),
each AS (SELECT w.*, p.system AS performer, fp.cog_id AS fit_id, fp.a AS pa, fp.b AS pb, fp.c AS pc, fp.d AS pd, fp.e AS pe, fp.f AS pf
  FROM whole w CROSS JOIN (VALUES ('sys_1'), ('sys_3')) p(system) LEFT JOIN fits fp ON fp.cog_id = w.cog_id AND fp.system = p.system WHERE log IS NULL),
outcome AS (SELECT cog_id, ann, performer, CASE WHEN fit_id IS NULL THEN 'performer-missing' WHEN pa IS NULL THEN 'performer-Bad Transformer / Incompatible GCP format' ELSE 'success' END AS log,
  aa, ab, ac, ad, ae, af, pa, pb, pc, pd, pe, pf FROM each
  UNION ALL SELECT cog_id, ann, NULL, log, aa, ab, ac, ad, ae, af, NULL, NULL, NULL, NULL, NULL, NULL FROM whole WHERE log IS NOT NULL),
r AS (SELECT s_suppkey AS id, unnest(range(1, 61 + s_suppkey % 9)) AS v FROM supplier),
cl AS (SELECT s_suppkey AS id, unnest(range(1, 91 + s_suppkey % 5)) AS v FROM supplier),
rr AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY md5('42|' || id || '|row|' || v)) AS k FROM r),
cc AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY md5('42|' || id || '|col|' || v)) AS k FROM cl),
px AS (SELECT rr.id, k, rr.v + 0.5::DOUBLE AS y, cc.v + 0.5::DOUBLE AS x FROM rr JOIN cc USING (id, k) WHERE k <= 10),
pts AS (SELECT cog_id, performer, radians(ad * x + ae * y + af) AS p1, radians(aa * x + ab * y + ac) AS l1, radians(pd * x + pe * y + pf) AS p2, radians(pa * x + pb * y + pc) AS l2
  FROM outcome JOIN px ON px.id = cog_id WHERE log = 'success'),
err AS (SELECT cog_id, performer, sqrt(avg(km * km)) AS rmse, count(*) AS n FROM (SELECT cog_id, performer,
  2 * 6371.0088::DOUBLE * asin(sqrt(least(sin((p2 - p1) / 2) ** 2 + cos(p1) * cos(p2) * sin((l2 - l1) / 2) ** 2, 1.0))) AS km FROM pts) GROUP BY ALL)
"""


def georef_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control points of four systems, with gaps so that outcomes differ by map."""
    col, row = F.col("l_quantity"), F.col("l_discount") * 100
    kept = (
        "not (l_linenumber = 2 and l_suppkey % 3 = 0)"
        " and not (l_linenumber in (2, 4) and l_suppkey % 7 = 0)"
        " and not (l_linenumber in (1, 3) and l_suppkey % 11 = 0)"
        " and not (l_linenumber = 1 and l_suppkey % 13 = 0)"
    )
    return L.by_role(L.table(spark, sf_dir, "lineitem"), 4).where(kept).select(
        F.col("l_suppkey").alias("cog_id"),
        F.concat(F.lit("sys_"), F.col("l_linenumber").cast("string")).alias("system"),
        F.lit("1.0").alias("system_version"),
        row.alias("row"),
        col.alias("col"),
        (F.lit(-110.0) + col * 0.01 + row * 0.002 + F.col("l_tax") * 0.01).alias("lon"),
        (F.lit(35.0) - row * 0.01 + col * 0.001 + F.col("l_tax") * 0.02).alias("lat"),
    )


def georef_metrics(spark: SparkSession, sf_dir: str, method: str = "haversine") -> DataFrame:
    from cartomark.workload.join_queries import systems

    samples = georef.sample_pixels(sample_rasters(spark, sf_dir)).withColumnRenamed("id", "cog_id")
    return georef.evaluate_georeferencing(
        samples, georef_points(spark, sf_dir), systems(spark, sf_dir), method
    )


@query(
    "c12_georeferencing_evaluation",
    GEOREF_SQL + """SELECT cog_id, ann AS annotated_system, performer, log, round(rmse, 8) AS rmse, n AS sample_pnts
      FROM outcome o LEFT JOIN err USING (cog_id, performer)""",
)
def c12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return georef_metrics(spark, sf_dir).select(
        "cog_id", "annotated_system", "performer", "log", F.round("rmse", 8).alias("rmse"), "sample_pnts"
    )


@query("c12_georeferencing_geodesic")
def c12_geodesic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return georef_metrics(spark, sf_dir, "geodesic").select("cog_id", "performer", "log", F.round("rmse", 8).alias("rmse"))


@query(
    "c13_georeferencing_report",
    GEOREF_SQL.replace("WITH ", "WITH " + L.EVAL_SET_SQL.strip() + ",", 1) + """SELECT state, log, count(*) AS n, round(avg(rmse), 7) AS rmse_mean
      FROM outcome o LEFT JOIN err USING (cog_id, performer) JOIN eval_set ON id = cog_id GROUP BY ALL""",
)
def c13(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = L.eval_set(spark, sf_dir).withColumnRenamed("id", "cog_id")
    path = scratch(spark, "georef-report")
    writers.write_csv(georef.georeferencing_report(georef_metrics(spark, sf_dir), maps), path)
    written = spark.read.csv(
        path, header=True,
        schema="cog_id long, annotated_system string, annotated_version string, performer string, performer_version string,"
        " log string, rmse double, sample_pnts long, scale long, state string, source string",
    )
    return written.groupBy("state", "log").agg(F.count("*").alias("n"), F.round(F.avg("rmse"), 7).alias("rmse_mean"))
