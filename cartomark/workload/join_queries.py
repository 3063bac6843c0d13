"""Check queries for joins, matching cascades, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.operators import balance, spatial
from cartomark.operators.similarity import best_matches
from cartomark.plans import evaluate, georef, inventory, labels, orchestrate
from cartomark.workload import logical as L
from cartomark.workload.registry import query
from cartomark.workload.scan_queries import ROUTE_SQL, route_inputs, z_sql
from cartomark.workload.spatial_queries import written_metrics

BOXES = L.with_sql(L.BOXES_SQL)
PAIRS = L.with_sql(L.BOXES_SQL, L.PAIRS_SQL)
SCORED = L.with_sql(L.BOXES_SQL, L.PAIRS_SQL, L.METRICS_SQL)


@query("j01_inner_join", "SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey")
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = L.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = L.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return orders.join(customers, "o_custkey")


LABEL_ORCH_SQL = ROUTE_SQL + """, grnd AS (
  SELECT id, geo_value, count(*) AS count_grnd FROM truth GROUP BY ALL
  UNION ALL SELECT DISTINCT id, 'Z', 1 FROM truth)
"""


@query(
    "j02_label_synopsis_join",
    LABEL_ORCH_SQL + """SELECT id, system, geo_value, count_grnd, n AS count_inf, n / count_grnd AS ratio, n * count_grnd AS combinations
      FROM syn JOIN grnd USING (id, geo_value)""",
)
def j02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchestrate.label_orchestration(*route_inputs(spark, sf_dir)).select(
        "id", "system", "geo_value", "count_grnd", "count_inf", "ratio", "combinations"
    )


@query(
    "j03_multi_key_join",
    SCORED.replace("WITH ", "WITH " + L.EVAL_SET_SQL.strip() + ",", 1)
    + "SELECT m.id, m.p_fid, e.scale, e.state FROM metrics m JOIN eval_set e ON m.id = e.id",
)
def j03(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = L.eval_set(spark, sf_dir).select("id", "scale", "state")
    return written_metrics(spark, sf_dir).select("id", "p_fid").join(maps, ["id"])


@query("j04_left_join", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'")
def j04(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = L.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey"
    )
    return L.table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left")


@query("j05_anti_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def j05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order still in process."""
    seen = L.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return L.table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(seen, "c_custkey", "left_anti")


@query("j06_positional_join", BOXES + "SELECT fid, id, x0, y0 FROM truth")
def j06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.truths(spark, sf_dir)
    systems, shapes = rows.select("fid", "id"), rows.select("fid", "x0", "y0")
    return systems.join(shapes, "fid")


@query(
    "j07_cell_prefilter",
    BOXES + f"""SELECT 'perf' AS side, p.id, p.fid FROM perf p WHERE EXISTS (
        SELECT 1 FROM truth g WHERE g.id = p.id AND g.geo_value = p.geo_value
        AND p.x0 // {L.CELL} <= g.x1 // {L.CELL} AND g.x0 // {L.CELL} <= p.x1 // {L.CELL}
        AND p.y0 // {L.CELL} <= g.y1 // {L.CELL} AND g.y0 // {L.CELL} <= p.y1 // {L.CELL})
      UNION ALL SELECT 'truth', g.id, g.fid FROM truth g WHERE EXISTS (
        SELECT 1 FROM perf p WHERE g.id = p.id AND g.geo_value = p.geo_value
        AND p.x0 // {L.CELL} <= g.x1 // {L.CELL} AND g.x0 // {L.CELL} <= p.x1 // {L.CELL}
        AND p.y0 // {L.CELL} <= g.y1 // {L.CELL} AND g.y0 // {L.CELL} <= p.y1 // {L.CELL})""",
)
def j07(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [
        side.select("id", "geo_value", "fid", "bbox")
        for side in (L.performers(spark, sf_dir), L.truths(spark, sf_dir))
    ]
    perf, truth = spatial.box_prefilter(*sides, ["id", "geo_value"], L.CELL)
    return perf.select(F.lit("perf").alias("side"), "id", "fid").unionByName(
        truth.select(F.lit("truth").alias("side"), "id", "fid")
    )


@query("j08_spatial_candidates", PAIRS + "SELECT id, geo_value, p_fid, g_fid FROM cand")
def j08(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spatial.spatial_pairs(
        L.performers(spark, sf_dir).select("id", "geo_value", "fid", "bbox"),
        L.truths(spark, sf_dir).select("id", "geo_value", "fid", "bbox"),
        ["id", "geo_value"],
        L.CELL,
    )
    return pairs.select("id", "geo_value", "p_fid", "g_fid")


WIDE_BOXES_SQL = L.with_sql(L.BOXES_SQL) + """,
wide AS (SELECT * REPLACE (x1 + CASE WHEN (x0 // 100 + y0) % 97 = 0 THEN 40000 ELSE 0 END AS x1,
                           y1 + CASE WHEN (x0 // 100 + y0) % 97 = 0 THEN 30000 ELSE 0 END AS y1) FROM boxes)
"""
WIDE_SQL = WIDE_BOXES_SQL + f""",
met AS (SELECT p.fid AS p_fid, p.x0 <= g.x1 AND g.x0 <= p.x1 AND p.y0 <= g.y1 AND g.y0 <= p.y1 AS hit
  FROM wide p JOIN wide g ON p.id = g.id AND p.geo_value = g.geo_value AND p.line <> 2 AND g.line = 2
   AND p.x0 // {L.CELL} <= g.x1 // {L.CELL} AND g.x0 // {L.CELL} <= p.x1 // {L.CELL}
   AND p.y0 // {L.CELL} <= g.y1 // {L.CELL} AND g.y0 // {L.CELL} <= p.y1 // {L.CELL})
SELECT p_fid, count(*) AS candidates, count(*) FILTER (hit) AS hits FROM met GROUP BY 1
"""


def wide_sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Predicted and truth boxes, one in a hundred of them as wide as a map."""
    grown = F.expr("(x0 div 100 + y0) % 97 = 0")
    wide = L.boxes(spark, sf_dir).withColumns(
        {"x1": F.col("x1") + F.when(grown, 40000).otherwise(0), "y1": F.col("y1") + F.when(grown, 30000).otherwise(0)}
    )
    sides = L.with_bbox(wide).select("id", "geo_value", "fid", "bbox", "line")
    return [sides.where("line <> 2").drop("line"), sides.where("line = 2").drop("line")]


@query(
    "j07_wide_prefilter",
    WIDE_BOXES_SQL + f"""SELECT a.line = 2 AS is_truth, a.id, a.fid FROM wide a WHERE EXISTS (
      SELECT 1 FROM wide b WHERE a.id = b.id AND a.geo_value = b.geo_value AND (a.line = 2) <> (b.line = 2)
       AND a.x0 // {L.CELL} <= b.x1 // {L.CELL} AND b.x0 // {L.CELL} <= a.x1 // {L.CELL}
       AND a.y0 // {L.CELL} <= b.y1 // {L.CELL} AND b.y0 // {L.CELL} <= a.y1 // {L.CELL})""",
)
def j07_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = spatial.box_prefilter(*wide_sides(spark, sf_dir), ["id", "geo_value"], L.CELL)
    perf, truth = (side.select(F.lit(is_truth).alias("is_truth"), "id", "fid") for side, is_truth in zip(kept, (False, True), strict=True))
    return perf.unionByName(truth)


@query("j08_wide_boxes", WIDE_SQL)
def j08_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates where one box in a hundred spans hundreds of cells."""
    pairs = spatial.spatial_pairs(*wide_sides(spark, sf_dir), ["id", "geo_value"], L.CELL)
    hit = G.boxes_intersect(F.col("p_bbox"), F.col("g_bbox"))
    return pairs.groupBy("p_fid").agg(F.count("*").alias("candidates"), F.count_if(hit).alias("hits"))


@query(
    "j09_predicate_and_iou",
    PAIRS + """SELECT p_fid, g_fid, hit AS success_overlap, iou_units,
      inter > 0 AND NOT (px0 <= gx0 AND py0 <= gy0 AND px1 >= gx1 AND py1 >= gy1)
        AND NOT (gx0 <= px0 AND gy0 <= py0 AND gx1 >= px1 AND gy1 >= py1) AS strict_overlap FROM pairs""",
)
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spatial.spatial_pairs(
        L.performers(spark, sf_dir).select("id", "geo_value", "fid", "bbox"),
        L.truths(spark, sf_dir).select("id", "geo_value", "fid", "bbox"),
        ["id", "geo_value"],
        L.CELL,
    )
    return spatial.score_boxes(pairs).select(
        "p_fid", "g_fid", "success_overlap", "iou_units",
        G.boxes_overlap(F.col("p_bbox"), F.col("g_bbox")).alias("strict_overlap"),
    )


@query(
    "j10_legend_box_match",
    BOXES + """, legend AS (
      SELECT id, fid, x0, y0, x1, y1, geo_value,
        row_number() OVER (PARTITION BY id ORDER BY fid) - 1 AS item FROM truth WHERE (y1 - y0 - 100) // 20 >= 4),
    scored AS (SELECT p.fid, l.item, l.geo_value, l.fid AS lfid,
      greatest(least(p.x1, l.x1) - greatest(p.x0, l.x0), 0) * greatest(least(p.y1, l.y1) - greatest(p.y0, l.y0), 0) AS inter,
      (p.x1 - p.x0) * (p.y1 - p.y0) + (l.x1 - l.x0) * (l.y1 - l.y0) AS areas
      FROM perf p JOIN legend l USING (id)),
    best AS (SELECT fid, geo_value || lfid AS geo_value, u / 1000.0::DOUBLE AS legend_iou,
      row_number() OVER (PARTITION BY fid ORDER BY u DESC, lfid) AS rn FROM (
      SELECT *, (2 * inter * 100000 + areas - inter) // (2 * (areas - inter)) AS u FROM scored))
    SELECT p.fid, coalesce(regexp_replace(b.geo_value, '\\W+', '', 'g'), 'Use Spatial Index') AS geo_value, legend_iou
    FROM perf p LEFT JOIN best b ON b.fid = p.fid AND rn = 1""",
)
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    legend = L.truths(spark, sf_dir).where("(y1 - y0 - 100) div 20 >= 4")
    legend = legend.select(
        F.col("id").alias("cog_id"),
        F.col("fid").alias("item"),
        "bbox",
        F.concat("geo_value", "fid").alias("abbreviation"),
        F.lit(None).cast("string").alias("label"),
    )
    perf = L.performers(spark, sf_dir).select("fid", F.col("id").alias("cog_id"), "bbox")
    return labels.assign_by_legend(perf, legend, L.CELL).select("fid", "geo_value", "legend_iou")


NAMES_SQL = """WITH l AS (SELECT DISTINCT p_brand AS id, p_name || ' ' || lower(p_type) AS value FROM part WHERE p_partkey % 2 = 0),
r AS (SELECT DISTINCT p_brand AS id, p_name || ' ' || lower(p_type) AS candidate FROM part WHERE p_partkey % 2 = 1),
s AS (SELECT id, value, candidate, 1.0::DOUBLE - CAST(levenshtein(value, candidate) AS DOUBLE) / greatest(length(value), length(candidate)) AS ratio
  FROM l JOIN r USING (id))
"""


def names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = L.table(spark, sf_dir, "part").withColumn("text", F.concat_ws(" ", "p_name", F.lower("p_type")))
    left = part.where("p_partkey % 2 = 0").select(F.col("p_brand").alias("id"), F.col("text").alias("value"))
    right = part.where("p_partkey % 2 = 1").select(F.col("p_brand").alias("id"), F.col("text").alias("candidate"))
    return left, right


@query(
    "j11_best_string_match",
    NAMES_SQL + """SELECT id, value, candidate, ratio FROM (SELECT *, row_number() OVER (PARTITION BY id, value ORDER BY ratio DESC, candidate) AS rn
      FROM s WHERE ratio > 0.8) WHERE rn = 1""",
)
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_matches(*names(spark, sf_dir), ["id"], 0.8, method="levenshtein")


@query(
    "j12_fallback_cascade",
    """WITH f AS (SELECT p_partkey AS fid, p_brand AS id, p_name AS abbreviation FROM part),
    d AS (SELECT DISTINCT p_brand AS id, upper(p_name) AS v FROM part WHERE p_partkey % 3 = 0),
    c AS (SELECT DISTINCT p_brand AS id, p_name AS v FROM part WHERE p_partkey % 5 = 0)
    SELECT fid, coalesce(d.v, c.v, 'Use Spatial Index') AS geo_value, d.v IS NOT NULL AS match_binary,
      CASE WHEN d.v IS NULL AND c.v IS NULL THEN NULL ELSE 1.0::DOUBLE END AS matched_ratio
    FROM f LEFT JOIN d ON d.id = f.id AND lower(d.v) = lower(abbreviation) LEFT JOIN c ON c.id = f.id AND lower(c.v) = lower(abbreviation)""",
)
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part")
    brand = F.col("p_brand").alias("id")
    features = part.select(F.col("p_partkey").alias("fid"), brand, F.col("p_name").alias("abbreviation"))
    direct = part.where("p_partkey % 3 = 0").select(brand, F.upper("p_name").alias("geo_value_vector"))
    crude = part.where("p_partkey % 5 = 0").select(brand, F.col("p_name").alias("unmatched_binary"))
    return labels.assign_by_abbreviation(features, direct, crude, 0.999).select(
        "fid", "geo_value", "match_binary", "matched_ratio"
    )


CRUDE_SQL = """WITH u AS (SELECT DISTINCT p_brand AS id, p_name AS unmatched_binary,
    CASE WHEN p_brand = 'Brand#7' THEN 'corrupted' ELSE 'no_corrupt' END AS read_corrupt FROM part WHERE p_partkey % 2 = 0),
o AS (SELECT DISTINCT p_name AS label, CASE WHEN length(p_name) % 2 = 0 THEN 'Point' ELSE 'LineString' END AS geom_type FROM part WHERE p_name NOT LIKE 'red%'),
f AS (SELECT DISTINCT p_brand AS id, p_brand || '_' || p_type AS shp_file, CASE WHEN p_type = 'PROMO' THEN 'Point' WHEN p_type = 'SMALL' THEN 'LineString' ELSE 'Polygon' END AS geom_type
  FROM part WHERE p_brand <> 'Brand#9'),
j AS (SELECT u.*, o.geom_type, f.shp_file FROM u LEFT JOIN o ON o.label = u.unmatched_binary LEFT JOIN f ON f.id = u.id AND f.geom_type = o.geom_type),
t AS (SELECT *, CASE WHEN read_corrupt <> 'no_corrupt' THEN 'corrupt ground-truth shapefile' WHEN geom_type IS NULL THEN 'Not in Dictionary'
  WHEN shp_file IS NULL THEN 'Does Not Exist In Ground-Truth' END AS reason FROM j)
"""


def crude_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = L.table(spark, sf_dir, "part")
    brand = F.col("p_brand").alias("id")
    unmatched = part.where("p_partkey % 2 = 0").select(
        brand,
        F.col("p_name").alias("unmatched_binary"),
        F.when(F.col("p_brand") == "Brand#7", "corrupted").otherwise("no_corrupt").alias("read_corrupt"),
    ).distinct()
    onto = part.where("p_name not like 'red%'").select(
        F.col("p_name").alias("label"),
        F.when(F.length("p_name") % 2 == 0, "Point").otherwise("LineString").alias("feature_type"),
    ).distinct()
    kinds = part.where("p_brand <> 'Brand#9'").select(
        brand,
        F.concat_ws("_", "p_brand", "p_type").alias("shp_file"),
        F.when(F.col("p_type") == "PROMO", "Point")
        .when(F.col("p_type") == "SMALL", "LineString")
        .otherwise("Polygon")
        .alias("geom_type"),
    ).distinct()
    return labels.crude_matches(unmatched, kinds, onto)


@query("j13_geometry_type_join", CRUDE_SQL + "SELECT id, unmatched_binary, geom_type, shp_file FROM t WHERE reason IS NULL")
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crude_tables(spark, sf_dir)[0]


@query(
    "j14_crude_orchestration",
    ROUTE_SQL + """, routes AS (SELECT id, system FROM stats WHERE valid AND miss = total)
    SELECT r.id, r.system, s.n AS count_inf, g.n AS count_grnd, s.n * g.n AS combinations, g.geo_value AS shp_file
    FROM routes r JOIN (SELECT id, system, sum(n)::BIGINT AS n FROM syn GROUP BY ALL) s USING (id, system)
    JOIN (SELECT id, geo_value, count(*) AS n FROM truth WHERE geo_value <> 'N' GROUP BY ALL) g USING (id)""",
)
def j14(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, grnd, syn = route_inputs(spark, sf_dir)
    files = orchestrate.file_orchestration(schema, grnd, syn)
    kinds = L.truths(spark, sf_dir).groupBy("id", F.col("geo_value").alias("shp_file")).agg(F.count("*").alias("count"))
    kinds = kinds.withColumn("geom_type", F.when(F.col("shp_file") == "N", "line").otherwise("polygon"))
    counts = syn.groupBy(*orchestrate.FILE_KEYS).agg(F.sum("count").alias("count"))
    return orchestrate.crude_orchestration(files, kinds, counts).select(
        "id", "system", "count_inf", "count_grnd", "combinations", "shp_file"
    )


SYSTEMS = "role string, priority int, system string, system_version string"


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured systems from the roles of line numbers: 2 before 4 annotate, 1 and 3 perform."""
    lines = L.by_role(L.table(spark, sf_dir, "lineitem"), 4).select("l_linenumber").distinct()
    role = F.when(F.col("l_linenumber").isin(2, 4), "annotated").otherwise("performer")
    return lines.select(
        role.alias("role"),
        F.col("l_linenumber").alias("priority"),
        F.concat(F.lit("sys_"), F.col("l_linenumber").cast("string")).alias("system"),
        F.lit("1.0").alias("system_version"),
    )


def system_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presence of four systems per map, with gaps by map number."""
    return L.by_role(L.table(spark, sf_dir, "lineitem"), 4).where(
        "not (l_linenumber = 2 and l_suppkey % 3 = 0)"
        " and not (l_linenumber in (2, 4) and l_suppkey % 7 = 0)"
    ).select(
        F.col("l_suppkey").alias("cog_id"),
        F.concat(F.lit("sys_"), F.col("l_linenumber").cast("string")).alias("system"),
        F.lit("1.0").alias("system_version"),
    )


@query(
    "j15_preferred_source",
    """SELECT l_suppkey AS cog_id, 'sys_' || min(l_linenumber) AS annotated_system
    FROM (SELECT l_suppkey, (l_linenumber - 1) % 4 + 1 AS l_linenumber FROM lineitem) WHERE l_linenumber IN (2, 4) AND NOT (l_linenumber = 2 AND l_suppkey % 3 = 0) AND l_suppkey % 7 <> 0 GROUP BY 1""",
)
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    annotated = systems(spark, sf_dir).where("role = 'annotated'").drop("role")
    return georef.preferred_annotation(system_points(spark, sf_dir), annotated).select("cog_id", "annotated_system")


DIRS_SQL = """WITH dirs AS (SELECT DISTINCT '/data/m' || o_orderpriority[1] || '/' || o_custkey || '/' AS directory FROM orders),
ids AS (SELECT c_custkey::VARCHAR AS id FROM customer),
tok AS (SELECT directory, regexp_extract(directory, '\\d{1}') AS id, 1 AS n FROM dirs
  UNION ALL SELECT directory, regexp_extract(directory, '\\d{2}'), 2 FROM dirs
  UNION ALL SELECT directory, regexp_extract(directory, '\\d{3}'), 3 FROM dirs
  UNION ALL SELECT directory, regexp_extract(directory, '\\d{4}'), 4 FROM dirs
  UNION ALL SELECT directory, regexp_extract(directory, '\\d{5}'), 5 FROM dirs
  UNION ALL SELECT directory, regexp_extract(directory, '\\d{6}'), 6 FROM dirs)
"""


def map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order, in a folder per priority class and customer."""
    folder = F.concat(
        F.lit("/data/m"), F.substring("o_orderpriority", 1, 1), F.lit("/"), F.col("o_custkey").cast("string"), F.lit("/")
    )
    ext = F.when(F.col("o_orderstatus") == "F", ".tif").when(F.col("o_orderstatus") == "O", ".shp").otherwise(".feather")
    return L.table(spark, sf_dir, "orders").select(
        folder.alias("directory"),
        F.concat(F.lit("f_"), F.col("o_orderkey").cast("string"), ext).alias("filename"),
        ext.alias("file_ext"),
        F.col("o_custkey").cast("string").alias("owner"),
    )


@query("j16_pattern_containment", DIRS_SQL + "SELECT id, directory FROM tok JOIN ids USING (id) WHERE length(id) = n")
def j16(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = L.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    return inventory.id_directories(ids, map_files(spark, sf_dir))


# --- ranking, sorting, sets -----------------------------------------------------------------


@query("w01_best_match", SCORED + "SELECT p_fid, g_fid, iou_units, true_positives FROM metrics")
def w01(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.match_boxes(
        L.performers(spark, sf_dir).select("id", "geo_value", "fid", "bbox"),
        L.truths(spark, sf_dir).select("id", "geo_value", "fid", "bbox"),
        L.CELL, L.PIXEL, ["id", "geo_value"],
    )
    return found.where("g_fid is not null").select("p_fid", "g_fid", "iou_units", "true_positives")


@query(
    "w02_first_maximum",
    "SELECT p_brand, p_name, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part) WHERE rn = 1",
)
def w02(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = F.min(F.struct((-F.col("p_size")).alias("s"), "p_partkey", "p_name", "p_size"))
    return L.table(spark, sf_dir, "part").groupBy("p_brand").agg(pick.alias("b")).select("p_brand", "b.p_name", "b.p_size")


@query(
    "w03_first_per_key",
    "SELECT id, path FROM (SELECT l_suppkey AS id, l_orderkey || '.tif' AS path, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey || '.tif') AS rn FROM lineitem) WHERE rn = 1",
)
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = L.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".tif")).alias("path"),
        F.col("l_extendedprice").alias("size"),
        F.lit(True).alias("has_file"),
    )
    return inventory.one_raster_per_id(files)



ORDER_STATS_SQL = """WITH v AS (SELECT c_custkey, c_mktsegment AS seg, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE floor(c_acctbal / 400) END AS v FROM customer),
r AS (SELECT seg, v, row_number() OVER (PARTITION BY seg ORDER BY v) - 1 AS rk, count(*) OVER (PARTITION BY seg) AS n FROM v WHERE v IS NOT NULL),
q AS (SELECT DISTINCT seg, n, p, (n - 1) * (p / 10.0::DOUBLE) AS h FROM r CROSS JOIN range(0, 11) t(p)),
e AS (SELECT q.seg, q.p, min(r.v) + (max(r.v) - min(r.v)) * (q.h - floor(q.h)) AS edge
  FROM q JOIN r ON r.seg = q.seg AND (r.rk = floor(q.h) OR r.rk = ceil(q.h)) GROUP BY q.seg, q.p, q.h),
d AS (SELECT DISTINCT seg, edge FROM e)
"""


@query(
    "w04_equal_frequency_bins",
    ORDER_STATS_SQL + """SELECT v.c_custkey, CASE WHEN v.v IS NOT NULL AND (SELECT count(*) FROM d WHERE d.seg = v.seg) > 1
      THEN greatest((SELECT count(*) FROM d WHERE d.seg = v.seg AND d.edge < v.v) - 1, 0) END AS bin FROM v""",
)
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        F.when(F.col("c_custkey") % 17 != 0, F.floor(F.col("c_acctbal") / 400)).cast("double").alias("v"),
    )
    return balance.equal_frequency_bins(rows, ["c_mktsegment"], "v", 10, "bin").select("c_custkey", "bin")


@query(
    "w04_bins_of_hot_groups",
    ORDER_STATS_SQL + """SELECT v.c_custkey, CASE WHEN v.v IS NOT NULL AND (SELECT count(*) FROM d WHERE d.seg = v.seg) > 1
      THEN greatest((SELECT count(*) FROM d WHERE d.seg = v.seg AND d.edge < v.v) - 1, 0) END AS bin FROM v""",
)
def w04_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        F.when(F.col("c_custkey") % 17 != 0, F.floor(F.col("c_acctbal") / 400)).cast("double").alias("v"),
    )
    return balance.equal_frequency_bins(rows, ["c_mktsegment"], "v", 10, "bin").select("c_custkey", "bin")


@query(
    "w05_candidate_counts",
    PAIRS + """SELECT id, geo_value, system, p_fid, count(*) AS num_cand_geom,
      count(*) OVER (PARTITION BY id, geo_value, system) AS num_cand_perf FROM pairs GROUP BY id, geo_value, system, p_fid""",
)
def w05(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = ["id", "geo_value", "system"]
    per_feature = evaluate.match_boxes(
        L.performers(spark, sf_dir).select(*group, "fid", "bbox"),
        L.truths(spark, sf_dir).select("id", "geo_value", "fid", "bbox"),
        L.CELL, L.PIXEL, ["id", "geo_value"],
    ).select(*group, "p_fid", "num_cand_geom")
    per_label = per_feature.groupBy(*group).agg(F.count("*").alias("num_cand_perf"))
    return per_feature.join(per_label, group)


@query(
    "w06_seeded_sample",
    """WITH r AS (SELECT s_suppkey AS id, unnest(range(1, 61 + s_suppkey % 9)) AS v FROM supplier),
    c AS (SELECT s_suppkey AS id, unnest(range(1, 91 + s_suppkey % 5)) AS v FROM supplier),
    rr AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY md5('42|' || id || '|row|' || v)) AS k FROM r),
    cc AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY md5('42|' || id || '|col|' || v)) AS k FROM c)
    SELECT id, k, rr.v AS random_pix_height, cc.v AS random_pix_width FROM rr JOIN cc USING (id, k) WHERE k <= 10""",
)
def w06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rasters = L.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_suppkey") % 9 + 60).alias("height"),
        (F.col("s_suppkey") % 5 + 90).alias("width"),
    )
    return georef.sample_pixels(rasters).drop("height", "width")


@query("l01_sort", "SELECT p_partkey, p_name, p_size FROM part ORDER BY p_name, p_size, p_partkey")
def l01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size").orderBy("p_name", "p_size", "p_partkey")


@query("l02_dedup_on_subset", "SELECT DISTINCT p_name, p_type FROM part")
def l02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "part").dropDuplicates(["p_name", "p_type"]).select("p_name", "p_type")


@query("l03_z_order_layout", BOXES + f"SELECT fid, {z_sql('x0', 'y0')} AS z_index FROM truth")
def l03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.z_order_layout(L.truths(spark, sf_dir), F.col("x0"), F.col("y0")).select("fid", "z_index")


@query("l04_work_balanced_join", BOXES + "SELECT p.id, p.fid AS p_fid, g.fid AS g_fid FROM perf p JOIN truth g USING (id, geo_value) WHERE abs(p.x0 - g.x0) <= 100 AND abs(p.y0 - g.y0) <= 100")
def l04(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["id", "geo_value"]
    left = L.performers(spark, sf_dir).select(*keys, F.col("fid").alias("p_fid"), F.col("x0").alias("px"), F.col("y0").alias("py"))
    right = L.truths(spark, sf_dir).select(*keys, F.col("fid").alias("g_fid"), F.col("x0").alias("gx"), F.col("y0").alias("gy"))
    # Neighbouring truth positions: all squares of side 400 within 100, mostly one or two.
    left = left.withColumns({"cx": F.expr("px div 400"), "cy": F.expr("py div 400")})
    right = spatial.near_squares(right, {"gx": "cx", "gy": "cy"}, 100, 400)
    on = [*keys, "cx", "cy"]
    left, right = balance.salt_by_work(left, right, on, "p_fid", target_pairs=2)
    return (
        left.join(right, [*on, "salt"])
        .where("abs(px - gx) <= 100 and abs(py - gy) <= 100")
        .select("id", "p_fid", "g_fid")
    )


@query("l05_first_item", "SELECT c_mktsegment, min(c_custkey) AS first_id FROM customer GROUP BY 1")
def l05(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = balance.first_per_key(L.table(spark, sf_dir, "customer"), ["c_mktsegment"], [F.asc("c_custkey")])
    return first.select("c_mktsegment", F.col("c_custkey").alias("first_id"))


@query("u01_union_all", "SELECT s_suppkey AS id, s_name AS name, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = L.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    customers = L.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return suppliers.unionByName(customers, allowMissingColumns=True)


@query("u02_except", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def u02(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = L.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return L.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).subtract(have)


@query("u03_intersect", "SELECT p_name FROM part WHERE p_partkey % 2 = 0 INTERSECT SELECT p_name FROM part WHERE p_partkey % 2 = 1")
def u03(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part")
    return part.where("p_partkey % 2 = 0").select("p_name").intersect(part.where("p_partkey % 2 = 1").select("p_name"))
