"""Check queries for aggregations, roll-ups and jobs built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.operators import blocks, raster, spatial
from cartomark.plans import georef, labels, orchestrate, prepare, report
from cartomark.functions import geometry as G
from cartomark.functions import projection as P
from cartomark.session import materialize
from cartomark.workload import logical as L
from cartomark.workload.registry import query
from cartomark.workload.scan_queries import CELLS_SQL, ROUTE_SQL, route_inputs
from cartomark.workload.join_queries import system_points, systems
from cartomark.workload.spatial_queries import written_metrics

BOXES = L.with_sql(L.BOXES_SQL)
SCORED = L.with_sql(L.BOXES_SQL, L.PAIRS_SQL, L.METRICS_SQL)


@query(
    "a01_count_and_sum",
    BOXES + "SELECT id, geo_value, count(*) AS n, sum(x1 - x0)::BIGINT AS width FROM truth GROUP BY ALL",
)
def a01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.truths(spark, sf_dir).groupBy("id", "geo_value").agg(
        F.count("*").alias("n"), F.sum(F.expr("x1 - x0")).alias("width")
    )


LABEL_ROLLUP_SQL = SCORED + """, ratios AS (SELECT *, num_cand_perf / num_cand_geom AS cr, inf_count / grnd_count AS ir FROM metrics),
by_label AS (
  SELECT id, system, geo_value, f1_message, count(iou) AS iou_count,
    sum(iou_units)::BIGINT / count(*) / 1000.0::DOUBLE AS iou_mean, median(iou) AS iou_median,
    avg(f1) AS f1_mean, median(f1) AS f1_median, avg(cr) AS candidate_ratio_mean, median(cr) AS candidate_ratio_median,
    avg(ir) AS inf_grnd_ratio_mean, median(ir) AS inf_grnd_ratio_median
  FROM ratios GROUP BY ALL),
by_map AS (
  SELECT id, system, count(DISTINCT geo_value) AS geo_value_nunique, count(iou) AS iou_count,
    sum(iou_units)::BIGINT / count(*) / 1000.0::DOUBLE AS iou_mean, median(iou) AS iou_median,
    avg(f1) AS f1_mean, median(f1) AS f1_median, avg(cr) AS candidate_ratio_mean, median(cr) AS candidate_ratio_median,
    avg(ir) AS inf_grnd_ratio_mean, median(ir) AS inf_grnd_ratio_median
  FROM ratios GROUP BY ALL)
"""
ROUNDED = (
    "iou_mean iou_median f1_mean f1_median candidate_ratio_mean candidate_ratio_median "
    "inf_grnd_ratio_mean inf_grnd_ratio_median"
).split()


def rounded(df: DataFrame, cols=ROUNDED) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in cols if c in df.columns})


def rounded_sql(cols=ROUNDED) -> str:
    return ", ".join(f"round({c}, 9) AS {c}" for c in cols)


@query(
    "a02_label_rollup",
    LABEL_ROLLUP_SQL + f"SELECT id, system, geo_value, f1_message, iou_count, {rounded_sql()} FROM by_label",
)
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report.label_rollup(written_metrics(spark, sf_dir))).drop("system_version")


@query(
    "a02_map_rollup",
    LABEL_ROLLUP_SQL + f"SELECT id, system, geo_value_nunique, iou_count, {rounded_sql()} FROM by_map",
)
def a02_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report.map_rollup(written_metrics(spark, sf_dir))).drop("system_version")


@query(
    "a03_aggregate_of_aggregates",
    LABEL_ROLLUP_SQL + """SELECT system, round(avg(iou_median), 6) AS iou_median_mean, round(median(iou_median), 6) AS iou_median_median,
      round(avg(f1_median), 6) AS f1_median_mean, round(median(f1_median), 6) AS f1_median_median FROM by_map GROUP BY system""",
)
def a03(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["iou_median_mean", "iou_median_median", "f1_median_mean", "f1_median_median"]
    out = report.performer_rollup(report.map_rollup(written_metrics(spark, sf_dir)))
    return out.select("system", *[F.round(c, 6).alias(c) for c in cols])


@query(
    "a04_distinct_count",
    BOXES + "SELECT system, count(DISTINCT id) AS id_nunique, count(DISTINCT geo_value) AS label_nunique FROM perf GROUP BY system",
)
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.performers(spark, sf_dir).groupBy("system").agg(
        F.count_distinct("id").alias("id_nunique"), F.count_distinct("geo_value").alias("label_nunique")
    )


DECILE_SQL = """, r AS (SELECT *, row_number() OVER (PARTITION BY system ORDER BY iou_median) - 1 AS rk,
    count(*) OVER (PARTITION BY system) AS n FROM {src}),
q AS (SELECT DISTINCT system, n, p, (n - 1) * (p / 10.0::DOUBLE) AS h FROM r CROSS JOIN range(0, 11) t(p)),
e AS (SELECT DISTINCT q.system, min(r.iou_median) + (max(r.iou_median) - min(r.iou_median)) * (q.h - floor(q.h)) AS edge
  FROM q JOIN r ON r.system = q.system AND (r.rk = floor(q.h) OR r.rk = ceil(q.h)) GROUP BY q.system, q.p, q.h),
binned AS (SELECT r.*, greatest((SELECT count(*) FROM e WHERE e.system = r.system AND e.edge < r.iou_median) - 1, 0) AS iou_median_q FROM r)
"""


@query(
    "a05_decile_rollup",
    LABEL_ROLLUP_SQL + DECILE_SQL.format(src="by_map") + """SELECT system, iou_median_q, count(DISTINCT id) AS id_nunique, sum(iou_count)::BIGINT AS iou_count_sum,
      round(avg(iou_median), 6) AS iou_median_mean, round(median(iou_median), 6) AS iou_median_median FROM binned GROUP BY ALL""",
)
def a05(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = report.map_rollup(written_metrics(spark, sf_dir))
    out = report.decile_rollup(maps, "iou_median")
    return out.select(
        "system", "iou_median_q", "id_nunique", "iou_count_sum",
        F.round("iou_median_mean", 6).alias("iou_median_mean"),
        F.round("iou_median_median", 6).alias("iou_median_median"),
    )


MATCHES_SQL = """WITH m AS (SELECT DISTINCT p_brand AS id, p_type || '.shp' AS shp_file, p_name AS binary_value, upper(p_name) AS geo_value_vector, 1.0::DOUBLE AS matched_ratio FROM part)
"""


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("id"),
        F.concat("p_type", F.lit(".shp")).alias("shp_file"),
        F.lit("name").alias("field_name"),
        F.lit("sequence").alias("match_method"),
        F.lit("Polygon").alias("geom_type"),
        F.lit("no_corrupt").alias("read_corrupt"),
        F.col("p_name").alias("binary_value"),
        F.upper("p_name").alias("geo_value_vector"),
        F.lit(1.0).alias("matched_ratio"),
    ).distinct()


@query(
    "a06_collect_lists",
    MATCHES_SQL + """SELECT id, shp_file, string_agg(binary_value, '|' ORDER BY binary_value) AS binary_value,
      string_agg(geo_value_vector, '|' ORDER BY binary_value) AS geo_value_vector FROM m GROUP BY id, shp_file""",
)
def a06(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = labels.group_matches(matches(spark, sf_dir))
    return grouped.select(
        "id", "shp_file",
        F.array_join("binary_value", "|").alias("binary_value"),
        F.array_join("geo_value_vector", "|").alias("geo_value_vector"),
    )


@query("a07_distinct_in_group", "SELECT DISTINCT p_brand AS id, p_type AS matched_value FROM part")
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = L.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("id")).agg(F.collect_set("p_type").alias("v"))
    return grouped.select("id", F.explode("v").alias("matched_value"))


@query(
    "a08_pixel_overlap",
    L.with_sql(L.BOXES_SQL, L.PAIRS_SQL) + """SELECT p_fid, g_fid, tp AS true_positives, len_pdf, len_gdf,
      CAST(tp AS DOUBLE) / len_pdf AS "precision", CAST(tp AS DOUBLE) / len_gdf AS recall,
      CAST(2 * tp AS DOUBLE) / (len_pdf + len_gdf) AS f1, 'success-f1' AS f1_message FROM pairs WHERE hit""",
)
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    perf = L.performers(spark, sf_dir).select("id", "geo_value", "fid", "bbox")
    truth = L.truths(spark, sf_dir).select("id", "geo_value", "fid", "bbox")
    pairs = spatial.spatial_pairs(
        perf, truth, ["id", "geo_value"], L.CELL, condition=G.boxes_intersect(F.col("p_bbox"), F.col("g_bbox"))
    ).select("p_fid", "g_fid")
    # Read for the boxes to draw on either side, for their overlap and for the scores.
    pairs = materialize(pairs, "box-pairs")
    # Runs travel only for boxes that have a pair, and those of a band of image rows as one row.
    perf = perf.join(pairs.select(F.col("p_fid").alias("fid")), "fid", "left_semi")
    truth = truth.join(pairs.select(F.col("g_fid").alias("fid")), "fid", "left_semi")
    return raster.pixel_scores(pairs, *(raster.box_runs(side, L.PIXEL, stacked=True) for side in (perf, truth)))


SLANTED_SQL = L.with_sql(L.BOXES_SQL, L.PAIRS_SQL) + f""", shapes AS (
  SELECT fid, x0 // {L.PIXEL} AS a, y0 // {L.PIXEL} AS b, x1 // {L.PIXEL} AS c, y1 // {L.PIXEL} AS d FROM boxes),
rows AS (SELECT fid, a, r, CASE WHEN d - b >= c - a THEN floor(c + (r - b) * ((a - c)::DOUBLE / (d - b)) + 0.5::DOUBLE)
    ELSE floor(round(c + (greatest(r - 0.5::DOUBLE, b::DOUBLE) - b) * ((a - c)::DOUBLE / (d - b)), 9)) END::BIGINT AS e
  FROM (SELECT *, unnest(range(b, d + 1)) AS r FROM shapes)),
sizes AS (SELECT fid, sum(e - a + 1)::BIGINT AS n FROM rows GROUP BY fid),
shared AS (SELECT p_fid, g_fid, sum(greatest(least(p.e, g.e) - greatest(p.a, g.a) + 1, 0))::BIGINT AS met
  FROM pairs JOIN rows p ON p.fid = p_fid JOIN rows g ON g.fid = g_fid AND g.r = p.r WHERE hit GROUP BY ALL)
SELECT p_fid, g_fid, coalesce(met, 0) AS true_positives, p.n AS len_pdf, g.n AS len_gdf, coalesce(2 * met, 0)::DOUBLE / (p.n + g.n) AS f1
FROM pairs LEFT JOIN shared USING (p_fid, g_fid) JOIN sizes p ON p.fid = p_fid JOIN sizes g ON g.fid = g_fid WHERE hit"""


@query("a08_slanted_overlap", SLANTED_SQL)
def a08_slanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right triangles in whole pixels, met as blocks; the twin counts them row by row."""
    perf, truth = L.performers(spark, sf_dir), L.truths(spark, sf_dir)
    pairs = spatial.spatial_pairs(
        perf.select("id", "geo_value", "fid", "bbox"), truth.select("id", "geo_value", "fid", "bbox"), ["id", "geo_value"],
        L.CELL, condition=G.boxes_intersect(F.col("p_bbox"), F.col("g_bbox")),
    ).select("p_fid", "g_fid")
    # Read for the shapes to draw on either side, twice for their overlap and for the scores.
    pairs = materialize(pairs, "slanted-pairs")

    def drawn(side: DataFrame, key: str) -> DataFrame:
        side = side.join(pairs.select(F.col(key).alias("fid")).distinct(), "fid", "left_semi")
        x0, y0, x1, y1 = (F.floor(F.col(c) / L.PIXEL).cast("double") for c in ("x0", "y0", "x1", "y1"))
        ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x0, y1), (x0, y0))])
        return blocks.outline_blocks(side.select("fid", G.geometry(F.lit("polygon"), F.array(ring)).alias("px_geom")))

    scores = blocks.block_scores(pairs, *(materialize(drawn(s, k), "slanted-blocks") for s, k in ((perf, "p_fid"), (truth, "g_fid"))))
    return scores.select("p_fid", "g_fid", "true_positives", "len_pdf", "len_gdf", "f1")


@query(
    "a09_missing_label_stats",
    ROUTE_SQL + """SELECT id, system, valid AS valid_synops, CASE WHEN valid THEN miss END AS num_missing,
      CASE WHEN valid THEN coalesce(miss_list, '') END AS missing_val,
      CASE WHEN valid THEN round(miss / total, 3) * 100 ELSE 100 END AS perc_missing, total - miss AS size_df FROM stats""",
)
def a09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchestrate.file_orchestration(*route_inputs(spark, sf_dir)).select(
        "id", "system", "valid_synops", "num_missing",
        F.array_join("missing_val", ",").alias("missing_val"), "perc_missing", "size_df",
    )


AFFINE_SQL = """, m AS (SELECT cog_id, system, count(*) AS n, avg(col) AS mc, avg("row") AS mr, avg(lon) AS mx, avg(lat) AS my,
    var_pop(col) AS vcc, var_pop("row") AS vrr, covar_pop(col, "row") AS vcr, covar_pop(col, lon) AS vcx, covar_pop("row", lon) AS vrx,
    covar_pop(col, lat) AS vcy, covar_pop("row", lat) AS vry FROM gcps GROUP BY ALL),
s AS (SELECT *, vcc * vrr - vcr * vcr AS det FROM m),
fit AS (SELECT cog_id, system, n, mc, mr, mx, my, CASE WHEN n >= 3 AND det > vcc * vrr * 1e-9 THEN (vcx * vrr - vrx * vcr) / det END AS a,
    CASE WHEN n >= 3 AND det > vcc * vrr * 1e-9 THEN (vrx * vcc - vcx * vcr) / det END AS b,
    CASE WHEN n >= 3 AND det > vcc * vrr * 1e-9 THEN (vcy * vrr - vry * vcr) / det END AS d,
    CASE WHEN n >= 3 AND det > vcc * vrr * 1e-9 THEN (vry * vcc - vcy * vcr) / det END AS e FROM s),
fits AS (SELECT *, mx - a * mc - b * mr AS c, my - d * mc - e * mr AS f FROM fit)
"""


@query(
    "a10_affine_fit",
    L.with_sql(L.GCPS_SQL) + AFFINE_SQL + """SELECT cog_id, system, n AS n_gcps, round(a, 8) AS a, round(b, 8) AS b, round(c, 7) AS c,
      round(d, 8) AS d, round(e, 8) AS e, round(f, 7) AS f FROM fits""",
)
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = georef.fit_affine(L.gcps(spark, sf_dir), ["cog_id", "system"])
    t = F.col("transform")
    digits = {"a": 8, "b": 8, "c": 7, "d": 8, "e": 8, "f": 7}
    return fits.select("cog_id", "system", "n_gcps", *[F.round(t[c], n).alias(c) for c, n in digits.items()])


@query(
    "a11_rmse",
    """SELECT l_suppkey AS cog_id, round(sqrt(avg(l_tax * l_tax)), 9) AS rmse, count(*) AS sample_pnts FROM lineitem GROUP BY 1""",
)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    errors = L.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("cog_id"),
        F.col("l_orderkey").alias("k"),
        F.col("l_tax").alias("km"),
        point.alias("annotated_pnt"),
        point.alias("performer_pnt"),
    )
    return georef.rmse(errors, ["cog_id"]).select("cog_id", F.round("rmse", 9).alias("rmse"), "sample_pnts")


PLANAR_SQL = """WITH per AS (SELECT l_suppkey AS id, l_suppkey % 3 AS u, sqrt(avg((l_discount * 100) ** 2 + (l_tax * 100) ** 2)) AS rmse FROM lineitem GROUP BY ALL),
km AS (SELECT id, rmse, rmse * CASE u WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1000.0::DOUBLE ELSE 0.304800609601219::DOUBLE END / 1000.0::DOUBLE AS rmse_km FROM per)
"""


def planar(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = (
        F.when(F.col("l_suppkey") % 3 == 0, "metre")
        .when(F.col("l_suppkey") % 3 == 1, "kilometer")
        .otherwise("U.S. Surveyor's Foot")
    )
    points = L.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        unit.alias("unit"),
        F.lit(0.0).alias("x"),
        F.lit(0.0).alias("y"),
        (F.col("l_discount") * 100).alias("pred_x"),
        (F.col("l_tax") * 100).alias("pred_y"),
    )
    units = spark.createDataFrame([(name, m) for _, name, m in P.UNITS], "unit string, metres double")
    return georef.planar_rmse(points, ["id"], units)


@query("a12_planar_rmse", PLANAR_SQL + "SELECT id, round(rmse, 8) AS rmse, round(rmse_km, 8) AS rmse_km FROM km")
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planar(spark, sf_dir).select("id", F.round("rmse", 8).alias("rmse"), F.round("rmse_km", 8).alias("rmse_km"))


@query(
    "a12_rmse_summary",
    PLANAR_SQL + """SELECT count(*) AS "count", round(min(rmse_km), 8) AS "min", round(max(rmse_km), 8) AS "max",
      round(stddev_samp(rmse_km), 8) AS std, round(avg(rmse_km), 8) AS mean, round(median(rmse_km), 8) AS median FROM km""",
)
def a12_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = georef.rmse_summary(planar(spark, sf_dir))
    return out.select("count", *[F.round(c, 8).alias(c) for c in ("min", "max", "std", "mean", "median")])


FILE_SQL = BOXES + """, syn AS (SELECT id, system, geo_value, count(*) AS n FROM perf GROUP BY ALL)
"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performer features with file keys and assigned label columns."""
    return L.performers(spark, sf_dir).withColumns(
        {
            "cog_id": F.col("id").cast("string"),
            "feature_type": F.lit("polygon"),
            "abbreviation": F.lower("geo_value"),
            "matched_ratio": F.lit(1.0),
            "match_binary": F.lit(True),
        }
    )


@query(
    "a13_share_of_total",
    FILE_SQL + """SELECT id, system, lower(geo_value) AS abbreviation, geo_value, n AS "count",
      n / sum(n) OVER (PARTITION BY id, system)::DOUBLE AS perc FROM syn""",
)
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.synopsis(labelled(spark, sf_dir)).select("id", "system", "abbreviation", "geo_value", "count", "perc")


@query(
    "a14_success_rate",
    """WITH w AS (SELECT DISTINCT p_brand AS id, p_name AS v FROM part), m AS (SELECT DISTINCT p_brand AS id, p_name AS v FROM part WHERE p_size < 10)
    SELECT w.id, count(*) AS n_labels, count(m.v) AS n_matched, round(count(m.v) / count(*), 3) AS success_rate FROM w LEFT JOIN m ON m.id = w.id AND m.v = w.v GROUP BY w.id""",
)
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part").select(F.col("p_brand").alias("id"), F.col("p_name").alias("binary_value"), "p_size")
    return labels.success_rates(part, part.where("p_size < 10"))


@query(
    "a15_presence_check",
    """SELECT l_suppkey AS cog_id, bool_or(l_linenumber IN (2, 4)) AS has_annotated, bool_or(l_linenumber IN (1, 3)) AS has_performer
    FROM (SELECT l_suppkey, (l_linenumber - 1) % 4 + 1 AS l_linenumber FROM lineitem) WHERE NOT (l_linenumber = 2 AND l_suppkey % 3 = 0) AND NOT (l_linenumber IN (2, 4) AND l_suppkey % 7 = 0) GROUP BY 1""",
)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return georef.presence(system_points(spark, sf_dir), systems(spark, sf_dir))


@query(
    "a16_spatial_index_table",
    CELLS_SQL + f"""SELECT a.id, c.coarse_cell, a.fine_cell, count(*) AS n_refs, min(a.fid) AS first_ref
      FROM cells a JOIN (SELECT DISTINCT fid, fine_cell >> {2 * L.COARSE_LEVELS} AS coarse_cell FROM cells) c USING (fid) GROUP BY ALL""",
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = spatial.with_cells(L.truths(spark, sf_dir).select("id", "fid", "bbox"), L.CELL, L.COARSE_LEVELS)
    index = spatial.cell_index_table(covered, ["id"], page_rows=4)
    return index.groupBy("id", "coarse_cell", "fine_cell").agg(
        F.sum(F.size("refs")).alias("n_refs"), F.min(F.element_at("refs", 1)).alias("first_ref")
    )


@query(
    "a17_label_compilation",
    MATCHES_SQL + """SELECT DISTINCT binary_value, geo_value_vector, matched_ratio FROM m
      UNION ALL SELECT DISTINCT p_name || '?', NULL, NULL::DOUBLE FROM part WHERE p_size > 45""",
)
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = L.table(spark, sf_dir, "part").where("p_size > 45").select(
        F.concat("p_name", F.lit("?")).alias("unmatched_binary")
    ).distinct()
    return labels.compile_labels(matches(spark, sf_dir), rest)


@query(
    "c09_orchestration",
    ROUTE_SQL + """SELECT id, system, CASE WHEN valid AND round(miss / total, 3) * 100 < 100 AND total > miss THEN 'direct'
      WHEN valid AND miss = total THEN 'crude' ELSE 'invalid' END AS route, l.combinations
    FROM stats LEFT JOIN (SELECT s.id, s.system, sum(s.n * g.n)::BIGINT AS combinations FROM syn s JOIN
      (SELECT id, geo_value, count(*) AS n FROM truth GROUP BY ALL UNION ALL SELECT DISTINCT id, 'Z', 1 FROM truth) g USING (id, geo_value) GROUP BY ALL) l USING (id, system)""",
)
def c09(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = route_inputs(spark, sf_dir)
    files = orchestrate.file_orchestration(*inputs)
    work = orchestrate.label_orchestration(*inputs).groupBy(*orchestrate.FILE_KEYS).agg(
        F.sum("combinations").alias("combinations")
    )
    return files.join(work, orchestrate.FILE_KEYS, "left").select("id", "system", "route", "combinations")


REPORT_SQL = LABEL_ROLLUP_SQL.replace("WITH ", "WITH " + L.EVAL_SET_SQL.strip() + ",", 1)


@query(
    "c11_metric_rollups",
    REPORT_SQL + """SELECT system, state, count(*) AS n_labels, sum(iou_count)::BIGINT AS n_features, round(sum(iou_median), 6) AS iou_median_sum
      FROM by_label JOIN eval_set USING (id) GROUP BY ALL""",
)
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = report.label_rollup(written_metrics(spark, sf_dir), L.eval_set(spark, sf_dir))
    return rolled.groupBy("system", "state").agg(
        F.count("*").alias("n_labels"),
        F.sum("iou_count").alias("n_features"),
        F.round(F.sum("iou_median"), 6).alias("iou_median_sum"),
    )


@query(
    "c11_performer_report",
    LABEL_ROLLUP_SQL + """SELECT system, 'polygon' AS feature_type, round(avg(iou_median), 6) AS iou_median_mean, round(median(candidate_ratio_median), 6) AS candidate_ratio_median_median,
      round(median(inf_grnd_ratio_median), 6) AS inf_grnd_ratio_median_median FROM by_map GROUP BY system""",
)
def c11_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written_metrics(spark, sf_dir).withColumn("feature_type", F.lit("polygon"))
    out = report.report(rows, L.eval_set(spark, sf_dir), by=["feature_type"])["performer"]
    cols = ["iou_median_mean", "candidate_ratio_median_median", "inf_grnd_ratio_median_median"]
    return out.select("system", "feature_type", *[F.round(c, 6).alias(c) for c in cols])
