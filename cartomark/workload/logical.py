"""The given tables read as map-evaluation tables, in Spark and as SQL text.

Line items become labelled boxes on maps (suppliers), split into the
predictions of two performer systems and the ground truth; events become points;
the same definitions exist as SQL so that each side can be checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.functions import geometry as G

#: Base cell and coarse levels above it, and pixel size, in map units.
CELL = 200
COARSE_LEVELS = 2
PIXEL = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_role(lines: DataFrame, roles: int) -> DataFrame:
    """Line items with their number folded to 1..roles, so that every row has a role."""
    return lines.withColumn("l_linenumber", ((F.col("l_linenumber") - 1) % roles + 1).cast("int"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled boxes with whole-number corners; ``line`` is one of three roles."""
    x0 = F.floor(F.col("l_quantity") * 100).cast("bigint")
    y0 = F.floor(F.col("l_extendedprice") / 20).cast("bigint")
    wide = F.round(F.col("l_discount") * 100).cast("bigint")
    high = F.round(F.col("l_tax") * 100).cast("bigint")

    def cents(c: str):
        return F.round(F.col(c) * 100).cast("bigint")

    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cents("l_quantity"), cents("l_extendedprice")]
    lines = table(spark, sf_dir, "lineitem").withColumn("fid", F.concat_ws("-", *key))
    return by_role(lines, 3).select(
        "fid",
        F.col("l_suppkey").alias("id"),
        F.col("l_returnflag").alias("geo_value"),
        F.col("l_linenumber").alias("line"),
        x0.alias("x0"),
        y0.alias("y0"),
        (x0 + 100 + wide * 20).alias("x1"),
        (y0 + 100 + high * 20).alias("y1"),
    )


def with_bbox(df: DataFrame) -> DataFrame:
    b = G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return df.withColumn("bbox", b)


def performers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted boxes of two systems."""
    rows = boxes(spark, sf_dir).where("line in (1, 3)")
    return with_bbox(rows).select(
        "*",
        F.concat(F.lit("sys_"), F.col("line").cast("string")).alias("system"),
        F.lit("1.0").alias("system_version"),
    )


def truths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_bbox(boxes(spark, sf_dir).where("line = 2"))


def eval_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per map with its scale, state and source."""
    scale = (
        F.when(F.col("s_nationkey") % 4 == 0, 24000)
        .when(F.col("s_nationkey") % 4 == 1, 62500)
        .when(F.col("s_nationkey") % 4 == 2, 100000)
        .otherwise(250000)
        .cast("bigint")
    )
    maps = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return maps.select(
        F.col("s_suppkey").alias("id"),
        scale.alias("scale"),
        F.col("n_name").alias("state"),
        F.when(F.col("s_suppkey") % 2 == 0, "Map").otherwise("Topo").alias("source"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labelled points in two roles."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("fid"),
        F.col("event_type").alias("geo_value"),
        F.col("value").alias("x"),
        F.col("user_id").cast("double").alias("y"),
        (F.col("event_id") % 2 == 0).alias("is_truth"),
    )


def gcps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground control points per map and line item system."""
    col = F.col("l_quantity")
    row = F.col("l_discount") * 100
    return by_role(table(spark, sf_dir, "lineitem"), 3).select(
        F.col("l_suppkey").alias("cog_id"),
        F.concat(F.lit("sys_"), F.col("l_linenumber").cast("string")).alias("system"),
        F.lit("1.0").alias("system_version"),
        row.alias("row"),
        col.alias("col"),
        (F.lit(-110.0) + col * 0.01 + row * 0.002 + F.col("l_tax") * 0.01).alias("lon"),
        (F.lit(35.0) - row * 0.01 + col * 0.001 + F.col("l_tax") * 0.02).alias("lat"),
    )


# --- the same as SQL -----------------------------------------------------------------

BOXES_SQL = """
boxes AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_quantity * 100) AS BIGINT),
                   CAST(round(l_extendedprice * 100) AS BIGINT)) AS fid, l_suppkey AS id,
         l_returnflag AS geo_value, CAST((l_linenumber - 1) % 3 + 1 AS INTEGER) AS line, x0, y0,
         x0 + 100 + 20 * CAST(round(l_discount * 100) AS BIGINT) AS x1,
         y0 + 100 + 20 * CAST(round(l_tax * 100) AS BIGINT) AS y1
  FROM (SELECT *, CAST(floor(l_quantity * 100) AS BIGINT) AS x0,
               CAST(floor(l_extendedprice / 20) AS BIGINT) AS y0 FROM lineitem)
),
perf AS (SELECT *, 'sys_' || line AS system, '1.0' AS system_version FROM boxes WHERE line IN (1, 3)),
truth AS (SELECT * FROM boxes WHERE line = 2)
"""

EVAL_SET_SQL = """
eval_set AS (
  SELECT s_suppkey AS id,
         CAST(CASE s_nationkey % 4 WHEN 0 THEN 24000 WHEN 1 THEN 62500 WHEN 2 THEN 100000
              ELSE 250000 END AS BIGINT) AS scale,
         n_name AS state, CASE WHEN s_suppkey % 2 = 0 THEN 'Map' ELSE 'Topo' END AS source
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)
"""

#: Pairs of equal map and label whose fine cells meet, with exact IoU and pixel counts.
PAIRS_SQL = f"""
cand AS (
  SELECT p.id, p.geo_value, p.system, p.system_version, p.fid AS p_fid, g.fid AS g_fid,
         p.x0 AS px0, p.y0 AS py0, p.x1 AS px1, p.y1 AS py1,
         g.x0 AS gx0, g.y0 AS gy0, g.x1 AS gx1, g.y1 AS gy1,
         p.x0 <= g.x1 AND g.x0 <= p.x1 AND p.y0 <= g.y1 AND g.y0 <= p.y1 AS hit,
         greatest(least(p.x1, g.x1) - greatest(p.x0, g.x0), 0)
           * greatest(least(p.y1, g.y1) - greatest(p.y0, g.y0), 0) AS inter
  FROM perf p JOIN truth g ON p.id = g.id AND p.geo_value = g.geo_value
   AND p.x0 // {CELL} <= g.x1 // {CELL} AND g.x0 // {CELL} <= p.x1 // {CELL}
   AND p.y0 // {CELL} <= g.y1 // {CELL} AND g.y0 // {CELL} <= p.y1 // {CELL}
),
pairs AS (
  SELECT *, CASE WHEN hit THEN (2 * inter * 100000 + uni) // (2 * uni) ELSE 0 END AS iou_units,
    greatest(least(px1 // {PIXEL}, gx1 // {PIXEL}) - greatest(px0 // {PIXEL}, gx0 // {PIXEL}) + 1, 0)
      * greatest(least(py1 // {PIXEL}, gy1 // {PIXEL}) - greatest(py0 // {PIXEL}, gy0 // {PIXEL}) + 1, 0) AS tp,
    (px1 // {PIXEL} - px0 // {PIXEL} + 1) * (py1 // {PIXEL} - py0 // {PIXEL} + 1) AS len_pdf,
    (gx1 // {PIXEL} - gx0 // {PIXEL} + 1) * (gy1 // {PIXEL} - gy0 // {PIXEL} + 1) AS len_gdf
  FROM (SELECT *, (px1 - px0) * (py1 - py0) + (gx1 - gx0) * (gy1 - gy0) - inter AS uni FROM cand)
)
"""

#: Match metrics: best truth box per predicted box.
METRICS_SQL = """
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY id, geo_value, system, p_fid) AS num_cand_geom,
    row_number() OVER (PARTITION BY id, geo_value, system, p_fid
      ORDER BY hit DESC, iou_units DESC, CASE WHEN tp > 0 THEN CAST(2 * tp AS DOUBLE) / (len_pdf + len_gdf) ELSE 0 END DESC, g_fid) AS rn
  FROM pairs
),
per_label AS (
  SELECT id, geo_value, system, count(DISTINCT p_fid) AS num_cand_perf FROM pairs GROUP BY ALL
),
inf AS (SELECT id, geo_value, system, count(*) AS inf_count FROM perf GROUP BY ALL),
grnd AS (SELECT id, geo_value, count(*) AS grnd_count FROM truth GROUP BY ALL),
metrics AS (
  SELECT r.id, r.geo_value, r.system, r.system_version, p_fid, g_fid, iou_units,
    iou_units / 1000.0::DOUBLE AS iou, num_cand_perf, num_cand_geom, inf_count, grnd_count,
    tp AS true_positives, len_pdf, len_gdf,
    CAST(tp AS DOUBLE) / len_pdf AS "precision", CAST(tp AS DOUBLE) / len_gdf AS recall,
    CASE WHEN tp > 0 THEN CAST(2 * tp AS DOUBLE) / (len_pdf + len_gdf) ELSE 0.0 END AS f1,
    CASE WHEN tp = 0 THEN 'no-overlap' ELSE 'success-f1' END AS f1_message
  FROM ranked r JOIN per_label USING (id, geo_value, system) JOIN inf USING (id, geo_value, system)
  JOIN grnd USING (id, geo_value) WHERE rn = 1 AND hit
)
"""

GCPS_SQL = """
gcps AS (
  SELECT l_suppkey AS cog_id, 'sys_' || l_linenumber AS system, '1.0' AS system_version,
         l_discount * 100 AS "row", l_quantity AS col,
         -110.0::DOUBLE + l_quantity * 0.01::DOUBLE + l_discount * 100 * 0.002::DOUBLE + l_tax * 0.01::DOUBLE AS lon,
         35.0::DOUBLE - l_discount * 100 * 0.01::DOUBLE + l_quantity * 0.001::DOUBLE + l_tax * 0.02::DOUBLE AS lat
  FROM (SELECT * REPLACE (CAST((l_linenumber - 1) % 3 + 1 AS INTEGER) AS l_linenumber) FROM lineitem) WHERE true
)
"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts)
