"""Check queries for spatial candidates, scoring and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.plans import evaluate, report
from cartomark.session import materialize
from cartomark.workload import logical as L
from cartomark.workload.registry import query

SCORED = L.with_sql(L.BOXES_SQL, L.PAIRS_SQL, L.METRICS_SQL)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluate_boxes(
        L.performers(spark, sf_dir), L.truths(spark, sf_dir), L.CELL, L.PIXEL
    )


def written_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match metrics as a written table, for roll-ups that read them several times."""
    return materialize(metrics(spark, sf_dir), "match-metrics")


@query(
    "c10_feature_evaluation",
    SCORED + """
SELECT id, geo_value, system, p_fid, g_fid, iou_units, iou, num_cand_perf, num_cand_geom, inf_count,
       grnd_count, true_positives, len_pdf, len_gdf, "precision", recall, f1, f1_message
FROM metrics""",
)
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).drop("system_version", "geo_value_query")


@query(
    "flagship_iou_by_map_and_performer",
    SCORED + """
SELECT id, system, count(*) AS n_matched, sum(iou_units)::BIGINT / count(*) / 1000.0::DOUBLE AS iou_mean,
       round(median(iou), 6) AS iou_median
FROM metrics GROUP BY id, system""",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(spark, sf_dir).groupBy("id", "system").agg(
        F.count("*").alias("n_matched"),
        report.mean_iou().alias("iou_mean"),
        F.round(F.median("iou"), 6).alias("iou_median"),
    )
