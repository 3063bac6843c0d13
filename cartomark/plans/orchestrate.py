"""Which performer files can be scored, against which labels, and at what cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.plans.prepare import FILE_KEYS


def evaluable_files(schema: DataFrame) -> DataFrame:
    return schema.where("message = 'success-done' and data = 'extracted data'")


def label_orchestration(schema: DataFrame, labels: DataFrame, synopsis: DataFrame) -> DataFrame:
    """Labels both sides have, per performer file, with count ratio and work estimate.

    ``labels``: id, geo_value, count; ``synopsis``: file keys, geo_value, count.
    """
    files = evaluable_files(schema).select(*FILE_KEYS).distinct()
    grnd = labels.select("id", "geo_value", F.col("count").alias("count_grnd"))
    inf = synopsis.select(
        *FILE_KEYS, *[c for c in ("abbreviation",) if c in synopsis.columns],
        "geo_value", F.col("count").alias("count_inf"),
    )
    return (
        inf.join(files, FILE_KEYS, "left_semi")
        .join(grnd, ["id", "geo_value"])
        .withColumn("ratio", F.col("count_inf") / F.col("count_grnd"))
        .withColumn("combinations", F.col("count_grnd") * F.col("count_inf"))
    )


def file_orchestration(schema: DataFrame, labels: DataFrame, synopsis: DataFrame) -> DataFrame:
    """Missing labels and the evaluation route of each performer file.

    A file without synopsis rows is invalid and counts as 100 percent missing.
    """
    files = evaluable_files(schema).select(*FILE_KEYS).distinct()
    files = files.join(labels.select("id").distinct(), "id", "left_semi")
    valid = synopsis.groupBy(*FILE_KEYS).agg(F.lit(True).alias("valid_synops"))
    predicted = synopsis.select(*FILE_KEYS, "geo_value", F.lit(True).alias("_hit")).distinct()
    expected = files.join(labels.select("id", "geo_value").distinct(), "id")
    stats = (
        expected.join(predicted, [*FILE_KEYS, "geo_value"], "left")
        .groupBy(*FILE_KEYS)
        .agg(
            F.count("*").alias("_total"),
            F.count_if(F.col("_hit").isNull()).alias("num_missing"),
            F.array_sort(F.collect_set(F.when(F.col("_hit").isNull(), F.col("geo_value")))).alias(
                "missing_val"
            ),
        )
        .withColumn("size_df", F.col("_total") - F.col("num_missing"))
    )
    rows = stats.join(valid, FILE_KEYS, "left").withColumn(
        "valid_synops", F.coalesce("valid_synops", F.lit(False))
    )
    ok = F.col("valid_synops")
    rows = rows.select(
        *FILE_KEYS,
        "valid_synops",
        F.when(ok, F.col("missing_val")).alias("missing_val"),
        F.when(ok, F.col("num_missing")).alias("num_missing"),
        F.when(ok, F.round(F.col("num_missing") / F.col("_total"), 3) * 100)
        .otherwise(F.lit(100.0))
        .alias("perc_missing"),
        "size_df",
    )
    return rows.withColumn("route", evaluation_route())


def evaluation_route() -> Column:
    """``direct``, ``crude`` (all labels missing) or ``invalid``."""
    ok = F.coalesce("valid_synops", F.lit(False))
    return (
        F.when(ok & (F.col("perc_missing") < 100) & (F.col("size_df") > 0), "direct")
        .when(ok & (F.col("perc_missing") == 100), "crude")
        .otherwise("invalid")
    )


def crude_orchestration(files: DataFrame, truth_kinds: DataFrame, performer_counts: DataFrame) -> DataFrame:
    """Files routed to crude matching, against truth of the same geometry kind.

    ``files``: file keys and route; ``truth_kinds``: id, shp_file, geom_type, count;
    ``performer_counts``: file keys, count.
    """
    crude = files.where("route = 'crude'").select(*FILE_KEYS)
    inf = performer_counts.select(*FILE_KEYS, F.col("count").alias("count_inf"))
    grnd = truth_kinds.select(
        "id", "shp_file", F.col("geom_type").alias("feature_type"), F.col("count").alias("count_grnd")
    )
    return (
        crude.join(inf, FILE_KEYS)
        .join(grnd, ["id", "feature_type"])
        .withColumn("combinations", F.col("count_grnd") * F.col("count_inf"))
    )
