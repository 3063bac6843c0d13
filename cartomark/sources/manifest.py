"""Ingest status of expected performer results, derived from what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["cog_id", "system", "system_version", "feature_type"]


def ingest_status(expected: DataFrame, landed_pages: DataFrame) -> DataFrame:
    """One row per expected result: file, code and message.

    ``landed_pages`` has the keys plus ``output_file``, ``page``, ``response_code``
    and ``n_records``. A download is done once a page with code 200 and no
    records ends it, failed on any other code, and still running without either.
    """
    pages = landed_pages.groupBy(*KEYS).agg(
        F.sum("n_records").alias("n_records"),
        F.max("output_file").alias("_file"),
        F.max("response_code").alias("response_code"),
        F.bool_or(F.col("response_code") != 200).alias("_failed"),
        F.bool_or((F.col("response_code") == 200) & (F.col("n_records") == 0)).alias("_ended"),
    )
    message = (
        F.when(F.col("_failed").isNull(), "empty")
        .when(F.col("_failed"), "failed")
        .when(F.col("_ended"), "success-done")
        .otherwise("success")
    )
    return expected.join(pages, KEYS, "left").select(
        *KEYS,
        F.when(F.col("n_records") > 0, F.col("_file")).alias("output_file"),
        "response_code",
        F.coalesce("n_records", F.lit(0).cast("bigint")).alias("n_records"),
        message.alias("message"),
    )
