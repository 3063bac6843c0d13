"""Sinks: tables, partitioned geometry tables, CSV reports and id maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("id", "geo_value"),
    mode: str = "overwrite",
    max_rows: int = 5_000_000,
) -> None:
    """Partitioned zstd parquet with one or a few files per partition value.

    The rebalance hint gathers small partition values and splits a hot one over
    several tasks, so neither tiny files nor one giant writer appear.
    """
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_rows)
        .partitionBy(*by)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def write_id_map(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``(id, cog_id)`` as one JSON object per line."""
    pair = F.to_json(F.create_map(F.col("id"), F.col("cog_id")))
    df.select(pair.alias("value")).write.mode(mode).text(path)
