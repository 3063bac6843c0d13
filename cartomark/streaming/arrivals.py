"""Incremental file arrivals into the inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartomark.plans.inventory import update_inventory


def arrival_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Listing rows (id, path, file_ext, ...) that land as parquet files."""
    return spark.readStream.schema(schema).parquet(path)


def track_arrivals(
    arrivals: DataFrame, table_path: str, checkpoint: str, ext: str, available_now: bool = True
) -> StreamingQuery:
    """Append each batch's new paths to a table, one folder per batch.

    A batch that is run again after a failure overwrites its own folder, so a
    path is never counted twice by a restart.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        new = batch.where(F.col("file_ext") == ext).dropDuplicates(["path"])
        new.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")

    writer = arrivals.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def current_inventory(
    spark: SparkSession, inventory: DataFrame, table_path: str, schema: str, flags: Sequence[str]
) -> DataFrame:
    """The inventory with all tracked arrivals applied; equals the batch update."""
    tracked = spark.read.schema(f"{schema}, batch long").parquet(table_path)
    return update_inventory(inventory, tracked.dropDuplicates(["path"]), flags)
