"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on; a cluster's own values win over these.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cartomark")
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.cartomark.localFolder", None
    )
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="cartomark-")
    spark.conf.set("spark.cartomark.localFolder", folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """The folder below :func:`shared_folder` that holds this application's tables."""
    return f"{shared_folder(spark)}/cartomark-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the run's folder and read it back.

    Used where several branches read one costly result: the written table keeps
    column pruning and size statistics, and survives lost executors. ``options`` go to the writer.
    """
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_intermediates(spark: SparkSession) -> bool:
    """Delete all tables this application has materialised; call once results are stored."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(folder, True)
