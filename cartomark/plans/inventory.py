"""Inventory of expected against present files, and its updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartomark.functions.text import example_pattern
from cartomark.operators.balance import first_per_key


def id_directories(ids: DataFrame, files: DataFrame, id_col: str = "id") -> DataFrame:
    """Directories whose first text shaped like an id is exactly that id.

    Every distinct directory emits its substrings of the lengths ids have; they
    meet the ids by equality, and the shape test runs on those hits only.
    """
    wanted = ids.select(F.col(id_col).alias("id")).distinct()
    lengths = wanted.agg(F.array_sort(F.collect_set(F.length("id"))).alias("n")).scalar()
    directories = files.select("directory").distinct()
    tokens = directories.withColumn("_n", F.explode(lengths)).where("_n <= length(directory)")
    tokens = tokens.select(
        "directory",
        F.explode(
            F.expr(
                "array_distinct(transform(sequence(1, length(directory) - _n + 1),"
                " i -> substring(directory, i, _n)))"
            )
        ).alias("id"),
    )
    shaped = wanted.withColumn("_pattern", example_pattern(F.col("id")))
    return (
        tokens.join(shaped, "id")
        .where(F.expr("regexp_extract(directory, _pattern, 0) = id"))
        .select("id", "directory")
    )


def files_of_ids(ids: DataFrame, files: DataFrame, id_col: str = "id") -> DataFrame:
    """Files in the directories of each id."""
    return id_directories(ids, files, id_col).join(files, "directory")


def inventory_ids(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Per expected id: whether a directory and a wanted file exist, and its state.

    ``found`` holds ``id`` and ``has_file`` per file. ``missing`` means the
    directory lacks the file, ``different`` that no directory was found.
    """
    seen = found.groupBy("id").agg(F.bool_or("has_file").alias("_has"))
    rows = expected.join(seen, "id", "left")
    return rows.select(
        *expected.columns,
        F.col("_has").isNotNull().alias("in_dir"),
        F.coalesce("_has", F.lit(False)).alias("has_file"),
        F.when(F.col("_has").isNull(), "different")
        .when(~F.col("_has"), "missing")
        .otherwise("present")
        .alias("state"),
    )


def inventory_features(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Feature-extraction inventory: rasters, vector files and value matches per id.

    ``files`` holds ``id`` and ``file_ext`` for every file found for an id.
    """
    seen = files.groupBy("id").agg(
        F.bool_or(F.col("file_ext") == ".tif").alias("_tif"),
        F.bool_or(F.col("file_ext") == ".shp").alias("_shp"),
        F.bool_or(F.col("file_ext") == ".feather").alias("_match"),
    )
    no = F.lit(False)
    return expected.join(seen, "id", "left").select(
        "id",
        F.col("_tif").isNotNull().alias("in_dir_t"),
        F.col("_shp").isNotNull().alias("in_dir_s"),
        F.coalesce("_tif", no).alias("has_tif"),
        F.coalesce("_shp", no).alias("has_shp"),
        F.coalesce("_match", no).alias("value_match"),
        F.lit("Feature Extraction").alias("process_type"),
        "source",
    )


def inventory_georeferencing(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Georeferencing inventory: directory and raster per id."""
    seen = files.groupBy("id").agg(F.bool_or(F.col("file_ext") == ".tif").alias("_tif"))
    return expected.join(seen, "id", "left").select(
        "id",
        F.col("_tif").isNotNull().alias("in_dir"),
        F.coalesce("_tif", F.lit(False)).alias("has_tif"),
        F.lit("Georeferencing").alias("process_type"),
        "source",
    )


def inspect_maps(files: DataFrame, ext: str = ".tif") -> DataFrame:
    """Distinct raster names per id."""
    rasters = files.where(F.col("file_ext") == ext).select("id", "filename").distinct()
    return rasters.groupBy("id").agg(F.count("*").alias("n_files"))


def missing_maps(inspected: DataFrame, expected_ids: int = 140) -> DataFrame:
    """Found and missing numbers of maps against the expected count."""
    return inspected.agg(F.count("*").alias("found")).select(
        "found", (F.lit(expected_ids).cast("bigint") - F.col("found")).alias("total_missing")
    )


def update_inventory(inventory: DataFrame, arrivals: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Set the flags of newly arrived ids; all other values stay."""
    arrived = arrivals.select("id").distinct().withColumn("_new", F.lit(True))
    joined = inventory.join(arrived, "id", "left")
    return joined.withColumns({c: F.coalesce("_new", F.col(c)) for c in flags}).drop("_new")


def one_raster_per_id(files: DataFrame) -> DataFrame:
    """Smallest raster file of each id, by bytes then path."""
    return first_per_key(
        files.where("has_file"), ["id"], [F.asc("size"), F.asc("path")]
    ).select("id", "path")


def eval_subset(eval_set: DataFrame, purpose: str) -> DataFrame:
    """Evaluation rows of one purpose, as ``id``, ``cog_id`` and ``source``.

    ``purpose`` is ``Georeferencing``, or ``Feature Extraction`` (maps only).
    """
    rows = eval_set.where(F.col(purpose) == "Yes")
    if purpose == "Feature Extraction":
        rows = rows.where(F.col("Source") == "Map")
    return rows.select(
        F.col("ID").alias("id"), F.col("COG ID").alias("cog_id"), F.col("Source").alias("source")
    ).dropDuplicates(["id", "cog_id"])
