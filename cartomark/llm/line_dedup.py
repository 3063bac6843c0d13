"""Line de-duplication across documents, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartomark.llm.common import SPACE, ascii_lower

#: Copies of each over-frequent key on the small side of the join, so that a line
#: found in a third of all documents is dealt to as many tasks.
SALTS = 16


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """Drop lines that many documents share, keeping them in one document.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased.
    Keys of ``min_chars`` code points or more, found in ``min_docs`` distinct
    documents or more, lose all lines but those of the largest id holding them.

    Returns every input column with ``text_col`` replaced by the kept lines, plus
    ``n_lines`` (before) and ``n_dropped``; input columns of those two names are
    replaced. A null or empty text is one empty line. Rows without an id stand
    for no document: they are not counted and keep all lines. Rows repeating an
    id count as one document, and each keeps its own lines. An empty table gives
    an empty table.
    """
    lines = F.split(F.coalesce(F.col("_text"), F.lit("")), "\n", -1)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{text_col}`").alias("_text"),
    )

    stripped = F.transform(lines, lambda x, i: F.struct(i.alias("pos"), F.btrim(x, F.lit(SPACE)).alias("key")))
    long_lines = F.filter(stripped, lambda x: F.length(x["key"]) >= min_chars)
    located = (
        rows.where("_id is not null")
        .select("_id", F.xxhash64("_text").alias("_version"), F.explode(long_lines).alias("_line"))
        .select(
            "_id",
            "_version",
            F.col("_line.pos").alias("_pos"),
            F.unhex(F.md5(ascii_lower(F.col("_line.key")))).alias("_hash"),
        )
    )

    # One row per (key, document) first: it counts distinct documents exactly and
    # leaves no key's rows to a single task before they are combined.
    frequent = (
        located.select("_hash", "_id")
        .distinct()
        .groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keeper"))
        .where(F.col("_docs") >= min_docs)
        .select("_hash", "_keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    dropped = (
        located.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))
        .join(frequent, ["_hash", "_salt"])
        .where("_id <> _keeper")
        .groupBy("_id", "_version")
        .agg(F.collect_set("_pos").alias("_drop"))
    )

    n_lines = F.size(lines)
    gone = F.coalesce(F.col("_drop"), F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), gone)
    text = F.when(F.col("_drop").isNull(), F.coalesce(F.col("_text"), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    return (
        rows.withColumn("_version", F.xxhash64("_text"))
        .join(dropped, ["_id", "_version"], "left")
        .select("_row", text.alias("_kept"), n_lines.cast("long").alias("_n"), F.size(gone).cast("long").alias("_gone"))
        .select("_row.*", "_kept", "_n", "_gone")
        .withColumns({text_col: F.col("_kept"), "n_lines": F.col("_n"), "n_dropped": F.col("_gone")})
        .drop("_kept", "_n", "_gone")
    )
