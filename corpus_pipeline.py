"""The corpus pipeline: five stages that turn ``documents`` into packed sequences.

Every stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept
and returns the columns of ``documents``; the last returns placed token pieces.
Rows without an id are scored, cleaned and packed, but neither grouped with
others nor reported as leaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.llm import decontamination, line_dedup, packing, similar_texts, toxicity
from cartomark.llm.common import byte_bpe, table
from cartomark.session import materialize


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and the whole row, safe from result columns of the same name."""
    return docs.select("doc_id", "text", F.struct("*").alias("_carried"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon does not reject."""
    scored = toxicity.classify(carried(docs), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select("_carried.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(carried(docs))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*[new.get(c, F.col(f"_carried.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies.

    Near copies share five-word shingles to 0.8 or more (exact Jaccard). Rows are
    decided one by one, by their own text: each component keeps one row, so an id
    with several texts may stay several times. Of rows with one id and one text,
    but for case and spaces, the least text stays, and any one row of equal ones.
    """
    noded = similar_texts.with_node(docs)
    stays = similar_texts.similar_nodes(noded).groupBy("component").agg(F.min(F.struct(F.col("leader").alias("doc_id"), F.col("node").alias("_node"))).alias("stay")).select("stay.*")
    kept = noded.join(stays, ["doc_id", "_node"], "left_semi").groupBy("doc_id", "_node")
    one = kept.agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.struct("text")).alias("row")).select("row.*")
    return one.unionByName(docs.where("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or re-parameterised."""
    leaks = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    # A written table has a known size: only if it is small is it broadcast.
    return docs.join(materialize(leaks, "leaks"), "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents, placed in sequences."""
    return packing.pack(packing.tokenize_pieces(docs, **byte_bpe()))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot express the learned lexicon, SimHash components or best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
