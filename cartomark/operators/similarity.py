"""Similarity joins over distinct strings.

A ratio above a threshold bounds how many characters two strings may differ in,
so candidates come from an equi-join on shared substrings; strings that cannot
reach the threshold never meet.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.functions.text import levenshtein_ratio, sequence_ratio, tokens
from cartomark.operators.balance import first_per_key


def max_edits(total: Column, threshold: float, method: str) -> Column:
    """Most insertions and deletions two strings of ``total`` joint length allow.

    ``ratio > t`` leaves fewer than ``(1 - t) * total`` unmatched characters. For
    levenshtein, distance < (1 - t) * longer <= (1 - t) * total also bounds it.
    """
    return F.greatest(
        F.ceil(total * F.lit(1.0 - threshold) + F.lit(1e-9)).cast("int") - 1, F.lit(0)
    )


def similar_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    threshold: float,
    *,
    method: str = "sequence",
    left_text: str = "value",
    right_text: str = "candidate",
) -> DataFrame:
    """Distinct pairs of equal ``keys`` whose ratio exceeds the threshold.

    With at most ``d`` edits, cutting the left string into ``d + 1`` pieces leaves
    one piece unharmed in the right string, shifted by at most ``d``. Each side
    emits its pieces per possible length of the other, and the join runs on
    (keys, lengths, piece number, piece). The exact ratio is taken last, once
    per distinct pair.
    """
    group = list(keys)
    lefts = left.select(*group, F.col(left_text).alias("_a")).where("_a is not null").distinct()
    rights = right.select(*group, F.col(right_text).alias("_b")).where("_b is not null").distinct()

    def lengths(n: Column) -> Column:
        # 2*min(m, n)/(m + n) > t  <=>  n*t/(2 - t) < m < n*(2 - t)/t
        low = F.floor(n * F.lit(threshold / (2 - threshold))).cast("int")
        high = F.ceil(n * F.lit((2 - threshold) / threshold)).cast("int")
        if method == "levenshtein":
            low = F.floor(n * F.lit(threshold)).cast("int")
            high = F.ceil(n / F.lit(threshold)).cast("int")
        return F.sequence(F.greatest(low, F.lit(0)), F.greatest(high, low, F.lit(0)))

    # Exact lengths present per group keep the fan-out to lengths that occur.
    a_lengths = lefts.select(*group, F.length("_a").alias("_la")).distinct()
    b_lengths = rights.select(*group, F.length("_b").alias("_lb")).distinct()
    if not group:
        a_lengths = a_lengths.withColumn("_all", F.lit(1))
        b_lengths = b_lengths.withColumn("_all", F.lit(1))
        lefts = lefts.withColumn("_all", F.lit(1))
        rights = rights.withColumn("_all", F.lit(1))
        group = ["_all"]
    met = (
        a_lengths.withColumn("_lb", F.explode(lengths(F.col("_la"))))
        .join(b_lengths, [*group, "_lb"])
        .withColumn("_d", max_edits(F.col("_la") + F.col("_lb"), threshold, method))
    )

    def piece_start(i: Column, pieces: Column) -> Column:
        return F.floor(F.col("_la") * i / pieces).cast("int")

    pieces = F.col("_d") + 1
    index = F.explode(F.sequence(F.lit(0), F.col("_d"))).alias("_i")
    a_side = (
        lefts.withColumn("_la", F.length("_a"))
        .join(met, [*group, "_la"])
        .select(*group, "_a", "_la", "_lb", "_d", index)
        .withColumn("_s", piece_start(F.col("_i"), pieces))
        .withColumn("_e", piece_start(F.col("_i") + 1, pieces))
        .select(
            *group, "_a", "_la", "_lb", "_d", "_i", F.expr("substring(_a, _s + 1, _e - _s)").alias("_piece")
        )
    )
    b_side = (
        rights.withColumn("_lb", F.length("_b"))
        .join(met, [*group, "_lb"])
        .select(*group, "_b", "_la", "_lb", "_d", index)
        .withColumn("_s", piece_start(F.col("_i"), pieces))
        .withColumn("_n", piece_start(F.col("_i") + 1, pieces) - F.col("_s"))
        .withColumn("_from", F.greatest(F.col("_s") - F.col("_d"), F.lit(0)))
        .withColumn("_to", F.least(F.col("_s") + F.col("_d"), F.col("_lb") - F.col("_n")))
        .where("_from <= _to")
        .select(
            *group,
            "_b",
            "_la",
            "_lb",
            "_i",
            F.explode(
                F.expr("array_distinct(transform(sequence(_from, _to), o -> substring(_b, o + 1, _n)))")
            ).alias("_piece"),
        )
    )
    # The edit distance never exceeds the edits allowed; testing it inside the
    # join drops chance meetings before anything is shuffled.
    candidates = (
        a_side.join(b_side, [*group, "_la", "_lb", "_i", "_piece"])
        .where(F.levenshtein("_a", "_b") <= F.col("_d"))
        .select(*group, "_a", "_b")
        .distinct()
    )
    ratio = sequence_ratio if method == "sequence" else levenshtein_ratio
    out = candidates.withColumn("ratio", ratio(F.col("_a"), F.col("_b"))).where(
        F.col("ratio") > threshold
    )
    return out.select(*keys, F.col("_a").alias(left_text), F.col("_b").alias(right_text), "ratio")


def best_matches(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    threshold: float,
    *,
    method: str = "sequence",
    left_text: str = "value",
    right_text: str = "candidate",
) -> DataFrame:
    """Best candidate per distinct value among those above the threshold.

    Ties go to the alphabetically first candidate.
    """
    pairs = similar_pairs(
        left, right, keys, threshold, method=method, left_text=left_text, right_text=right_text
    )
    return first_per_key(
        pairs, [*keys, left_text], [F.desc("ratio"), F.asc(right_text)]
    )


def tfidf_cosine(
    pairs: DataFrame, texts: DataFrame, a: str = "a_id", b: str = "b_id", key: str = "id", text: str = "text"
) -> DataFrame:
    """TF-IDF cosine of each pair, the two texts being the whole corpus.

    With two documents a shared word weighs ``tf`` and any other
    ``tf * (ln(3/2) + 1)``, so the norms follow from per-text totals and the sums
    over shared words; only shared words are joined.
    """
    rare = math.log(3 / 2) + 1
    counts = (
        texts.select(key, F.explode(tokens(F.col(text))).alias("_t"))
        .groupBy(key, "_t")
        .agg(F.count("*").alias("_tf"))
    )
    totals = counts.groupBy(key).agg(F.sum(F.col("_tf") * F.col("_tf")).alias("_sq"))

    def renamed(df: DataFrame, new: str, suffix: str) -> DataFrame:
        return df.select(
            F.col(key).alias(new), *[F.col(c).alias(c + suffix) for c in df.columns if c not in (key, "_t")],
            *(["_t"] if "_t" in df.columns else []),
        )

    shared = (
        pairs.select(a, b)
        .distinct()
        .join(renamed(counts, a, "_a"), a)
        .join(renamed(counts, b, "_b"), [b, "_t"])
        .groupBy(a, b)
        .agg(
            F.sum(F.col("_tf_a") * F.col("_tf_b")).alias("_dot"),
            F.sum(F.col("_tf_a") * F.col("_tf_a")).alias("_ca"),
            F.sum(F.col("_tf_b") * F.col("_tf_b")).alias("_cb"),
        )
    )

    def norm(total: str, common: str) -> Column:
        c = F.coalesce(common, F.lit(0))
        return F.sqrt((F.col(total) - c) * F.lit(rare * rare) + c)

    scored = (
        pairs.join(shared, [a, b], "left")
        .join(renamed(totals, a, "_a"), a, "left")
        .join(renamed(totals, b, "_b"), b, "left")
    )
    cosine = F.try_divide(
        F.coalesce("_dot", F.lit(0)).cast("double"), norm("_sq_a", "_ca") * norm("_sq_b", "_cb")
    )
    return scored.withColumn("cosine", F.coalesce(cosine, F.lit(0.0))).drop(
        "_dot", "_ca", "_cb", "_sq_a", "_sq_b"
    )
