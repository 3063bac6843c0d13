"""Interaction audit of document filters by exact constrained least squares."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.llm.common import SPACE
from cartomark.session import materialize

#: The five quality filters, in the order of their bits.
FILTERS = "ABCDE"


@functools.cache
def normal_inverse(m: int) -> tuple[tuple[Fraction, ...], ...]:
    """Inverse of the normal equations of ``m`` filters, bordered by the efficiency constraint.

    Coalitions of s filters weigh ``(m - 1) / (C(m, s) * s * (m - s))``; the
    empty and the full coalition are met exactly: the one by having no constant,
    the other by the constraint that all shares add up to its value.
    """
    weight = [Fraction(0), *(Fraction(m - 1, math.comb(m, s) * s * (m - s)) for s in range(1, m)), Fraction(0)]
    size = m + 1
    rows = [[Fraction(int(m in (i, j) and i != j)) for j in range(size)] + [Fraction(int(i == j)) for j in range(size)] for i in range(size)]
    for coalition in range(1, (1 << m) - 1):
        inside = [i for i in range(m) if coalition >> i & 1]
        for i, j in itertools.product(inside, inside):
            rows[i][j] += weight[len(inside)]
    for c in range(size):
        pivot = next(r for r in range(c, size) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(size):
            if r != c and rows[r][c]:
                factor = rows[r][c]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[c], strict=True)]
    return tuple(tuple(row[size:]) for row in rows)


def shapley(values: Sequence[int], m: int) -> list[Fraction]:
    """Shapley shares of ``m`` filters from the values of all ``2**m`` coalitions.

    They are the weighted least squares fit of the values by sums over members,
    constrained to give the full coalition exactly; solved in rationals.
    """
    right = [Fraction(0)] * m + [Fraction(values[-1])]
    for coalition in range(1, (1 << m) - 1):
        s = coalition.bit_count()
        share = Fraction(m - 1, math.comb(m, s) * s * (m - s)) * values[coalition]
        for i in range(m):
            if coalition >> i & 1:
                right[i] += share
    return [sum((x * y for x, y in zip(row, right, strict=True)), Fraction(0)) for row in normal_inverse(m)[:m]]


def audit(histogram: DataFrame, filters: str = FILTERS, losses: Sequence[str] = ("good", "toxic")) -> DataFrame:
    """Step counts of every order of ``filters`` and their Shapley shares, per part.

    ``histogram``: ``part, mask, n`` and one count column per loss, a row per part
    and mask (rows that repeat both are added up); bit i of ``mask`` says that the
    documents fail filter i. Returns ``part, filter_order, step, kept, removed,
    redundant, unique_fails``, ``<loss>_lost`` and ``shapley`` (times the number of
    orders, hence whole): all orders and steps, zeros included. An empty
    histogram gives no rows; a null mask counts as failing nothing.

    All a part needs is its table of 2**m coalitions, made from at most 2**m
    sums: parts of any size cost the same after the sums. A step's counts are
    differences of coalitions.
    """
    m = len(filters)
    full, orders = (1 << m) - 1, list(itertools.permutations(range(m)))
    counts = ["n", *losses]
    sums = histogram.groupBy("part", F.coalesce(F.col("mask"), F.lit(0)).alias("mask")).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c) for c in counts]
    )
    # Each step as (coalition before, filter).
    steps = [(sum(1 << f for f in order[:k]), order[k]) for order in orders for k in range(m)]
    before = np.array([s for s, _ in steps])
    of = np.array([f for _, f in steps])
    after = before | 1 << of
    meets = np.array([[int(mask & coalition != 0) for mask in range(full + 1)] for coalition in range(full + 1)])
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    schema += "".join(f"{loss}_lost long, " for loss in losses) + "shapley long"

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((full + 1, len(counts)), dtype=np.int64)
        table[part["mask"].to_numpy()] = part[counts].to_numpy()
        removed_by = meets @ table
        removed = removed_by[after, 0] - removed_by[before, 0]
        shares = [int(x * len(orders)) for x in shapley(removed_by[:, 0].tolist(), m)]
        return pd.DataFrame(
            {
                "part": part["part"].iloc[0],
                "filter_order": np.repeat(["".join(filters[f] for f in order) for order in orders], m),
                "step": np.tile(np.arange(1, m + 1, dtype=np.int32), len(orders)),
                "kept": table[:, 0].sum() - removed_by[after, 0],
                "removed": removed,
                "redundant": removed_by[1 << of, 0] - removed,
                "unique_fails": removed_by[full, 0] - removed_by[full & ~(1 << of), 0],
                **{f"{loss}_lost": removed_by[after, k] - removed_by[before, k] for k, loss in enumerate(losses, 1)},
                "shapley": np.array(shares, dtype=np.int64)[of],
            }
        )

    return sums.groupBy("part").applyInPandas(solve, schema)


def text_failures(text: Column, *, min_words: int = 200, distinct_percent: int = 50, capitals_percent: int = 2, symbols: str = "[#$%&*|]") -> Column:
    """Bits 0 to 3 of a text's mask: too few words, too few distinct ones, too many capitals, any of the symbols."""
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1)
    n = F.when(trimmed == "", 0).otherwise(F.size(words))
    distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        n < min_words,
        distinct.cast("long") * 100 < n.cast("long") * distinct_percent,
        capitals.cast("long") * 100 > F.length(text).cast("long") * capitals_percent,
        F.rlike(text, F.lit(symbols)),
    ]
    return functools.reduce(Column.bitwiseOR, [F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)])


def failure_histogram(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", **limits) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters A to E that they fail.

    A to D look at the text (:func:`text_failures`); E is set if a document with a
    smaller id anywhere in the table has the identical text. A null text is empty, a null
    part the empty string. ``good`` and ``toxic`` count documents of which any row
    of ``labels`` says ``quality = 1`` or ``toxic = 1``; labels without an id are
    ignored. Rows without an id count, have no label and are no one's copy.
    Rows repeating an id count one by one; a copy of the same id's own text is
    no smaller document. Other columns are ignored; an empty table gives no rows.

    Texts never leave the scan: rows of a 16-byte digest and the mask, combined
    before each exchange, meet the smallest id of their text on (digest, id), so
    a text held by a third of all documents is in no single task.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest"),
        text_failures(text, **limits).alias("mask"),
    )
    rows = materialize(rows.groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "failures")
    firsts = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    # Rows without an id have no partner in either join; the salt keeps them apart.
    salt = F.when(F.col("id").isNull(), F.xxhash64("digest", "part")).otherwise(F.lit(0)).alias("salt")
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"), F.lit(0).cast("long").alias("salt"))
    named = named.agg(F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    joined = rows.join(firsts, ["digest", "id"], "left").select("*", salt).join(named, ["id", "salt"], "left")

    def counted(flag: str) -> Column:
        return F.sum(F.col("n") * F.coalesce(F.col(flag), F.lit(0)))

    return joined.groupBy("part", F.col("mask").bitwiseOR(copy).alias("mask")).agg(
        F.sum("n").alias("n"), counted("is_good").alias("good"), counted("is_toxic").alias("toxic")
    )
