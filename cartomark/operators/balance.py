"""Work-balanced joins and order statistics that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartomark.session import materialize


def salt_by_work(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    row_key: str,
    target_pairs: int = 10_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Split keys whose ``left x right`` work exceeds a target over several salts.

    Left rows take one salt by hash; right rows of such a key are repeated for
    each of its salts. Joining on ``[*keys, "salt"]`` gives the same pairs as
    joining on ``keys``, in near-equal pieces.
    """
    counts = left.groupBy(*keys).agg(F.count("*").alias("_nl")).join(
        right.groupBy(*keys).agg(F.count("*").alias("_nr")), list(keys)
    )
    heavy = (
        counts.withColumn("_pairs", F.col("_nl").cast("double") * F.col("_nr"))
        .where(F.col("_pairs") > target_pairs)
        .select(
            *keys,
            F.least(F.ceil(F.col("_pairs") / target_pairs), F.col("_nl")).cast("bigint").alias("_salts"),
        )
    )
    salts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    salted_left = (
        left.join(heavy, list(keys), "left")
        .withColumn("salt", F.pmod(F.xxhash64(row_key), salts))
        .drop("_salts")
    )
    salted_right = (
        right.join(heavy, list(keys), "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
        .drop("_salts")
    )
    return salted_left, salted_right


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in an order; the group limit runs before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "ref_index") -> DataFrame:
    """Number the rows of each key from 0 in an order that is unique within it.

    Rows are range-partitioned and numbered inside their part; each part starts
    where the key's earlier parts end. A key with very many rows thus spreads
    over many tasks.
    """
    placed = materialize(
        df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "row-index"
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy(*keys, "_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    return (
        placed.join(parts, [*keys, "_part"])
        .withColumn(out, F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_part", "_before")
    )


#: Buckets a doubling of the value is cut into, and a shift that makes exponents positive.
BUCKETS, SHIFT = 4096, 1100


def _value_bucket(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: exponent, then leading mantissa.

    A logarithm rounded to the wrong side of a power of two moves both parts and
    gives the same number.
    """
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    mantissa = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * BUCKETS)
    bucket = F.when(size == float("inf"), F.lit(2 * SHIFT * BUCKETS)).otherwise((exponent + SHIFT) * BUCKETS + mantissa)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * bucket).cast("bigint")


def _same(keys: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolation quantiles per group, as an array in ``probs`` order.

    Distinct values are counted, then cut into buckets by size: a group's buckets
    are summed up first, and each wanted rank is looked for in its own bucket
    alone, so a group of any size spreads over many tasks. The interpolation is
    the built-in aggregate's, to the same bits. Nulls and NaN do not count.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    counted = rows.groupBy(*keys, "_v").agg(F.count("*").alias("_n")).withColumn("_b", _value_bucket(F.col("_v")))
    parts = counted.groupBy(*keys, "_b").agg(F.sum("_n").alias("_in"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *keys, "_b", "_in", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"), F.sum("_in").over(group).alias("_total")
    )
    wanted = parts.withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    wanted = wanted.withColumn("_h", (F.col("_total") - 1) * F.col("_p"))
    wanted = wanted.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))))
    located = wanted.where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in"))).select(
        *[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_b").alias("_w_b"), "_before", "_p", "_h", "_rank"
    )
    running = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("_n").over(running))
    rank = F.col("_rank") - F.col("_before")
    hits = ranked.join(located, _same(keys, "_w_") & (F.col("_b") == F.col("_w_b"))).where(
        (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
    )
    per_prob = hits.groupBy(*keys, "_p").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.max("_h").alias("_h"))
    interpolated = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        (F.ceil("_h") - F.col("_h")) * F.col("_lo") + (F.col("_h") - F.floor("_h")) * F.col("_hi")
    )
    return per_prob.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_p", interpolated.alias("v")))), lambda s: s["v"]
        ).alias("quantiles")
    )


def exact_quantiles_of(df: DataFrame, keys: Sequence[str], values: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """:func:`exact_quantiles` of several columns in one pass, one array column named for each.

    The column's name is one more key, so all columns share each exchange and a
    group's work spreads further. A column without values in a group gives null;
    a group without any gives no row.
    """
    named = [F.struct(F.lit(v).alias("_of"), F.col(v).cast("double").alias("_value")) for v in values]
    stacked = df.select(*keys, F.inline(F.array(*named)))
    found = exact_quantiles(stacked, [*keys, "_of"], "_value", probs)
    return found.groupBy(*keys).agg(
        *[F.any_value(F.when(F.col("_of") == v, F.col("quantiles")), True).alias(v) for v in values]
    )


def equal_frequency_bins(df: DataFrame, keys: Sequence[str], value: str, bins: int, out: str) -> DataFrame:
    """Quantile bin of each row within its group, repeated edges dropped.

    Bins are right-closed and the lowest edge belongs to bin 0. A group with one
    distinct edge gets null, as do null and NaN values.
    """
    edges = exact_quantiles(df, keys, value, [i / bins for i in range(bins + 1)])
    edges = edges.select(
        *[F.col(k).alias(f"_e_{k}") for k in keys],
        F.array_distinct("quantiles").alias("_edges"),
    )
    v = F.col(value).cast("double")
    below = F.size(F.filter("_edges", lambda e: e < v))
    binned = F.when(
        v.isNotNull() & ~F.isnan(v) & (F.size("_edges") > 1),
        F.greatest(below - 1, F.lit(0)).cast("bigint"),
    )
    return (
        df.join(edges, _same(keys, "_e_"), "left")
        .withColumn(out, binned)
        .drop("_edges", *[f"_e_{k}" for k in keys])
    )
