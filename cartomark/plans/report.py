"""Roll-ups of match metrics per label, map and performer, with deciles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.operators.balance import equal_frequency_bins, exact_quantiles_of
from cartomark.session import materialize

PERFORMER = ["system", "system_version"]
MAP = ["id", *PERFORMER]
LABEL = ["id", *PERFORMER, "geo_value", "f1_message"]


def with_ratios(metrics: DataFrame) -> DataFrame:
    """Add the candidate and count ratios the roll-ups average; NaN becomes null."""
    rows = metrics.withColumns(
        {
            "candidate_ratio": F.try_divide(F.col("num_cand_perf"), F.col("num_cand_geom")),
            "inf_grnd_ratio": F.try_divide(F.col("inf_count"), F.col("grnd_count")),
        }
    )
    return rows.withColumns(
        {c: F.nanvl(F.col(c), F.lit(None)) for c in ("f1", "candidate_ratio", "inf_grnd_ratio")}
    )


METRICS = ("iou", "f1", "candidate_ratio", "inf_grnd_ratio")


def mean_iou() -> Column:
    """Mean IoU from whole units, so that summing order cannot change it."""
    return F.sum("iou_units") / F.count("iou_units") / F.lit(1000.0)


def means_and_medians(
    rows: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    extra: Sequence[Column] = (),
    spread: bool = False,
) -> DataFrame:
    """``<metric>_mean`` and ``<metric>_median`` per group, plus ``extra`` aggregates.

    Groups of one map or label take the built-in median in the same aggregation.
    ``spread`` is for groups as large as the table (a performer, a bin of one):
    their medians are ranked over many tasks, all metrics in one pass. Both give
    the same bits.
    """
    keys = list(keys)
    means = [
        (mean_iou() if m == "iou" else F.avg(m)).alias(f"{m}_mean") for m in metrics
    ]
    if not spread:
        medians = [F.median(m).alias(f"{m}_median") for m in metrics]
        return rows.groupBy(*keys).agg(*extra, *means, *medians)
    out = rows.groupBy(*keys).agg(*extra, *means)
    halves = exact_quantiles_of(rows, keys, metrics, [0.5]).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(m)[0].alias(f"{m}_median") for m in metrics]
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return out.join(halves, same, "left").drop(*[f"_k_{k}" for k in keys])


def label_rollup(
    metrics: DataFrame, eval_set: DataFrame | None = None, by: Sequence[str] = (), drop_null_keys: bool = False
) -> DataFrame:
    """Per map, performer, label and F1 outcome; crude rows keep a null label.

    ``drop_null_keys`` leaves rows without a label out instead.
    """
    keys = [*by, *LABEL]
    rows = with_ratios(metrics)
    if drop_null_keys:
        rows = rows.dropna(subset=keys)
    out = means_and_medians(rows, keys, METRICS, [F.count("iou").alias("iou_count")])
    return with_eval_set(out, eval_set)


def map_rollup(metrics: DataFrame, eval_set: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    extra = [
        F.count_distinct("geo_value").alias("geo_value_nunique"),
        F.count("iou").alias("iou_count"),
    ]
    out = means_and_medians(with_ratios(metrics), [*by, *MAP], METRICS, extra)
    return with_eval_set(out, eval_set)


def performer_rollup(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and median over maps of the per-map medians."""
    cols = [f"{m}_median" for m in METRICS]
    return means_and_medians(materialize(maps.select(*by, *PERFORMER, *cols), "maps"), [*by, *PERFORMER], cols, spread=True)


def decile_rollup(
    rollup: DataFrame, metric: str, q: int = 10, by: Sequence[str] = (), keep_null_bins: bool = False
) -> DataFrame:
    """Counts, means and medians per performer and equal-frequency bin of a metric."""
    bin_col = f"{metric}_q"
    keys = [*by, *PERFORMER]
    # Written once: the edges and each median read it again.
    binned = materialize(equal_frequency_bins(materialize(rollup, "rollup"), keys, metric, q, bin_col), "binned")
    if not keep_null_bins:
        binned = binned.where(F.col(bin_col).isNotNull())
    extra = [F.count_distinct("id").alias("id_nunique"), F.sum("iou_count").alias("iou_count_sum")]
    if "geo_value" in rollup.columns:
        extra.append(F.count_distinct("geo_value").alias("geo_value_nunique"))
    return means_and_medians(binned, [*keys, bin_col], ["iou_median", "f1_median"], extra, spread=True)


def with_eval_set(rollup: DataFrame, eval_set: DataFrame | None) -> DataFrame:
    """Join the map facts of the evaluation set; its keys are made unique first."""
    if eval_set is None:
        return rollup
    keys = [c for c in ("id", "cog_id") if c in eval_set.columns and c in rollup.columns]
    return rollup.join(eval_set.dropDuplicates(keys), keys)


def report(metrics: DataFrame, eval_set: DataFrame, by: Sequence[str] = (), q: int = 10) -> dict[str, DataFrame]:
    """All roll-ups of written match metrics; ``by`` may hold ``feature_type``."""
    labels = materialize(label_rollup(metrics, eval_set, by), "labels")
    maps = materialize(map_rollup(metrics, eval_set, by), "maps")
    return {
        "label": labels,
        "label_iou_deciles": decile_rollup(labels, "iou_median", q, by),
        "label_f1_deciles": decile_rollup(labels, "f1_median", q, by),
        "map": maps,
        "map_iou_deciles": decile_rollup(maps, "iou_median", q, by),
        "map_f1_deciles": decile_rollup(maps, "f1_median", q, by),
        "performer": performer_rollup(maps, by),
    }
