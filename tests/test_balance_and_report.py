import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartomark.operators import balance
from cartomark.plans import report
from helpers import plan_of


def sample(rng, n=400):
    rows = []
    for i in range(n):
        key = rng.choice("abc")
        value = rng.choice([rng.uniform(0, 1), float(rng.randrange(4)), None, float("nan")])
        rows.append((i, key, value))
    rows += [(n + i, "flat", 2.5) for i in range(9)]
    return rows


def test_quantiles_equal_numpy(spark):
    rows = sample(random.Random(1))
    df = spark.createDataFrame(rows, "i int, k string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: r.quantiles for r in balance.exact_quantiles(df, ["k"], "v", probs).collect()}
    for key in {r[1] for r in rows}:
        values = [v for _, k, v in rows if k == key and v is not None and v == v]
        assert got[key] == pytest.approx(list(np.quantile(values, probs)))


def test_quantiles_have_the_bits_of_the_built_in(spark):
    rng = random.Random(4)
    special = [0.0, -0.0, 1.0, 2.0, 4.0, 0.5, 5e-324, 1e308, -1e308, float("inf"), -float("inf"), 1 - 2**-53, 2 - 2**-52, 8.0 - 2**-50]
    rows = [("a", v) for v in special] + [("b", rng.uniform(-3, 3)) for _ in range(400)] + [("c", rng.expovariate(1) * 2.0 ** rng.randrange(-40, 40)) for _ in range(400)]
    rows += [(None, 1.5), (None, 2.5)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    probs = [i / 20 for i in range(21)]
    want = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, probs))).alias("q")).collect()}
    got = {r.k: r.quantiles for r in balance.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert {k: list(map(repr, v)) for k, v in got.items() if k != "a"} == {k: list(map(repr, v)) for k, v in want.items() if k != "a"}
    assert [x for x in got["a"] if x == x] == [x for x in want["a"] if x == x]


def test_several_columns_take_one_pass(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.uniform(0, 1), rng.choice([None, float("nan"), float(rng.randrange(9))]), None) for _ in range(300)]
    rows += [("none", None, float("nan"), None), ("half", None, 4.0, None)]
    df = spark.createDataFrame(rows, "k string, u double, v double, w double").repartition(3)
    probs = [0.25, 0.5]
    many = balance.exact_quantiles_of(df, ["k"], ["u", "v", "w"], probs)
    got = {r.k: r for r in many.collect()}
    assert many.columns == ["k", "u", "v", "w"] and "none" not in got
    assert got["half"].u is None and got["half"].v == [4.0, 4.0] and all(r.w is None for r in got.values())
    for column in "uv":
        alone = {r.k: r.quantiles for r in balance.exact_quantiles(df, ["k"], column, probs).collect()}
        assert {k: r[column] for k, r in got.items() if r[column] is not None} == alone
    fresh = balance.exact_quantiles_of(df, ["k"], ["u", "v", "w"], probs)
    joins = plan_of(fresh).count("Join"), plan_of(balance.exact_quantiles(df, ["k"], "u", probs)).count("Join")
    assert joins[0] == joins[1] > 0


def test_bins_equal_qcut(spark):
    rows = sample(random.Random(2))
    df = spark.createDataFrame(rows, "i int, k string, v double")
    got = {r.i: r.b for r in balance.equal_frequency_bins(df, ["k"], "v", 10, "b").collect()}
    frame = pd.DataFrame(rows, columns=["i", "k", "v"])
    for _, group in frame.groupby("k"):
        bins = pd.qcut(group["v"].astype(float), 10, labels=False, duplicates="drop")
        for i, b in zip(group["i"], bins):
            assert got[i] == (None if b != b else int(b)), (i, b)


def test_salted_join_is_the_plain_join(spark):
    rng = random.Random(3)
    left = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", i) for i in range(300)]
    right = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(6)}", i) for i in range(200)]
    a = spark.createDataFrame(left, "k string, l int")
    b = spark.createDataFrame(right, "k string, r int")
    sa, sb = balance.salt_by_work(a, b, ["k"], "l", target_pairs=500)
    assert sa.count() == 300
    assert sa.where("k = 'hot'").select("salt").distinct().count() > 10
    got = sorted((r.l, r.r) for r in sa.join(sb, ["k", "salt"]).collect())
    want = sorted((l, r) for k, l in left for k2, r in right if k == k2)
    assert got == want


def test_row_index_spreads_one_key(spark):
    df = spark.range(500).select(F.when(F.col("id") < 450, "hot").otherwise("cold").alias("k"), F.hash("id").alias("v"))
    got = balance.row_index(df, ["k"], ["v"])
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r.k, []).append((r.ref_index, r.v))
    for rows in by_key.values():
        rows.sort()
        assert [i for i, _ in rows] == list(range(len(rows)))
        assert [v for _, v in rows] == sorted(v for _, v in rows)


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    first = balance.first_per_key(df, ["k"], [F.desc("id")])
    assert sorted((r.k, r.id) for r in first.collect()) == [(k, max(i for i in range(1000) if i % 7 == k)) for k in range(7)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def metrics(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        label = rng.choice(["a", "b", None])
        rows.append(
            (rng.randrange(6), "s" + str(rng.randrange(2)), "1", label, rng.randrange(100_000), rng.random(),
             "success-f1", rng.randrange(1, 9), rng.randrange(1, 9), rng.randrange(1, 9), rng.randrange(1, 9))
        )
    cols = ("id int, system string, system_version string, geo_value string, iou_units long, f1 double, f1_message string,"
            "num_cand_perf long, num_cand_geom long, inf_count long, grnd_count long")
    df = spark.createDataFrame(rows, cols).withColumn("iou", F.col("iou_units") / 1000.0)
    return df, df.toPandas()


def test_rollups_equal_pandas(spark):
    df, frame = metrics(spark)
    frame["candidate_ratio"] = frame.num_cand_perf / frame.num_cand_geom
    maps = report.map_rollup(df).toPandas().set_index(["id", "system"]).sort_index()
    want = frame.groupby(["id", "system"]).agg(
        {"geo_value": "nunique", "iou": ["mean", "median", "count"], "f1": ["mean", "median"], "candidate_ratio": ["mean", "median"]}
    )
    want.columns = ["_".join(c) for c in want.columns]
    for col in want.columns:
        assert list(maps[col]) == pytest.approx(list(want[col])), col
    performers = report.performer_rollup(report.map_rollup(df)).toPandas().set_index("system").sort_index()
    again = want.reset_index().groupby("system")["iou_median"].agg(["mean", "median"])
    assert list(performers["iou_median_mean"]) == pytest.approx(list(again["mean"]))
    assert list(performers["iou_median_median"]) == pytest.approx(list(again["median"]))


def test_hot_groups_give_the_same_medians(spark):
    df, _ = metrics(spark)
    rows = report.with_ratios(df)
    plain = report.means_and_medians(rows, ["system"], report.METRICS).toPandas().sort_values("system")
    split = report.means_and_medians(rows, ["system"], report.METRICS, spread=True).toPandas().sort_values("system")
    for col in plain.columns[1:]:
        assert list(plain[col]) == list(split[col])


def test_null_labels_are_kept_or_dropped(spark):
    df, frame = metrics(spark)
    kept = report.label_rollup(df)
    assert kept.where("geo_value is null").count() > 0
    dropped = report.label_rollup(df, drop_null_keys=True)
    assert dropped.count() == kept.where("geo_value is not null").count()


def test_report_joins_unique_maps(spark):
    df, _ = metrics(spark)
    maps = spark.createDataFrame([(i, "S") for i in range(6)] + [(0, "S")], "id int, state string")
    out = report.report(df.withColumn("feature_type", F.lit("line")), maps, by=["feature_type"])
    assert out["map"].count() == report.map_rollup(df).count()
    assert set(out) == {"label", "label_iou_deciles", "label_f1_deciles", "map", "map_iou_deciles", "map_f1_deciles", "performer"}
    deciles = out["map_iou_deciles"].toPandas()
    assert deciles["iou_count_sum"].sum() == df.count()
