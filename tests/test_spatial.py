import math
import random

import pytest
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.operators import cover, spatial
from cartomark.plans import evaluate
from helpers import boxes, plan_of, random_boxes

KEYS = ["id", "geo_value"]


def meets(p, g):
    return p[0] == g[0] and p[1] == g[1] and p[3] <= g[5] and g[3] <= p[5] and p[4] <= g[6] and g[4] <= p[6]


def test_pairs_hold_every_intersecting_pair_once(spark):
    rng = random.Random(11)
    p_rows, g_rows = random_boxes(rng, 250, "p"), random_boxes(rng, 250, "g")
    # A map-wide box on either side, and copies of one box.
    p_rows += [(0, "a", "pbig", -5000.0, -5000.0, 5000.0, 5000.0)]
    g_rows += [(0, "a", "gbig", -9000.0, -9000.0, 9000.0, 9000.0)]
    g_rows += [(1, "b", f"copy{i}", 1.0, 1.0, 9.0, 9.0) for i in range(30)]
    pairs = spatial.spatial_pairs(boxes(spark, p_rows), boxes(spark, g_rows), KEYS, 10.0)
    got = [(r.p_fid, r.g_fid) for r in pairs.select("p_fid", "g_fid").collect()]
    assert len(got) == len(set(got))
    want = {(p[2], g[2]) for p in p_rows for g in g_rows if meets(p, g)}
    assert want <= set(got)
    exact = spatial.spatial_pairs(
        boxes(spark, p_rows), boxes(spark, g_rows), KEYS, 10.0,
        condition=G.boxes_intersect(F.col("p_bbox"), F.col("g_bbox")),
    )
    assert {(r.p_fid, r.g_fid) for r in exact.collect()} == want


def test_pairs_join_by_hash_or_sort(spark):
    rng = random.Random(12)
    a, b = boxes(spark, random_boxes(rng, 50, "p")), boxes(spark, random_boxes(rng, 50, "g"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spatial.spatial_pairs(a, b, KEYS, 10.0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_prefilters_agree(spark):
    rng = random.Random(13)
    p_rows, g_rows = random_boxes(rng, 120, "p", big=0), random_boxes(rng, 120, "g", big=0)
    p, g = boxes(spark, p_rows), boxes(spark, g_rows)
    by_box = spatial.box_prefilter(p, g, KEYS, 20.0)
    by_cells = spatial.cell_prefilter(
        spatial.with_cells(p, 20.0, 2), spatial.with_cells(g, 20.0, 2), KEYS
    )
    for one, two in zip(by_box, by_cells):
        assert {r.fid for r in one.collect()} == {r.fid for r in two.collect()}
    pairs = spatial.spatial_pairs(p, g, KEYS, 20.0, oversize=False)
    assert {r.p_fid for r in pairs.collect()} == {r.fid for r in by_box[0].collect()}


def test_index_pages_stay_small_and_whole(spark):
    rows = [(1, "a", f"f{i:03d}", 1.0, 1.0, 2.0, 2.0) for i in range(200)]
    covered = spatial.with_cells(boxes(spark, rows), 10.0, 1)
    index = spatial.cell_index_table(covered, ["id"], page_rows=20).collect()
    assert len(index) > 5
    assert sorted(f for r in index for f in r.refs) == [f"f{i:03d}" for i in range(200)]


def test_evaluation_micro_cases(spark):
    perf = boxes(
        spark,
        [
            (1, "a", "equal", 0, 0, 100, 100),
            (1, "a", "far", 5000, 5000, 5100, 5100),
            (1, "b", "other", 0, 0, 100, 100),
        ],
    ).withColumn("system", F.lit("s")).withColumn("system_version", F.lit("1"))
    truth = boxes(
        spark,
        [(1, "a", "t1", 0, 0, 100, 100), (1, "a", "t2", 50, 0, 150, 100), (1, "c", "t3", 0, 0, 1, 1)],
    )
    got = {r.p_fid: r for r in evaluate.evaluate_boxes(perf, truth, 50.0, 10.0).collect()}
    assert set(got) == {"equal"}
    row = got["equal"]
    assert (row.g_fid, row.iou, row.f1, row.num_cand_geom, row.num_cand_perf) == ("t1", 100.0, 1.0, 2, 1)
    assert (row.inf_count, row.grnd_count, row.geo_value_query) == (2, 2, True)
    strict = evaluate.evaluate_boxes(perf, truth, 50.0, 10.0, predicate="overlaps").collect()
    assert [(r.p_fid, r.g_fid, r.iou_units) for r in strict] == [("equal", "t2", 33333)]
    missed = evaluate.unmatched_features(perf.select("id", "fid"), evaluate.evaluate_boxes(perf, truth, 50.0, 10.0))
    assert {r.fid for r in missed.collect()} == {"far", "other"}


def test_equal_iou_takes_the_higher_f1(spark):
    # Same IoU for both truths, but on the pixel grid one shares more.
    perf = boxes(spark, [(1, "a", "p", 10, 10, 30, 30)]).withColumn("system", F.lit("s"))
    truth = boxes(spark, [(1, "a", "t1", 15, 10, 35, 30), (1, "a", "t2", 5, 10, 25, 30)])
    got = evaluate.evaluate_boxes(perf, truth, 50.0, 10.0).collect()
    scores = {}
    for fid in ("t1", "t2"):
        only = evaluate.evaluate_boxes(perf, truth.where(F.col("fid") == fid), 50.0, 10.0).first()
        scores[fid] = (only.iou_units, only.f1)
    assert scores["t1"][0] == scores["t2"][0]
    assert got[0].f1 == max(s[1] for s in scores.values())


def test_unlabelled_and_crude(spark):
    perf = boxes(
        spark, [(1, G.USE_SPATIAL_INDEX, "u", 0, 0, 10, 10), (1, "a", "k", 0, 0, 10, 10)]
    ).withColumn("system", F.lit("s")).withColumn("feature_type", F.lit("polygon"))
    truth = boxes(spark, [(1, "x", "t", 0, 0, 10, 10)]).withColumn("feature_type", F.lit("polygon"))
    got = evaluate.evaluate_unlabelled(perf, truth, 5.0, 1.0).collect()
    assert [(r.p_fid, r.g_fid, r.geo_value_query) for r in got] == [("u", "t", False)]
    crude = evaluate.evaluate_crude(perf, truth, 5.0, 1.0).collect()
    assert {r.p_fid for r in crude} == {"u", "k"}


def test_reference_system_must_agree(spark):
    perf = boxes(spark, [(1, "a", "p", 0, 0, 10, 10)]).withColumn("system", F.lit("s"))
    truth = boxes(spark, [(1, "a", "t", 0, 0, 10, 10)])
    p = perf.withColumn("epsg", F.lit("epsg:32612"))
    assert evaluate.evaluate_boxes(p, truth.withColumn("epsg", F.lit("epsg:32612")), 5.0, 1.0).count() == 1
    other = truth.withColumn("epsg", F.lit("epsg:4326"))
    assert evaluate.evaluate_boxes(p, other, 5.0, 1.0).count() == 0
    assert [tuple(r) for r in evaluate.crs_mismatches(p, other).collect()] == [(1, "epsg:32612", "epsg:4326")]


@pytest.mark.parametrize("kind", ["line", "point"])
def test_buffered_geometries(spark, kind):
    coords = {"line": "array<array<double>>", "point": "array<double>"}[kind]
    value = {"line": [[10.0, -10.0], [20.0, -10.0]], "point": [10.0, -10.0]}[kind]
    moved = {"line": [[10.0, -11.0], [20.0, -11.0]], "point": [10.0, -11.0]}[kind]

    def side(rows):
        df = spark.createDataFrame(rows, f"id int, geo_value string, fid string, c {coords}")
        return df.withColumn("geom", G.geometry_from_pairs(kind, F.col("c"))).drop("c")

    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.5, 0.0, 0.0, 0.0, -0.5, 0.0))])
    rasters = spark.createDataFrame([(1, 200, 200, 40000)], "id int, width int, height int, total_pix long").withColumn("transform", t)
    scales = spark.createDataFrame([(1, 24000)], "id int, scale long")
    got = evaluate.evaluate_geometries(
        side([(1, "a", "same", value), (1, "a", "near", moved)]).withColumn("system", F.lit("s")),
        side([(1, "a", "t", value)]), rasters, 10.0, scales=scales, dynamic_buffer=0.005,
    )
    rows = {r.p_fid: r for r in got.collect()}
    assert rows["same"].iou == 100.0 and rows["same"].f1 == 1.0
    assert 0 < rows["near"].iou < 100 and 0 < rows["near"].f1 < 1


def _points(spark, rows):
    df = spark.createDataFrame(rows, "id int, geo_value string, fid string, c array<double>")
    return df.withColumn("geom", G.geometry_from_pairs("point", F.col("c"))).drop("c")


def test_repeated_and_absent_scales(spark):
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.5, 0.0, 0.0, 0.0, -0.5, 0.0))])
    sizes = [(1, 200, 200, 40000), (1, 200, 200, 40000), (2, 200, 200, 40000)]
    rasters = spark.createDataFrame(sizes, "id int, width int, height int, total_pix long").withColumn("transform", t)
    scales = spark.createDataFrame([(1, 24000), (1, 24000)], "id int, scale long")
    perf = _points(spark, [(1, "a", "p1", [10.0, -10.0]), (2, "a", "p2", [10.0, -10.0])]).withColumn("system", F.lit("s"))
    truth = _points(spark, [(1, "a", "t1", [10.0, -10.0]), (2, "a", "t2", [10.0, -10.0])])
    rows = evaluate.evaluate_geometries(perf, truth, rasters, 10.0, scales=scales, dynamic_buffer=0.005).collect()
    got = {r.p_fid: r for r in rows}
    assert len(rows) == 2 and set(got) == {"p1", "p2"}
    assert all(r.inf_count == r.grnd_count == 1 and r.iou == 100.0 for r in rows)
    assert got["p1"].len_pdf > 1 and got["p2"].len_pdf == 1


def test_wide_boxes_do_not_change_candidates(spark):
    rng = random.Random(11)
    perf = random_boxes(rng, 60, "p", big=0.1) + [(0, "a", "far", -9000.0, -9000.0, 9000.0, -8000.0)]
    truth = random_boxes(rng, 60, "t", big=0.1) + [(0, "a", "wide", -9000.0, -9000.0, 9000.0, 9000.0), (0, "a", "far", 5000.0, -9000.0, 9000.0, 9000.0)]
    size = 25.0

    def cells(r):
        return [math.floor(v / size) for v in r[3:7]]

    def meet(a, b):
        (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = cells(a), cells(b)
        return a[:2] == b[:2] and ax0 <= bx1 and bx0 <= ax1 and ay0 <= by1 and by0 <= ay1

    want = {(a[2], b[2]) for a in perf for b in truth if meet(a, b)}
    got = [(r.p_fid, r.g_fid) for r in spatial.spatial_pairs(boxes(spark, perf), boxes(spark, truth), ["id", "geo_value"], size).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_small_features_inside_a_large_one_are_kept(spark):
    def side(rows):
        df = spark.createDataFrame(rows, "id int, fid string, c array<array<array<double>>>")
        geom = df.withColumn("geom", G.geometry_from_pairs("polygon", F.col("c"))).drop("c")
        return geom, cover.compact_cover(geom, 1.0).join(geom.select("id", "fid"), "fid")

    def ring(x, y, w):
        return [[[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]]

    perf = side([(1, "inside", ring(-300.5, 40.2, 3.0)), (1, "outside", ring(3000.0, 3000.0, 3.0)), (1, "near small", ring(5000.0, 0.0, 2.0)), (2, "other map", ring(0.0, 0.0, 3.0))])
    truth = side([(1, "large", ring(-1000.3, -1000.3, 2000.0)), (1, "small", ring(5003.2, 0.0, 2.0)), (1, "far", ring(-7000.0, 0.0, 2.0))])
    large = truth[1].where("fid = 'large'")
    assert large.count() < 40_000 < large.agg(F.sum(F.pow(F.lit(4), F.col("level")))).first()[0]
    kept_perf, kept_truth = cover.cover_prefilter(perf[0], truth[0], perf[1], truth[1], ["id"])
    assert {r.fid for r in kept_perf.collect()} == {"inside"}
    assert {r.fid for r in kept_truth.collect()} == {"large"}
    index = cover.cover_index(truth[1].unionByName(perf[1]), ["id"], page_rows=1)
    refs = index.agg(F.sum(F.size("refs"))).first()[0]
    assert refs == truth[1].count() + perf[1].count()
