"""What keeps files, exchanges and repeated work in proportion to the input."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions import nested as N
from cartomark.operators import raster as R
from cartomark.operators import spatial
from cartomark.plans import evaluate
from cartomark.session import run_folder


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def written(spark, name: str) -> set[str]:
    return set(glob.glob(f"{run_folder(spark)}/{name}-*"))


def box_rows(spark, rows):
    rows = [(*r[:3], *map(float, r[3:])) for r in rows]
    df = spark.createDataFrame(rows, "id int, geo_value string, fid string, x0 double, y0 double, x1 double, y1 double")
    return df.withColumn("bbox", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).drop("x0", "y0", "x1", "y1")


def test_few_systems_go_to_the_records(spark):
    records = spark.range(1000).selectExpr("id", "chr(97 + id % 2 * 2) AS system", "string(1 + id % 1) AS system_version")
    wanted = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1")], "system string, system_version string")
    kept = N.match_systems(records, wanted)
    assert "BroadcastHashJoin" in plan(kept) and "SortMergeJoin" not in plan(kept)
    assert kept.count() == 500


def test_matches_are_made_once(spark):
    perf = box_rows(spark, [(1, "a", "p", 0, 0, 10, 10)]).withColumn("system", F.lit("s"))
    truth = box_rows(spark, [(1, "a", "g", 0, 0, 10, 10)])
    before = written(spark, "box-matches")
    rows = evaluate.evaluate_boxes(perf, truth, 20, 1)
    assert len(written(spark, "box-matches") - before) == 1
    assert [(r["p_fid"], r["num_cand_perf"]) for r in rows.collect()] == [("p", 1)]


def test_outline_rows_do_not_travel(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (90, 0), (0, 200), (0, 0))])
    shapes = spark.range(3).select(F.col("id").alias("fid"), G.geometry(F.lit("polygon"), F.array(ring)).alias("px_geom"))
    runs = R.outline_runs(shapes)
    exchanges = [line for line in plan(runs).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "_band" in exchanges[0] and "row#" not in exchanges[0]
    rows = runs.groupBy("fid").agg(F.count_distinct("row").alias("n"), F.count("*").alias("runs")).collect()
    assert [(r["n"], r["runs"]) for r in rows] == [(201, 201)] * 3


def test_repeated_runs_count_each_time(spark):
    runs = spark.createDataFrame(
        [("p", 7, 0, 4), ("p", 8, 0, 4), ("p", 8, 0, 4), ("p", -1, 2, 3), ("g", 7, 3, 9), ("g", 8, 3, 9), ("g", -1, 0, 9), ("g", -1, 0, 9)],
        "fid string, row bigint, c0 bigint, c1 bigint",
    )
    pairs = spark.createDataFrame([("p", "g"), ("p", "x")], "p_fid string, g_fid string")
    found = R.pixel_overlap(pairs, runs, runs).collect()
    # Row 7: 2; row 8: twice 2; row -1: 2 twice.
    assert [(r["p_fid"], r["g_fid"], r["true_positives"]) for r in found] == [("p", "g", 10)]


def test_prefilter_carries_no_boxes_at_the_base_level(spark):
    perf = box_rows(spark, [(1, "a", "p1", 0, 0, 30, 30), (1, "a", "p2", 500, 500, 510, 510), (1, "a", "p3", 5000, 5000, 5010, 5010)])
    truth = box_rows(spark, [(1, "a", "g1", 25, 25, 45, 45), (1, "a", "g2", 400, 0, 4000, 4000), (1, "b", "g3", 0, 0, 9, 9)])
    left, right, _ = spatial._placed_sides(perf, truth, ["id", "geo_value"], 20, any_cell=True)
    assert left.where("_lv = 0 and p_bbox is not null").count() == 0
    assert right.where("_lv = 0 and g_bbox is not null").count() == 0
    kept = spatial.box_prefilter(perf, truth, ["id", "geo_value"], 20)
    assert [sorted(r["fid"] for r in side.collect()) for side in kept] == [["p1", "p2"], ["g1", "g2"]]


def test_a_map_is_one_file_however_many_tasks_write(spark, tmp_path):
    from cartomark.workload import scan_queries as S

    lines = spark.range(400, numPartitions=8).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id % 5 AS l_suppkey", "2 AS l_linenumber", "1.0D * (id % 50) AS l_quantity",
        "100.0D * id AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'A' AS l_returnflag",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    before = written(spark, "vector-lines")
    rows = S.s07(spark, str(tmp_path)).collect()
    assert sorted((r["shp_file"], r["n"]) for r in rows) == [(f"{k}.shp", 80) for k in range(5)]
    (folder,) = written(spark, "vector-lines") - before
    assert len(glob.glob(f"{folder}/id=0/part-*")) == 1


def test_places_near_the_antipode_are_dealt_out(spark, tmp_path):
    from cartomark.workload import geo_queries as Q

    spark.range(1, 9).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    rows = Q.g12_antipodal(spark, str(tmp_path))
    assert "RoundRobinPartitioning" in plan(rows)
    assert [(r["km"], r["is_shorter"]) for r in rows.collect()] == [(20003.93146, True)] * 8


def line_rows(spark, path, rows):
    """Line items from ``order, map, line number, x0, y0``: boxes of 100 by 100 under one label."""
    lines = spark.createDataFrame(
        [(o, 1, m, n, x / 100, y * 20.0, 0.0, 0.0, "A") for o, m, n, x, y in rows],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string",
    )
    lines.write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_boxes_as_large_as_a_cell_travel_seldom_twice(spark):
    rows = [(1, "a", f"f{i}-{j}", x, y, x + 20, y + 20) for i, x in enumerate(range(5, 405, 20)) for j, y in enumerate(range(5, 405, 20))]
    side = box_rows(spark, rows)
    left, _, _ = spatial._placed_sides(side, side, ["id", "geo_value"], 20)
    assert left.count() < 2 * len(rows)
    # Covers of two cells by two meet those of the eight neighbours, and their own.
    pairs = spatial.spatial_pairs(side, side, ["id", "geo_value"], 20)
    assert pairs.count() == (3 * 20 - 2) ** 2 == pairs.select("p_fid", "g_fid").distinct().count()


def test_boxes_in_one_square_are_candidates_only_if_their_covers_meet(spark):
    perf = box_rows(spark, [(1, "a", "p", 1, 1, 9, 9)])
    truth = box_rows(spark, [(1, "a", "near", 15, 15, 19, 19), (1, "a", "far", 41, 1, 49, 9)])
    for oversize in (True, False):
        pairs = spatial.spatial_pairs(perf, truth, ["id", "geo_value"], 20, oversize=oversize)
        assert [r["g_fid"] for r in pairs.collect()] == ["near"]


def test_features_without_a_match_are_counted_but_not_named(spark):
    perf = box_rows(spark, [(1, "a", "p", 0, 0, 10, 10), (1, "a", "q", 12, 12, 13, 13)]).withColumn("system", F.lit("s"))
    truth = box_rows(spark, [(1, "a", "g", 0, 0, 10, 10)])
    before = written(spark, "box-matches")
    rows = evaluate.evaluate_boxes(perf, truth, 20, 1)
    (folder,) = written(spark, "box-matches") - before
    assert {r["p_fid"] for r in spark.read.parquet(folder).collect()} == {"p", None}
    assert [(r["p_fid"], r["num_cand_perf"]) for r in rows.collect()] == [("p", 2)]


def test_unmatched_features_need_no_distinct_metrics(spark):
    perf = spark.createDataFrame([(1, "p"), (1, "q"), (None, "p")], "id int, fid string")
    metrics = spark.createDataFrame([(1, "p"), (1, "p")], "id int, p_fid string")
    rows = evaluate.unmatched_features(perf, metrics)
    assert "HashAggregate" not in plan(rows)
    assert sorted(map(str, rows.collect())) == ["Row(id=1, fid='q')", "Row(id=None, fid='p')"]


def test_only_boxes_with_a_pair_become_runs(spark, tmp_path):
    from cartomark.workload import aggregate_queries as Q

    sf_dir = line_rows(spark, tmp_path, [(1, 7, 1, 0, 0), (2, 7, 2, 50, 0), (3, 7, 1, 900, 900), (4, 8, 2, 0, 0)])
    before = written(spark, "box-pairs")
    rows = Q.a08(spark, sf_dir)
    assert len(written(spark, "box-pairs") - before) == 1
    assert "LeftSemi" in plan(rows)
    assert [(r["p_fid"][0], r["g_fid"][0], r["true_positives"], r["len_pdf"], r["len_gdf"]) for r in rows.collect()] == [("1", "2", 24, 36, 36)]


def test_cell_index_makes_its_rows_once(spark):
    rows = box_rows(spark, [(1, "a", f"f{i:02d}", 0, 0, 5, 5) for i in range(40)] + [(None, "a", f"n{i:02d}", 0, 0, 5, 5) for i in range(9)])
    index = spatial.cell_index_table(spatial.with_cells(rows, 10.0, 1), ["id"], page_rows=4)
    assert plan(index).count("Exchange hashpartitioning") == 1
    pages = index.collect()
    assert sorted(f for r in pages if r["id"] == 1 for f in r["refs"]) == [f"f{i:02d}" for i in range(40)]
    assert sum(r["id"] == 1 for r in pages) > 1
    # Rows of an unknown map are not counted into pages.
    assert [len(r["refs"]) for r in pages if r["id"] is None] == [9]


def test_near_places_share_few_squares(spark, tmp_path):
    from cartomark.workload import join_queries as Q

    places = spark.range(-1000, 1000, 7).selectExpr("id AS x", "id * 3 % 1000 AS y")
    near = spatial.near_squares(places, {"x": "cx", "y": "cy"}, 100, 400)
    assert near.count() < 3 * places.count()
    sf_dir = line_rows(spark, tmp_path, [(1, 7, 1, 395, 405), (2, 7, 2, 405, 395), (3, 7, 2, 495, 505), (4, 7, 2, 496, 405), (5, 8, 2, 395, 405)])
    assert sorted((r["p_fid"][0], r["g_fid"][0]) for r in Q.l04(spark, sf_dir).collect()) == [("1", "2"), ("1", "3")]


def test_upright_edges_are_drawn_in_blocks(spark):
    from cartomark.operators import blocks as B

    def ring(*points):
        return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])

    box = ring((3, -5), (90, -5), (90, 70), (3, 70), (3, -5))
    hole = ring((20, 10), (20, 41), (60, 30), (60, 10), (20, 10))
    shapes = spark.range(1).select(
        F.inline(F.array(
            F.struct(F.lit("box").alias("fid"), G.geometry(F.lit("polygon"), F.array(box)).alias("px_geom")),
            F.struct(F.lit("holed").alias("fid"), G.geometry(F.lit("polygon"), F.array(box, hole)).alias("px_geom")),
            F.struct(F.lit("line").alias("fid"), G.geometry(F.lit("line"), F.array(ring((5, 2), (5, 33), (11, 33)))).alias("px_geom")),
        ))
    ).withColumns({"w": F.lit(64), "h": F.lit(50)})
    upright = R.edge_rows(shapes.where("fid = 'box'"), ["fid"], "px_geom", eights=True)
    assert upright.count() == 2 + 2 * 10
    for width, height in ((None, None), ("w", "h")):
        size = R.outline_runs(shapes, ["w", "h"], height=height)
        if width:
            size = R.clip_runs(size, F.col("w"), F.col("h"))
        want = {r["fid"]: r["pixels"] for r in R.run_sizes(size).collect()}
        got = {r["fid"]: r["pixels"] for r in B.block_sizes(B.outline_blocks(shapes, width=width, height=height)).collect()}
        assert got == want


def test_prefilter_sends_boxes_once_to_an_area(spark):
    rows = [(1, "a", f"f{i}-{j}", x, y, x + 20, y + 20) for i, x in enumerate(range(-195, 205, 20)) for j, y in enumerate(range(-195, 205, 20))]
    wide = [(1, "b", "wide", -4000, -4000, 4000, 4000), (1, "b", "huge", -400_000, 0, 400_000, 10)]
    perf = box_rows(spark, [*rows, *wide, (1, "b", "p", 500, 500, 510, 510), (1, "b", "far", 5000, 5000, 5010, 5010), (None, "a", "n", 0, 0, 9, 9)])
    truth = box_rows(spark, [(1, "a", "g", 1, 1, 9, 9), (1, "b", "t", 3999, -3999, 4050, -3990), (1, "b", "u", 300_000, 12, 300_010, 19), (1, "b", "v", 300_000, 20, 300_010, 29)])
    placed = spatial._in_areas(perf.where("geo_value = 'a' and id is not null"), 20)
    assert placed.count() < 1.2 * len(rows)
    kept = spatial.box_prefilter(perf, truth, ["id", "geo_value"], 20)
    exchanges = [line for line in plan(kept[0]).splitlines() if "Exchange hashpartitioning" in line and "fid" not in line]
    assert any("_ac" in line for line in exchanges) and "_cells" in plan(kept[0])
    near = {f"f{i}-{j}" for i in (9, 10) for j in (9, 10)}
    assert {r["fid"] for r in kept[0].collect()} == near | {"wide", "huge"}
    assert sorted(r["fid"] for r in kept[1].collect()) == ["g", "t", "u"]


def test_legend_items_bring_their_names(spark):
    from cartomark.functions.geometry import USE_SPATIAL_INDEX
    from cartomark.plans import labels

    box = "bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    at = {"a": (0.0, 0.0, 10.0, 10.0), "b": (4.0, 0.0, 14.0, 10.0), "far": (90.0, 90.0, 95.0, 95.0), "none": None}
    features = spark.createDataFrame([("m", k, v) for k, v in at.items()] + [("x", "bare", at["a"])], f"cog_id string, fid string, {box}")
    legend = spark.createDataFrame(
        [("m", "i2", at["a"], "A", None), ("m", "i1", (4.0, 0.0, 14.0, 9.0), "B-1", None), ("m", "i1", (4.0, 0.0, 14.0, 9.0), "", None)],
        f"cog_id string, item string, {box}, abbreviation string, label string",
    )
    before = written(spark, "first-items")
    rows = labels.assign_by_legend(features, legend, 10.0)
    assert len(written(spark, "first-items") - before) == 1
    # An item listed twice labels twice: once by its name, once without one.
    assert sorted((r["fid"], r["geo_value"], r["legend_iou"]) for r in rows.collect() if r["legend_iou"] is not None) == [
        ("a", "A", 100.0), ("b", "B1", 90.0), ("b", USE_SPATIAL_INDEX, 90.0), ("far", "B1", 0.0), ("far", USE_SPATIAL_INDEX, 0.0),
    ]
    assert sorted((r["fid"], r["geo_value"]) for r in rows.collect() if r["legend_iou"] is None) == [("bare", USE_SPATIAL_INDEX), ("none", USE_SPATIAL_INDEX)]


def test_stacks_of_runs_count_as_their_runs(spark):
    perf = box_rows(spark, [(1, "a", "p", -35, -700, 45, 900), (1, "a", "p", 0, 630, 19, 650), (1, "a", "q", 0, 70, 10, 20)])
    truth = box_rows(spark, [(1, "a", "g", 11, -9, 70, 655), (1, "a", "h", 5000, 0, 5010, 9), (1, "a", "g", 0, 0, 1, 1)])
    pairs = spark.createDataFrame([("p", "g"), ("p", "g"), ("q", "g"), ("p", "h"), ("x", "g")], "p_fid string, g_fid string")
    runs, stacks = ([R.box_runs(side, 10.0, stacked=s) for side in (perf, truth)] for s in (False, True))
    # 161 rows of 10 pixels lie in four bands of 64.
    assert stacks[0].where("fid = 'p' and c0 < 0").count() == 4 and runs[0].where("fid = 'p' and c0 < 0").count() == 161
    want = sorted(map(str, R.pixel_scores(pairs, *runs).collect()))
    assert len(want) == 5 and sorted(map(str, R.pixel_scores(pairs, *stacks).collect())) == want
