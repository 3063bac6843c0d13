import random

from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.operators import raster as R


def pixels(runs):
    return {(r.fid, r.row, r.col) for r in R.run_pixels(runs).select("fid", "row", "col").collect()}


def shapes(spark, kind, rows):
    depth = "array<array<array<double>>>" if kind == "polygon" else "array<array<double>>"
    df = spark.createDataFrame(rows, f"fid string, c {depth}")
    return df.select("fid", G.geometry_from_pairs(kind, F.col("c")).alias("px_geom"))


def inside(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 <= y < y2) or (y2 <= y < y1):
            if x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                hit = not hit
    return hit


def test_polygon_fill_against_point_test(spark):
    rng = random.Random(5)
    rings = {}
    for i in range(12):
        rings[f"p{i}"] = [[float(rng.randrange(0, 25)), float(rng.randrange(0, 25))] for _ in range(rng.randrange(3, 7))]
    got = pixels(R.outline_runs(shapes(spark, "polygon", [(k, [v]) for k, v in rings.items()])))
    for fid, ring in rings.items():
        mine = {(r, c) for f, r, c in got if f == fid}
        want = {(y, x) for y in range(26) for x in range(26) if inside([tuple(p) for p in ring], x, y)}
        assert want <= mine
        for x, y in ring:
            assert (int(y), int(x)) in mine
        # Anything beyond the inside is within one pixel of an edge.
        for y, x in mine - want:
            near = min(
                _distance(x, y, a, b) for a, b in zip(ring, ring[1:] + ring[:1])
            )
            assert near <= 0.7072


def _distance(px, py, a, b):
    (x1, y1), (x2, y2) = a, b
    dx, dy = x2 - x1, y2 - y1
    t = 0.0 if dx == dy == 0 else max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
    return ((px - x1 - t * dx) ** 2 + (py - y1 - t * dy) ** 2) ** 0.5


def test_hole_is_left_out(spark):
    ring = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0]]
    hole = [[3.0, 3.0], [7.0, 3.0], [7.0, 7.0], [3.0, 7.0]]
    got = pixels(R.outline_runs(shapes(spark, "polygon", [("h", [ring, hole])])))
    assert ("h", 5, 5) not in got and ("h", 3, 5) in got and ("h", 1, 1) in got
    assert len(got) == 121 - 9


def test_line_covers_all_segments(spark):
    got = pixels(R.outline_runs(shapes(spark, "line", [("l", [[0.0, 0.0], [5.0, 0.0], [5.0, 4.0]])])))
    assert got == {("l", 0, c) for c in range(6)} | {("l", r, 5) for r in range(5)}


def test_buffer_equals_distance_test(spark):
    line = [[2.0, 3.0], [12.0, 7.0], [12.0, 15.0]]
    df = shapes(spark, "line", [("l", line)]).withColumn("r", F.lit(2.3))
    got = {(r, c) for _, r, c in pixels(R.buffer_runs(df, "r"))}
    want = {
        (y, x)
        for y in range(-3, 22)
        for x in range(-3, 22)
        if min(_distance(x, y, a, b) for a, b in zip(line, line[1:])) <= 2.3
    }
    assert got == want
    dot = spark.createDataFrame(
        [("d", [5.0, 5.0])], "fid string, c array<double>"
    ).select("fid", G.geometry_from_pairs("point", F.col("c")).alias("px_geom"), F.lit(1.5).alias("r"))
    assert {(r, c) for _, r, c in pixels(R.buffer_runs(dot, "r"))} == {
        (y, x) for y in range(12) for x in range(12) if (y - 5) ** 2 + (x - 5) ** 2 <= 2.25
    }


def test_clip(spark):
    runs = spark.createDataFrame([("a", -1, 0, 5), ("a", 0, -3, 2), ("a", 1, 8, 20), ("a", 9, 0, 1)], "fid string, row long, c0 long, c1 long")
    got = R.clip_runs(runs, F.lit(10), F.lit(5)).orderBy("row").collect()
    assert [(r.row, r.c0, r.c1) for r in got] == [(0, 0, 2), (1, 8, 9)]


def test_f1_messages(spark):
    rows = [("ok", 2, 4, 4), ("none", 0, 4, 4), ("p", 0, 0, 4), ("g", 0, 4, 0), ("both", 0, 0, 0)]
    df = spark.createDataFrame(rows, "k string, true_positives long, len_pdf long, len_gdf long")
    got = {r.k: (r.precision, r.recall, r.f1, r.f1_message) for r in R.with_f1(df).collect()}
    assert got == {
        "ok": (0.5, 0.5, 0.5, "success-f1"),
        "none": (0.0, 0.0, 0.0, "no-overlap"),
        "p": (0.0, 0.0, 0.0, "zero-p_df"),
        "g": (0.0, 0.0, 0.0, "zero-g_df"),
        "both": (0.0, 0.0, 0.0, "zero-p_df & g_df"),
    }


def test_overlap_is_the_same_under_repartition(spark):
    ring = [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 9.0]]
    other = [[5.0, 5.0], [14.0, 5.0], [14.0, 14.0], [5.0, 14.0]]
    runs = R.outline_runs(shapes(spark, "polygon", [("p", [ring]), ("g", [other])]))
    pairs = spark.createDataFrame([("p", "g")], "p_fid string, g_fid string")
    for n in (1, 7):
        got = R.pixel_scores(pairs, runs.repartition(n), runs.repartition(n)).first()
        assert (got.true_positives, got.len_pdf, got.len_gdf, got.f1) == (25, 100, 100, 0.25)


def test_pixel_grid_counts(spark):
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (1.0, 0.0, 0.0, 0.0, -1.0, 10.0))])
    rasters = spark.createDataFrame([(1, 7, 5)], "id int, width int, height int").withColumn("transform", t)
    got = R.pixel_grid(rasters, band_rows=2).collect()
    assert len({(r.row, r.col) for r in got}) == 35
    assert {(r.x, r.y) for r in got if r.row == 4 and r.col == 6} == {(6.5, 5.5)}


def test_shapes_far_outside_the_image_are_cut_first(spark):
    far = 1e12
    ring = [[2.0, -far], [6.0, -far], [6.0, far], [2.0, far], [2.0, -far]]
    px = shapes(spark, "polygon", [("tall", [ring])]).withColumn("height", F.lit(5))
    assert {r for _, r, _ in pixels(R.outline_runs(px, ["height"], height="height"))} == set(range(5))
    line = shapes(spark, "line", [("l", [[3.0, -far], [3.0, far]])]).withColumns({"height": F.lit(4), "r": F.lit(1.0)})
    assert {r for _, r, _ in pixels(R.buffer_runs(line, "r", ["height"], height="height"))} == set(range(4))
