import math

from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions import projection as P
from cartomark.plans import evaluate, prepare


def geom_of(kind, points):
    return G.geometry(F.lit(kind), F.array(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in points])))


def test_long_edges_stay_within_the_tolerance(spark):
    a, b, tol = (200_000.0, 4_000_000.0), (780_000.0, 4_300_000.0), 1e-4
    one = spark.range(1).select(prepare.reproject_edges(geom_of("line", [a, b]), F.lit(32612), F.lit(4326), tol).alias("g"), prepare.reproject_edges(geom_of("line", [a, b]), F.lit(32612), F.lit(32612), tol).alias("same")).first()
    assert [tuple(p) for p in one.same.rings[0]] == [a, b]
    ring = [tuple(p) for p in one.g.rings[0]]
    assert 10 < len(ring) < 400
    points = spark.range(2001).select((F.col("id") / 2000).alias("t"))
    x, y = (F.lit(p) + (F.lit(q) - F.lit(p)) * F.col("t") for p, q in zip(a, b, strict=True))
    walked = points.select(P.utm_to_wgs84(x, y, F.lit(32612)).alias("p")).select("p.*").collect()

    def off(p):
        best = math.inf
        for (x0, y0), (x1, y1) in zip(ring, ring[1:], strict=False):
            t = max(0.0, min(1.0, ((p[0] - x0) * (x1 - x0) + (p[1] - y0) * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2)))
            best = min(best, math.hypot(x0 + t * (x1 - x0) - p[0], y0 + t * (y1 - y0) - p[1]))
        return best

    assert max(off(tuple(p)) for p in walked[::20]) < 1.3 * tol
    straight = [ring[0], ring[-1]]
    middle = tuple(walked[1000])
    assert math.hypot((straight[0][0] + straight[1][0]) / 2 - middle[0], (straight[0][1] + straight[1][1]) / 2 - middle[1]) > 100 * tol


def test_features_move_into_the_truths_system_and_others_are_reported(spark):
    box = [(-111.5, 39.0), (-111.0, 39.0), (-111.0, 39.4), (-111.5, 39.4), (-111.5, 39.0)]
    rows = spark.createDataFrame([("m", "a", "epsg:4326"), ("m", "b", "epsg:3857"), ("n", "c", None), ("o", "d", "epsg:4326")], "id string, fid string, epsg string")
    perf = rows.withColumn("geom", geom_of("polygon", box)).withColumn("bbox", G.geometry_box(F.col("geom")))
    truth = spark.createDataFrame([("m", "epsg:32612"), ("m", "epsg:32612"), ("n", "epsg:32612")], "id string, epsg string")
    moved = prepare.into_systems(perf, truth)
    assert moved.columns == perf.columns
    got = {r.fid: r for r in moved.collect()}
    assert got["a"].epsg == "epsg:32612" and len(got["a"].geom.rings[0]) > 5
    assert 400_000 < got["a"].bbox.xmin < got["a"].bbox.xmax < 520_000 and got["a"].bbox.ymax > 4_360_000
    assert [got[f].epsg for f in "bcd"] == ["epsg:3857", None, "epsg:4326"] and got["b"].bbox.xmin == -111.5
    assert [tuple(r) for r in evaluate.crs_mismatches(moved, truth).collect()] == [("m", "epsg:3857", "epsg:32612")]


def test_points_and_empty_shapes(spark):
    point = prepare.reproject_edges(geom_of("point", [(-111.0, 39.0)]), F.lit(4326), F.lit(32612), 0.1)
    empty = prepare.reproject_edges(G.geometry(F.lit("line"), F.array().cast("array<array<struct<x:double,y:double>>>")), F.lit(4326), F.lit(32612), 0.1)
    row = spark.range(1).select(point.alias("p"), empty.alias("e")).first()
    assert abs(row.p.rings[0][0].x - 500_000) < 1e-6 and row.e.rings == []
