import math
import random

import pytest
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions import grid
from cartomark.functions import projection as P


def one(spark, **cols):
    row = spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()
    return row[0] if len(cols) == 1 else row


def interleave(x, y):
    return sum(((x >> k) & 1) << (2 * k) | ((y >> k) & 1) << (2 * k + 1) for k in range(31))


def test_morton_interleaves_bits(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(2**31), rng.randrange(2**31)) for _ in range(50)] + [(0, 0), (2**31 - 1, 2**31 - 1)]
    df = spark.createDataFrame(pairs, "x long, y long")
    for r in df.select("x", "y", grid.morton(F.col("x"), F.col("y")).alias("z")).collect():
        assert r.z == interleave(r.x, r.y)


def test_parent_of_negative_cells(spark):
    rng = random.Random(4)
    pts = [(rng.uniform(-1e4, 1e4), rng.uniform(-1e4, 1e4)) for _ in range(60)]
    df = spark.createDataFrame(pts, "x double, y double")

    def cell(size):
        return grid.cell_id(grid.axis_cell(F.col("x"), size), grid.axis_cell(F.col("y"), size))

    fine, coarse = cell(10.0), cell(80.0)
    rows = df.select(grid.parent_cell(fine, 3).alias("up"), fine.alias("fine"), coarse.alias("coarse")).collect()
    # Equal coarse cells have equal parents and the other way round.
    assert len({(r.up, r.coarse) for r in rows}) == len({r.up for r in rows}) == len({r.coarse for r in rows})


def test_box_iou_cases(spark):
    def b(*v):
        return G.box(*[F.lit(float(x)) for x in v])

    a = b(0, 0, 10, 10)
    cases = {
        "equal": (a, 100_000),
        "contained": (b(0, 0, 5, 10), 50_000),
        "shifted": (b(5, 0, 15, 10), 33_333),
        "disjoint": (b(20, 20, 30, 30), 0),
        "empty": (b(1, 1, 1, 1), 0),
    }
    for other, units in cases.values():
        assert one(spark, u=G.box_iou_units(a, other)) == units
        assert one(spark, u=G.box_iou_units(other, a)) == units
    assert one(spark, u=G.box_iou_units(b(1, 1, 1, 1), b(1, 1, 1, 1))) == 0
    assert one(spark, u=G.iou_percent(G.box_iou_units(a, cases["shifted"][0]))) == 33.333


def test_strict_overlap_is_false_for_cover(spark):
    def b(*v):
        return G.box(*[F.lit(float(x)) for x in v])

    a = b(0, 0, 10, 10)
    got = one(
        spark,
        equal=G.boxes_overlap(a, a),
        inside=G.boxes_overlap(a, b(2, 2, 3, 3)),
        partly=G.boxes_overlap(a, b(5, 5, 15, 15)),
        touching=G.boxes_overlap(a, b(10, 0, 20, 10)),
        closed=G.boxes_intersect(a, b(10, 0, 20, 10)),
    )
    assert tuple(got) == (False, False, True, False, True)


def test_affine_round_trip(spark):
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.5, 0.1, 10.0, -0.2, -0.5, 90.0))])
    at = G.pixel_to_coord(t, F.lit(7), F.lit(12))
    back = one(spark, b=G.coord_to_pixel(t, at["x"], at["y"]))
    assert (back.row, back.col) == (7, 12)
    flat = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (1.0, 2.0, 0.0, 2.0, 4.0, 0.0))])
    assert one(spark, b=G.coord_to_pixel(flat, F.lit(1.0), F.lit(1.0))).row is None


def test_pixel_box_without_four_values_is_null(spark):
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (1.0, 0.0, 0.0, 0.0, -1.0, 0.0))])
    px = F.array(*[F.lit(float(v)) for v in (1, 2, 3, 4)])
    got = one(spark, a=G.pixel_box_to_coord(t, px), b=G.pixel_box_to_coord(t, F.lit(None).cast("array<double>")))
    assert tuple(got.a) == (1.5, -4.5, 3.5, -2.5)
    assert got.b is None


def test_disc_lens(spark):
    r = F.lit(2.0)
    got = one(
        spark,
        same=G.disc_iou_units(F.lit(0.0), r),
        apart=G.disc_iou_units(F.lit(4.0), r),
        half=G.disc_intersection_area(F.lit(2.0), r),
    )
    assert got.same == 100_000 and got.apart == 0
    assert got.half == pytest.approx(8 * math.acos(0.5) - math.sqrt(12), rel=1e-12)


def test_segment_distance(spark):
    s = F.struct(*[F.lit(v).alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), (0.0, 0.0, 10.0, 0.0))])
    dot = F.struct(*[F.lit(v).alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), (1.0, 1.0, 1.0, 1.0))])
    got = one(
        spark,
        a=G.segment_distance(F.lit(5.0), F.lit(3.0), s),
        b=G.segment_distance(F.lit(13.0), F.lit(4.0), s),
        c=G.segment_distance(F.lit(1.0), F.lit(3.0), dot),
    )
    assert tuple(got) == (3.0, 5.0, 2.0)


@pytest.mark.parametrize(
    "line, km",
    [
        # Published Vincenty and geodesic test lines.
        ((50.06632, -5.71475, 58.64402, -3.07009), 969.954166),
        ((0.0, 0.0, 0.0, 1.0), 111.319491),
        ((-33.8568, 151.2153, -33.8568, 151.2153), 0.0),
        ((0.0, 0.0, 90.0, 0.0), 10001.965729),
    ],
)
def test_geodesic_lines(spark, line, km):
    got = one(spark, d=G.geodesic_km(*[F.lit(v) for v in line]))
    assert got == pytest.approx(km, abs=1e-5)


def test_geodesic_near_antipode_is_null_or_close(spark):
    got = one(spark, d=G.geodesic_km(F.lit(0.0), F.lit(0.0), F.lit(0.5), F.lit(179.7)))
    assert got is None or got == pytest.approx(19936.288579, abs=1e-3)


def test_utm_control_points(spark):
    # CN tower: 17T 630084 4833438 (published).
    lat, lon = F.lit(43.642567), F.lit(-79.387139)
    epsg = P.utm_epsg(lat, lon)
    xy = one(spark, e=P.wgs84_to_utm(lat, lon, P.epsg_code(epsg)))
    assert xy.x == pytest.approx(630084.30, abs=0.01)
    assert xy.y == pytest.approx(4833438.59, abs=0.01)
    # On a central meridian at the equator the false origin comes back.
    origin = one(spark, e=P.wgs84_to_utm(F.lit(0.0), F.lit(3.0), F.lit(32631)))
    assert (origin.x, origin.y) == pytest.approx((500000.0, 0.0), abs=1e-6)


def test_utm_zone_exceptions(spark):
    pts = {
        (60.0, 5.0): "epsg:32632",
        (75.0, 8.0): "epsg:32631",
        (75.0, 10.0): "epsg:32633",
        (75.0, 30.0): "epsg:32635",
        (75.0, 40.0): "epsg:32637",
        (-33.9, 151.2): "epsg:32756",
        (10.0, 180.0): "epsg:32601",
        (85.0, 0.0): None,
    }
    df = spark.createDataFrame(list(pts), "lat double, lon double")
    for r in df.select("lat", "lon", P.utm_epsg(F.col("lat"), F.col("lon")).alias("e")).collect():
        assert r.e == pts[(r.lat, r.lon)]


def test_units_and_crs(spark):
    assert one(spark, u=P.unit_lookup(F.lit("ft"))) == 0.3048
    assert one(spark, u=P.unit_lookup(F.lit("nope"))) is None
    facts = one(spark, f=P.crs_facts(F.lit("+proj=tmerc +units=ch")))
    assert tuple(facts) == ("+proj=tmerc +units=ch", "International Chain", True)
    assert tuple(one(spark, f=P.crs_facts(F.lit("EPSG:32612")))) == ("epsg:32612", "metre", False)
