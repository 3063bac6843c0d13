import math

from cartomark.functions import geometry as G

#: lat1, lon1, lat2, lon2 and the published distance in metres.
PUBLISHED = [
    (-30.0, 0.0, 29.9, 179.8, 19_989_832.827610),
    (29.9, 179.8, -30.0, 0.0, 19_989_832.827610),
    (30.0, 10.0, -29.9, -169.8, 19_989_832.827610),
    (0.0, 0.0, 0.5, 179.5, 19_936_288.578965),
    (0.0, 0.0, 0.0, 180.0, 20_003_931.458625),
    (90.0, 0.0, -90.0, 0.0, 20_003_931.458625),
    (45.0, 20.0, -45.0, -160.0, 20_003_931.458625),
]


def test_points_near_the_antipode_have_their_published_distance(spark):
    df = spark.createDataFrame(PUBLISHED, "a double, b double, c double, d double, want double")
    for row in df.withColumn("km", G.geodesic_km(df.a, df.b, df.c, df.d, near_antipode=True)).collect():
        assert row.km is not None and abs(row.km * 1000 - row.want) < 1e-3, row


def test_every_finite_pair_has_a_distance_and_neighbours_agree(spark):
    rows = [(float(lat), 0.0, -lat + dy, 180.0 - dx) for lat in (-60, -30, -5, 0, 5, 45, 89) for dy in (-0.4, 0.0, 0.3) for dx in (0.0, 0.1, 0.59, 0.62, 1.5)]
    rows = [r for r in rows if abs(r[2]) <= 90]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    for r in df.withColumn("km", G.geodesic_km(df.a, df.b, df.c, df.d, near_antipode=True)).withColumn("moved", G.geodesic_km(df.a, df.b, df.c, df.d - 1e-7, near_antipode=True)).collect():
        # No distance is beyond half a meridian, and a step of a centimetre changes it by no more.
        assert 19_000 < r.km <= 20_003.931459 and math.isclose(r.km, r.moved, abs_tol=2e-5), r
