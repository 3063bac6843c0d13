"""Check queries for geometry, rasters, projections and distances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.functions import nested as N
from cartomark.functions import projection as P
from cartomark.operators import cover, raster, spatial
from cartomark.plans import georef, prepare
from cartomark.workload import logical as L
from cartomark.workload.registry import query
from cartomark.workload.scan_queries import CELLS_SQL, RECORDS_SQL, records

BOXES = L.with_sql(L.BOXES_SQL)


@query(
    "g01_geometry_from_coordinates",
    RECORDS_SQL + """SELECT fid, feature_type AS kind, x0::DOUBLE AS xmin, y0::DOUBLE AS ymin,
      CASE line WHEN 3 THEN x0 ELSE x1 END::DOUBLE AS xmax, CASE line WHEN 3 THEN y0 ELSE y1 END::DOUBLE AS ymax FROM recs WHERE high > 0""",
)
def g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.with_data(N.projected_features(records(spark, sf_dir)))
    geom = prepare.to_geometry(F.col("feature_type"), F.col("rings"))
    boxed = rows.select(F.col("pattern").alias("fid"), geom.alias("geom")).withColumn("b", G.geometry_box(F.col("geom")))
    return boxed.select("fid", "geom.kind", "b.xmin", "b.ymin", "b.xmax", "b.ymax")


@query(
    "g02_break_multi_geometry",
    BOXES + """SELECT fid, part, x0 + part AS x, y0 AS y FROM (SELECT fid, x0, y0, unnest([0, 1]) AS part FROM truth WHERE (x1 - x0) > 180)
      UNION ALL SELECT fid, 0, x0, y0 FROM truth WHERE (x1 - x0) <= 180""",
)
def g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = F.format_string("[%d,%d,9]", "x0", "y0")
    multi = F.format_string("[[%d,%d,9],[%d,%d,9]]", "x0", "y0", F.col("x0") + 1, "y0")
    many = F.expr("(x1 - x0) > 180")
    geojson = F.struct(
        F.when(many, "MultiPoint").otherwise("Point").alias("type"), F.when(many, multi).otherwise(single).alias("coordinates")
    )
    parts = L.truths(spark, sf_dir).select("fid", F.posexplode(N.multi_parts(geojson)).alias("part", "g"))
    flat = N.drop_z(N.geojson_rings(F.col("g"), F.lit("point")))
    return parts.select("fid", "part", flat[0][0].alias("p")).select(
        "fid", "part", F.col("p")[0].cast("bigint").alias("x"), F.col("p")[1].cast("bigint").alias("y")
    )


def transform(spark: SparkSession) -> F.Column:
    values = {"a": 2.0, "b": 0.5, "c": 100.0, "d": 0.25, "e": -2.0, "f": 5000.0}
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])


@query(
    "g03_pixel_and_coordinate",
    BOXES + """SELECT fid, 2.0::DOUBLE * (x0 + 0.5) + 0.5::DOUBLE * (y0 + 0.5) + 100 AS x, 0.25::DOUBLE * (x0 + 0.5) - 2.0::DOUBLE * (y0 + 0.5) + 5000 AS y,
      y0 AS back_row, x0 AS back_col FROM truth""",
)
def g03(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = transform(spark)
    at = L.truths(spark, sf_dir).select("fid", G.pixel_to_coord(t, F.col("y0"), F.col("x0")).alias("p"))
    back = at.select("fid", "p", G.coord_to_pixel(t, F.col("p.x"), F.col("p.y")).alias("b"))
    return back.select("fid", "p.x", "p.y", F.col("b.row").alias("back_row"), F.col("b.col").alias("back_col"))


@query(
    "g04_box_to_coordinates",
    BOXES + """SELECT fid, CASE WHEN x0 % 400 <> 0 THEN least(2.0::DOUBLE * (x0 + 0.5) + 0.5::DOUBLE * (y0 + 0.5) + 100, 2.0::DOUBLE * (x1 + 0.5) + 0.5::DOUBLE * (y1 + 0.5) + 100) END AS xmin,
      CASE WHEN x0 % 400 <> 0 THEN greatest(0.25::DOUBLE * (x0 + 0.5) - 2.0::DOUBLE * (y0 + 0.5) + 5000, 0.25::DOUBLE * (x1 + 0.5) - 2.0::DOUBLE * (y1 + 0.5) + 5000) END AS ymax FROM truth""",
)
def g04(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = F.when(F.col("x0") % 400 != 0, F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]))
    out = L.truths(spark, sf_dir).select("fid", G.pixel_box_to_coord(transform(spark), px).alias("b"))
    return out.select("fid", "b.xmin", "b.ymax")


@query("g05_box_cell_cover", CELLS_SQL + "SELECT fid, fine_cell FROM cells")
def g05(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = spatial.with_cells(L.truths(spark, sf_dir).select("fid", "bbox"), L.CELL, L.COARSE_LEVELS)
    return covered.select("fid", F.explode("fine_cells").alias("fine_cell"))


@query("g05_ring_cell_cover", CELLS_SQL + "SELECT fid, fine_cell FROM cells")
def g05_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rings = G.geometry(F.lit("polygon"), F.array(G.box_ring(F.col("bbox"))))
    shapes = L.truths(spark, sf_dir).select("fid", rings.alias("geom"))
    return cover.base_cells(cover.compact_cover(shapes, L.CELL)).withColumnRenamed("cell", "fine_cell")


SLANTED_SQL = BOXES + f""",
t AS (SELECT fid, x0 / {L.CELL}::DOUBLE AS a, y0 / {L.CELL}::DOUBLE AS b,
        (x1 + CASE WHEN (x0 // 100 + y0) % 97 = 0 THEN 40000 ELSE 300 END) / {L.CELL}::DOUBLE AS c,
        (y1 + CASE WHEN (x0 // 100 + y0) % 97 = 0 THEN 30000 ELSE 500 END) / {L.CELL}::DOUBLE AS d FROM truth),
r AS (SELECT *, unnest(range(floor(b)::BIGINT, floor(d)::BIGINT + 1)) AS "row" FROM t)
SELECT fid, sum(floor(greatest(a, c + (greatest(b, "row"::DOUBLE) - b) * (a - c) / (d - b)))::BIGINT - floor(a)::BIGINT + 1)::BIGINT AS n_cells, true AS is_compact
FROM r GROUP BY fid
"""


@query("g05_slanted_compact_cover", SLANTED_SQL)
def g05_slanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right triangles, one in a hundred as wide as a map: base cells held, in rows that grow with the outline."""
    grown = F.expr("(x0 div 100 + y0) % 97 = 0")
    rows = L.truths(spark, sf_dir).withColumns(
        {"x1": F.col("x1") + F.when(grown, 40000).otherwise(300), "y1": F.col("y1") + F.when(grown, 30000).otherwise(500)}
    )
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x0, y1), (x0, y0))])
    shapes = rows.select("fid", G.geometry(F.lit("polygon"), F.array(ring)).alias("geom"), ((x1 - x0 + y1 - y0) / L.CELL).alias("outline"))
    cells = cover.compact_cover(shapes, L.CELL).groupBy("fid").agg(
        F.sum(F.pow(F.lit(4), F.col("level"))).cast("bigint").alias("n_cells"), F.count(F.lit(1)).alias("n_rows")
    )
    return cells.join(shapes.select("fid", "outline"), "fid").select("fid", "n_cells", (F.col("n_rows") <= 12 * F.col("outline") + 24).alias("is_compact"))


@query(
    "g06_box_iou",
    BOXES + """SELECT a.fid, (2 * inter * 100000 + uni) // (2 * uni) AS iou_units, ((2 * inter * 100000 + uni) // (2 * uni)) / 1000.0::DOUBLE AS iou FROM (
      SELECT fid, greatest(least(x1, x0 + 150) - x0, 0) * greatest(least(y1, y0 + 110) - y0, 0) AS inter,
       (x1 - x0) * (y1 - y0) + 150 * 110 - greatest(least(x1, x0 + 150) - x0, 0) * greatest(least(y1, y0 + 110) - y0, 0) AS uni FROM truth) a""",
)
def g06(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = G.box(F.col("x0"), F.col("y0"), F.col("x0") + 150, F.col("y0") + 110)
    units = G.box_iou_units(F.col("bbox"), other)
    return L.truths(spark, sf_dir).select("fid", units.alias("iou_units"), G.iou_percent(units).alias("iou"))


RUNS_SQL = BOXES + f"""SELECT fid, unnest(range(y0 // {L.PIXEL}, y1 // {L.PIXEL} + 1)) AS "row", x0 // {L.PIXEL} AS c0, x1 // {L.PIXEL} AS c1 FROM truth"""


@query("g07_rasterise_boxes", RUNS_SQL)
def g07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.box_runs(L.truths(spark, sf_dir), L.PIXEL)


@query("g07_rasterise_rings", RUNS_SQL)
def g07_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bbox")
    pixel = G.box(*[F.floor(b[c] / L.PIXEL) for c in ("xmin", "ymin", "xmax", "ymax")])
    geom = G.geometry(F.lit("polygon"), F.array(G.box_ring(pixel)))
    return raster.outline_runs(L.truths(spark, sf_dir).select("fid", geom.alias("px_geom")))


@query(
    "g07_rasterise_lines",
    BOXES + f"""SELECT fid, unnest(range(y0 // {L.PIXEL}, y1 // {L.PIXEL} + 1)) AS "row", x0 // {L.PIXEL} AS c0, x0 // {L.PIXEL} AS c1 FROM truth""",
)
def g07_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bbox")
    px = {c: F.floor(b[c] / L.PIXEL).cast("double") for c in ("xmin", "ymin", "ymax")}
    ends = F.array(
        F.struct(px["xmin"].alias("x"), px["ymin"].alias("y")), F.struct(px["xmin"].alias("x"), px["ymax"].alias("y"))
    )
    shapes = L.truths(spark, sf_dir).select("fid", G.geometry(F.lit("line"), F.array(ends)).alias("px_geom"))
    return raster.outline_runs(shapes)


POINT_SCALE, POINT_BUFFER, POINT_CELL = 24000, 0.001, 4.0


@query(
    "g08_buffered_point_iou",
    f"""WITH pts AS (SELECT event_id AS fid, event_type AS label, value AS x, user_id::DOUBLE AS y FROM events),
    r AS (SELECT {POINT_SCALE} * {POINT_BUFFER}::DOUBLE / 39.37::DOUBLE AS r),
    d AS (SELECT p.fid AS p_fid, g.fid AS g_fid, sqrt((p.x - g.x) * (p.x - g.x) + (p.y - g.y) * (p.y - g.y)) AS d, r
      FROM pts p JOIN pts g ON p.label = g.label AND p.fid % 2 = 1 AND g.fid % 2 = 0 AND abs(p.x - g.x) <= 2 AND abs(p.y - g.y) <= 2, r),
    i AS (SELECT *, r * r * 2.0::DOUBLE * acos(least(d / (r * 2.0::DOUBLE), 1.0)) - d / 2.0::DOUBLE * sqrt(greatest(r * r * 4.0::DOUBLE - d * d, 0.0)) AS inter FROM d WHERE d < 2 * r)
    SELECT p_fid, g_fid, floor(inter / (r * r * {2.0 * 3.141592653589793}::DOUBLE - inter) * 100000 + 0.5)::BIGINT AS iou_units FROM i""",
)
def g08(spark: SparkSession, sf_dir: str) -> DataFrame:
    radius = G.buffer_radius(F.lit(POINT_SCALE), POINT_BUFFER)
    pts = L.points(spark, sf_dir)
    bbox = G.grown_box(G.box(F.col("x"), F.col("y"), F.col("x"), F.col("y")), radius)
    pts = pts.withColumn("bbox", bbox).withColumnRenamed("geo_value", "label")
    pairs = spatial.spatial_pairs(
        pts.where("not is_truth").drop("is_truth"), pts.where("is_truth").drop("is_truth"), ["label"], POINT_CELL
    )
    dx, dy = F.col("p_x") - F.col("g_x"), F.col("p_y") - F.col("g_y")
    near = pairs.withColumn("d", F.sqrt(dx * dx + dy * dy)).where(F.col("d") < radius * 2.0)
    return near.select("p_fid", "g_fid", G.disc_iou_units(F.col("d"), radius).alias("iou_units"))


LATLON = {"lat": "(l_extendedprice / 600.0::DOUBLE) - 85", "lon": "l_quantity * 7.0::DOUBLE - 177"}


def latlon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        (F.col("l_extendedprice") / 600.0 - 85).alias("lat"),
        (F.col("l_quantity") * 7.0 - 177).alias("lon"),
    )


@query(
    "g09_utm_zone",
    f"""SELECT l_orderkey, l_partkey, CASE WHEN lat < -80 OR lat > 84 THEN NULL ELSE 'epsg:' || CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END +
      CASE WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32
           WHEN lat >= 72 AND lon >= 0 AND lon < 9 THEN 31 WHEN lat >= 72 AND lon >= 9 AND lon < 21 THEN 33
           WHEN lat >= 72 AND lon >= 21 AND lon < 33 THEN 35 WHEN lat >= 72 AND lon >= 33 AND lon < 42 THEN 37
           ELSE CAST(floor((lon + 180) / 6) AS INTEGER) % 60 + 1 END AS VARCHAR) END AS epsg
    FROM (SELECT l_orderkey, l_partkey, {LATLON['lat']} AS lat, {LATLON['lon']} AS lon FROM lineitem)""",
)
def g09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latlon(spark, sf_dir).select(
        "l_orderkey", "l_partkey", P.utm_epsg(F.col("lat"), F.col("lon")).alias("epsg")
    )


@query(
    "g10_reproject_round_trip",
    f"""SELECT l_orderkey, l_partkey, round(lat, 7) AS lat, round(lon, 7) AS lon FROM
      (SELECT l_orderkey, l_partkey, {LATLON['lat']} AS lat, {LATLON['lon']} AS lon FROM lineitem) WHERE lat BETWEEN -80 AND 84""",
)
def g10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latlon(spark, sf_dir).where("lat between -80 and 84")
    code = P.epsg_code(P.utm_epsg(F.col("lat"), F.col("lon")))
    there = rows.withColumn("code", code).withColumn("u", P.wgs84_to_utm(F.col("lat"), F.col("lon"), F.col("code")))
    back = there.withColumn("b", P.utm_to_wgs84(F.col("u.x"), F.col("u.y"), F.col("code")))
    return back.select("l_orderkey", "l_partkey", F.round("b.y", 7).alias("lat"), F.round("b.x", 7).alias("lon"))


@query(
    "g11_crs_facts",
    """SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'epsg:4326' WHEN 1 THEN 'epsg:32612' WHEN 2 THEN '+proj=lcc +units=us-ft +no_defs' ELSE '+proj=lcc +units=m' END AS epsg,
      CASE s_suppkey % 4 WHEN 0 THEN 'degrees' WHEN 2 THEN 'U.S. Surveyor''s Foot' ELSE 'metre' END AS unit, s_suppkey % 4 <> 1 AS needs_reprojection FROM supplier""",
)
def g11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("s_suppkey") % 4
    crs = (
        F.when(kind == 0, "EPSG:4326").when(kind == 1, "EPSG:32612")
        .when(kind == 2, "+proj=lcc +units=us-ft +no_defs").otherwise("+proj=lcc +units=m")
    )
    return L.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), P.crs_facts(crs).alias("f")).select("id", "f.*")


@query(
    "g12_haversine_distance",
    f"""SELECT l_orderkey, l_partkey, round(2 * 6371.0088::DOUBLE * asin(sqrt(least(sin((p2 - p1) / 2) ** 2 + cos(p1) * cos(p2) * sin(radians(1.5) / 2) ** 2, 1.0))), 6) AS km
    FROM (SELECT l_orderkey, l_partkey, radians({LATLON['lat']}) AS p1, radians({LATLON['lat']} + 0.75) AS p2 FROM lineitem)""",
)
def g12(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = F.col("lat"), F.col("lon")
    km = G.haversine_km(lat, lon, lat + 0.75, lon + 1.5)
    return latlon(spark, sf_dir).select("l_orderkey", "l_partkey", F.round(km, 6).alias("km"))


@query(
    "g12_antipodal_distance",
    "SELECT c_custkey AS id, 20003.93146::DOUBLE AS km, true AS is_shorter FROM customer",
)
def g12_antipodal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's place to its antipode, which is half a meridian away, and to a point a tenth of a degree beside it."""
    key = F.col("c_custkey")
    lat, lon = (key * 31 % 17_000) / 100.0 - 85.0, (key * 7919 % 36_000) / 100.0 - 180.0
    # A small file is read by few tasks, and a distance takes long: rows are dealt out first.
    places = L.table(spark, sf_dir, "customer").select(key.alias("id"), lat.alias("lat"), lon.alias("lon"))
    places = places.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    lat, lon = F.col("lat"), F.col("lon")
    far = G.geodesic_km(lat, lon, -lat, lon + 180.0, near_antipode=True)
    beside = G.geodesic_km(lat, lon, -lat + 0.1, lon + 180.1, near_antipode=True)
    # Both stand in one array, so that each is computed once however often it is read.
    both = places.select("id", F.explode(F.array(F.struct(far.alias("far"), beside.alias("beside")))).alias("d"))
    far, beside = F.col("d.far"), F.col("d.beside")
    return both.select("id", F.round(far, 5).alias("km"), ((beside < far) & (beside > far - 25)).alias("is_shorter"))


@query("g12_geodesic_distance")
def g12_geodesic(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = F.col("lat"), F.col("lon")
    km = G.geodesic_km(lat, lon, lat + 0.75, lon + 1.5)
    return latlon(spark, sf_dir).select("l_orderkey", "l_partkey", F.round(km, 6).alias("km"))


@query(
    "g13_sampled_pixel_table",
    """WITH r AS (SELECT s_suppkey AS id, unnest(range(1, 61 + s_suppkey % 9)) AS v FROM supplier),
    c AS (SELECT s_suppkey AS id, unnest(range(1, 91 + s_suppkey % 5)) AS v FROM supplier),
    rr AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY md5('42|' || id || '|row|' || v)) AS k FROM r),
    cc AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY md5('42|' || id || '|col|' || v)) AS k FROM c)
    SELECT id, k, round(-110.0::DOUBLE + (cc.v + 0.5) * 0.01::DOUBLE, 9) AS x, round(35.0::DOUBLE - (rr.v + 0.5) * 0.01::DOUBLE, 9) AS y,
      'epsg:' || (32600 + CAST(floor((-110.0::DOUBLE + (cc.v + 0.5) * 0.01::DOUBLE + 180) / 6) AS INTEGER) + 1) AS proj_epsg, false AS same_epsgs
    FROM rr JOIN cc USING (id, k) WHERE k <= 10""",
)
def g13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = georef.sampled_points(sample_rasters(spark, sf_dir))
    return rows.select(
        "id", "k", F.round("orig_pnt.x", 9).alias("x"), F.round("orig_pnt.y", 9).alias("y"), "proj_epsg", "same_epsgs"
    )


def sample_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small raster in degrees per supplier."""
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (0.01, 0.0, -110.0, 0.0, -0.01, 35.0))])
    return L.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_suppkey") % 9 + 60).alias("height"),
        (F.col("s_suppkey") % 5 + 90).alias("width"),
        t.alias("transform"),
        F.lit("EPSG:4326").alias("crs"),
    )


@query(
    "g14_pixel_grid",
    """SELECT id, "row"::INTEGER AS "row", col::INTEGER AS col, 2.0::DOUBLE * (col + 0.5) + 0.5::DOUBLE * ("row" + 0.5) + 100 AS x, 0.25::DOUBLE * (col + 0.5) - 2.0::DOUBLE * ("row" + 0.5) + 5000 AS y
    FROM (SELECT id, "row", unnest(range(0, w)) AS col FROM (SELECT s_suppkey AS id, 8 + s_suppkey % 5 AS w, unnest(range(0, 6 + s_suppkey % 7)) AS "row" FROM supplier))""",
)
def g14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rasters = L.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_suppkey") % 7 + 6).alias("height"),
        (F.col("s_suppkey") % 5 + 8).alias("width"),
        transform(spark).alias("transform"),
    )
    return raster.pixel_grid(rasters, band_rows=4)
