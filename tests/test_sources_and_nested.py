import json

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from cartomark import schemas
from cartomark.functions import nested as N
from cartomark.operators import cover
from cartomark.plans import prepare
from cartomark.sources import manifest, readers, writers
from helpers import plan_of


def record(**over):
    base = {
        "cog_id": "c", "system": "sys", "system_version": "1", "legend_id": "c_sys_1_k_Qal_old",
        "legend_item": {"abbreviation": "Q", "pattern": "p", "color": "red", "px_bbox": [1, 2, 3, 4]},
        "projected_feature": [], "px_bbox": [5, 6, 7, 8],
        "px_geojson": {"type": "Point", "coordinates": [1, 2]},
    }
    return {**base, **over}


def features_of(*geojsons):
    return [{"projected_geojson": {"type": t, "coordinates": c}} for t, c in geojsons]


RING = [[0, 0], [4, 0], [4, 4], [0, 0]]


def test_json_pages_and_plain_lists(spark, tmp_path):
    (tmp_path / "paged.json").write_text(json.dumps([[record(cog_id="a"), record(cog_id="b")], [record(cog_id="c")], []]))
    (tmp_path / "plain.json").write_text(json.dumps([record(cog_id="d")]))
    (tmp_path / "empty.json").write_text("[]")
    rows = readers.read_json_pages(spark, str(tmp_path)).select("record.cog_id", "source_file").collect()
    assert sorted(r.cog_id for r in rows) == ["a", "b", "c", "d"]
    assert all(r.source_file.endswith(".json") for r in rows)


def records(spark, *pairs):
    rows = spark.createDataFrame([(kind, json.dumps([[r]])) for kind, r in pairs], "feature_type string, value string")
    return rows.select("feature_type", F.explode(readers.json_records(F.col("value"), schemas.FEATURE_RECORD)).alias("record"))


def test_projected_features_of_every_shape(spark):
    df = records(
        spark,
        ("polygon", record(projected_feature=features_of(("Polygon", [RING, RING]), ("Polygon", [RING])))),
        ("line", record(projected_feature=features_of(("LineString", [[0, 0], [1, 1], [2, 0]])))),
        ("point", record(projected_feature=features_of(("Point", [3, 4]), ("Point", [5, 6])))),
        ("polygon", record(legend_item={"abbreviation": "", "pattern": None, "color": None, "px_bbox": None})),
    )
    flat = N.projected_features(df).collect()
    shown = sorted((r.feature_type, r.abbreviation, r.p_num_geom, r.type, len(r.rings or [])) for r in flat)
    assert shown == [
        ("line", "Q", 2, "LineString", 1),
        ("point", "Q", 1, "Point", 1),
        ("point", "Q", 1, "Point", 1),
        ("polygon", "Q", 4, "Polygon", 1),
        ("polygon", "Q", 4, "Polygon", 2),
        ("polygon", "Qal old", 0, "polygon", 0),
    ]
    by_ring = N.projected_features(df, explode_rings=True)
    assert by_ring.where("feature_type = 'polygon' and rings is not null").count() == 3
    assert N.with_data(N.projected_features(df)).count() == 5


def test_pixel_features(spark):
    df = records(
        spark,
        ("polygon", record(px_geojson={"type": "Polygon", "coordinates": [RING, RING]})),
        ("point", record()),
    )
    got = {r.feature_type: r for r in N.pixel_features(df).collect()}
    assert got["polygon"].px_bbox == [1, 2, 3, 4] and len(got["polygon"].rings) == 2
    assert got["point"].px_bbox == [5, 6, 7, 8] and got["point"].abbreviation is None


def test_feature_documents_flatten(spark):
    schema = (
        StructType()
        .add("geometry", StructType().add("type", StringType()).add("coordinates", ArrayType(DoubleType())))
        .add("properties", StructType().add("model", StructType().add("name", StringType())))
    )
    feature = {"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"model": {"name": "m"}}}
    item = {"map": "x", "point_features": {"features": [feature, feature]}}
    docs = spark.createDataFrame(
        [("list", json.dumps([item])), ("object", json.dumps({"cog": "1", "nothing": [], "results": [item, item]})), ("none", json.dumps({"a": 1}))],
        "doc string, value string",
    )
    rows = N.feature_documents(docs, schema)
    assert rows.columns == ["doc", "main_id", "item", "feature_index", "geometry_type", "geometry_coordinates", "properties_model_name"]
    assert {r["doc"]: r["count"] for r in rows.groupBy("doc").count().collect()} == {"list": 2, "object": 4}
    assert rows.first().item == {"map": "x"}


def test_legend_and_gcps_with_absent_keys(spark):
    df = spark.createDataFrame([('[{"label":"a","px_bbox":[1,2,3,4]},{"abbreviation":"b"}]', '[{"system":"s","rows_from_top":1}]')], "l string, g string")
    items = df.select(F.inline(N.legend_items(F.col("l")))).collect()
    assert [(r.label, r.abbreviation, r.px_bbox) for r in items] == [("a", None, [1, 2, 3, 4]), (None, "b", None)]
    point = df.select(F.inline(N.gcps(F.col("g")))).first()
    assert (point.system, point.rows_from_top, point.longitude) == ("s", 1.0, None)


def test_system_match_does_not_repeat(spark):
    rows = spark.createDataFrame([("s", "1", 1), ("s", "2", 2), ("t", "1", 3)], "system string, system_version string, v int")
    wanted = spark.createDataFrame([("s", "1"), ("s", "1")], "system string, system_version string")
    assert [r.v for r in N.match_systems(rows, wanted).collect()] == [1]


def test_multi_parts_and_sizes(spark):
    df = spark.createDataFrame([("MultiPoint", "[[1,2,3],[4,5,6]]"), ("Point", "[7,8]")], "type string, coordinates string")
    parts = df.select(F.explode(N.multi_parts(F.struct("type", "coordinates"))).alias("g"))
    rings = parts.select(N.geojson_rings(F.col("g"), F.lit("point")).alias("r"))
    got = rings.select(N.drop_z(F.col("r")).alias("flat"), N.vertex_count(F.col("r")).alias("v"), N.coordinate_size(F.col("r")).alias("n")).collect()
    assert [r.flat[0][0] for r in got] == [[1.0, 2.0], [4.0, 5.0], [7.0, 8.0]]
    assert [(r.v, r.n) for r in got] == [(1, 3), (1, 3), (1, 2)]


def test_csv_in_two_encodings(spark, tmp_path):
    for name, encoding in (("utf", "utf-8"), ("latin", "latin-1")):
        (tmp_path / f"{name}.csv").write_bytes('id,state\n22,"Québec, ON"\n'.encode(encoding))
        rows = readers.read_csv(spark, str(tmp_path / f"{name}.csv"), "id string, state string").collect()
        assert [tuple(r) for r in rows] == [("22", "Québec, ON")]


def test_one_latin_file_leaves_the_others_alone(spark, tmp_path):
    folder = tmp_path / "two encodings"
    folder.mkdir()
    for i, encoding in enumerate(("utf-8", "latin-1", "utf-8")):
        (folder / f"part {i}.csv").write_bytes(f"id,state\n{i},Québec\n".encode(encoding))
    for multi_line in (False, True):
        rows = readers.read_csv(spark, str(folder), "id string, state string", multi_line=multi_line).collect()
        assert sorted(tuple(r) for r in rows) == [("0", "Québec"), ("1", "Québec"), ("2", "Québec")]


def test_listing_reads_no_content(spark, tmp_path):
    for name in ("12/a.tif", "12/b.TIF", "13/c.txt", "top.tif"):
        path = tmp_path / "maps" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * 2000)
    root = str(tmp_path / "maps")
    listed = readers.list_files(spark, root)
    files = readers.with_file_type(listed, ".tif", root=f"file:{root}")
    got = {(r.id, r.filename, r.has_file, r.size, r.size_hrf) for r in files.collect()}
    assert got == {("12", "a.tif", True, 2000, "1.953KB"), ("12", "b.TIF", True, 2000, "1.953KB"), ("13", "c.txt", False, 2000, "1.953KB")}
    scan = [line for line in plan_of(listed).splitlines() if "FileScan" in line or "BinaryFile" in line]
    assert scan and all("ReadSchema: struct<path:string,length:bigint>" in line for line in scan)


def test_vector_lines_flag_corrupt(spark):
    good = json.dumps({"type": "Feature", "properties": {"a": "1"}, "geometry": {"type": "Point", "coordinates": [1, 2]}})
    raw = spark.createDataFrame([("f", good), ("f", good[:30]), ("g", "{}")], "shp_file string, value string")
    got = [(r.shp_file, r.read_corrupt) for r in readers.parse_vector_features(raw).collect()]
    assert got == [("f", "no_corrupt"), ("f", "corrupted"), ("g", "corrupted")]


def test_partitioned_sink_prunes(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.concat(F.lit("l"), (F.col("id") % 2).cast("string")).alias("geo_value"), F.col("id").alias("v"))
    path = str(tmp_path / "truth")
    writers.write_partitioned(df, path)
    back = spark.read.parquet(path).where("id = 1 and geo_value = 'l0'")
    assert back.count() == df.where("id = 1 and geo_value = 'l0'").count()
    assert "PartitionFilters: [isnotnull(id" in plan_of(back)
    assert len(list((tmp_path / "truth").rglob("*.zstd.parquet"))) == 6


def test_id_map_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "aa"), ("2", "bb")], "id string, cog_id string")
    writers.write_id_map(df, str(tmp_path / "m"))
    rows = spark.read.text(str(tmp_path / "m")).select(F.explode(readers.id_map(F.col("value"))).alias("id", "cog_id"))
    assert sorted(map(tuple, rows.collect())) == [("1", "aa"), ("2", "bb")]
    (tmp_path / "one.json").write_text('{"7": "cc"}')
    assert [tuple(r) for r in readers.read_id_map(spark, str(tmp_path / "one.json")).collect()] == [("7", "cc")]


def test_ingest_messages(spark):
    keys = "cog_id string, system string, system_version string, feature_type string"
    expected = spark.createDataFrame([(c, "s", "1", "line") for c in "abcd"], keys)
    pages = spark.createDataFrame(
        [("a", "s", "1", "line", "f", 0, 200, 5), ("a", "s", "1", "line", "f", 1, 200, 0),
         ("b", "s", "1", "line", "g", 0, 200, 5), ("b", "s", "1", "line", "g", 1, 500, 0),
         ("c", "s", "1", "line", "h", 0, 200, 0)],
        keys + ", output_file string, page int, response_code int, n_records int",
    )
    got = {r.cog_id: (r.message, r.output_file, r.n_records) for r in manifest.ingest_status(expected, pages).collect()}
    assert got == {"a": ("success-done", "f", 5), "b": ("failed", "g", 5), "c": ("success-done", None, 0), "d": ("empty", None, 0)}


def test_performer_statuses(spark):
    keys = "id string, cog_id string, system string, system_version string, feature_type string"
    files = [("i", c, "s", "1", "line") for c in "abcd"]
    rows = spark.createDataFrame([(*f, "failed" if f[1] == "d" else "success-done") for f in files], keys + ", message string")
    features = spark.createDataFrame([files[0], files[0], files[1]], keys)
    crs = spark.createDataFrame([("a", "epsg:4326", True), ("b", "local", False)], "cog_id string, crs string, crs_valid boolean")
    got = {r.cog_id: (r.data, r.n_features) for r in prepare.performer_schema(rows, features, crs).collect()}
    assert got == {
        "a": ("extracted data", 2), "b": ("CRS failure - local", 1),
        "c": ("no-data extracted/missing features", 0), "d": ("no-data", 0),
    }


def test_performer_feature_keys_are_unique_and_stable(spark):
    df = records(spark, ("polygon", record(projected_feature=features_of(("Polygon", [RING]), ("Polygon", [RING])))))
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (2.0, 0.0, 0.0, 0.0, -2.0, 0.0))])
    rasters = spark.createDataFrame([("c",)], "cog_id string").withColumn("transform", t)
    rows = prepare.performer_features(df, rasters).orderBy("feature_index").collect()
    again = prepare.performer_features(df.repartition(3), rasters).orderBy("feature_index").collect()
    assert len({r.fid for r in rows}) == 2 and [r.fid for r in rows] == [r.fid for r in again]
    assert tuple(rows[0].bbox) == (0.0, 0.0, 4.0, 4.0)
    assert tuple(rows[0].legend_box) == (3.0, -9.0, 7.0, -5.0)


def test_ring_cells_follow_the_shape(spark):
    from cartomark.functions import geometry as G

    ring = [[0.0, 0.0], [100.0, 0.0], [0.0, 100.0], [0.0, 0.0]]
    df = spark.createDataFrame([("t", [ring])], "fid string, c array<array<array<double>>>")
    df = df.select("fid", G.geometry_from_pairs("polygon", F.col("c")).alias("geom"))
    cells = cover.compact_cover(df, 10.0)
    # Cells of a right triangle of 10 x 10 cells: those below or on the diagonal.
    below = sum(1 for c in range(11) for r in range(11) if c * 10 + r * 10 <= 100)
    assert cover.base_cells(cells).distinct().count() == below == cover.base_cells(cells).count()
    assert cells.count() < below


def test_reprojection_of_vertices(spark):
    from cartomark.functions import geometry as G

    df = spark.createDataFrame([([[-79.387139, 43.642567], [-79.0, 43.0]],)], "c array<array<double>>")
    geom = G.geometry_from_pairs("line", F.col("c"))
    there = prepare.reproject(geom, F.lit(32617), True)
    row = df.select(there.alias("u"), prepare.reproject(there, F.lit(32617), False).alias("b")).first()
    assert abs(row.u.rings[0][0].x - 630084.30) < 0.01
    assert abs(row.b.rings[0][1].x + 79.0) < 1e-9 and abs(row.b.rings[0][1].y - 43.0) < 1e-9


def test_intermediates_lie_in_one_folder_and_go(spark, tmp_path, monkeypatch):
    import os

    from cartomark import session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path / "shared"))
    for _ in range(2):
        assert session.materialize(spark.range(3), "numbers").count() == 3
    assert os.listdir(tmp_path / "shared") == [f"cartomark-{spark.sparkContext.applicationId}"]
    assert session.remove_intermediates(spark) and os.listdir(tmp_path / "shared") == []


def test_a_large_map_lands_as_many_pages(spark, monkeypatch):
    from cartomark.sources import readers
    from cartomark.workload import scan_queries

    paths, read = [], readers.read_json_pages
    monkeypatch.setattr(scan_queries, "PAGE_RECORDS", 50, raising=False)
    monkeypatch.setattr(readers, "read_json_pages", lambda s, path: paths.append(path) or read(s, path))
    got = scan_queries.s03(spark, "/root/testdata/sf0.001")
    files = read(spark, paths[0]).where("read_corrupt = 'no_corrupt'").groupBy("source_file").count()
    most = files.agg({"count": "max"}).first()[0]
    assert most <= 150 and got.where("read_corrupt = 'corrupted'").count() == got.where("read_corrupt = 'corrupted'").select("cog_id").distinct().count()
