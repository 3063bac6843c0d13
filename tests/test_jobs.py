import pytest
from pyspark.sql import functions as F

from cartomark.plans import georef, inventory, orchestrate
from cartomark.streaming import arrivals

SYSTEMS = [("annotated", 1, "ann", "2"), ("annotated", 2, "old", "1"), ("performer", 1, "p", "1"), ("performer", 2, "q", "1")]
GCP = "cog_id string, system string, system_version string, row double, col double, lon double, lat double"


def square(cog, system, version, shift=0.0, points=((0, 0), (0, 100), (100, 0), (100, 100))):
    return [(cog, system, version, float(r), float(c), -110 + c * 0.001 + shift, 35 - r * 0.001) for r, c in points]


def georef_inputs(spark):
    line = ((0, 0), (50, 50), (100, 100))
    rows = (
        square("both", "ann", "2") + square("both", "p", "1", 0.01) + square("both", "q", "1", points=line)
        + square("fallback", "old", "1") + square("fallback", "p", "1")
        + square("onlyann", "ann", "2")
        + square("onlyperf", "p", "1")
        + square("badann", "ann", "2", points=line[:2]) + square("badann", "p", "1")
        + square("wrongversion", "ann", "9") + square("wrongversion", "p", "9")
        + [("unparsed", "ann", "2", None, None, None, None)] + square("unparsed", "p", "1")
    )
    maps = ["both", "fallback", "onlyann", "onlyperf", "badann", "wrongversion", "unparsed", "nothing"]
    samples = [(m, k, 10 * k, 5 * k) for m in maps for k in range(1, 4)]
    return (
        spark.createDataFrame(samples, "cog_id string, k int, random_pix_height int, random_pix_width int"),
        spark.createDataFrame(rows, GCP),
        spark.createDataFrame(SYSTEMS, "role string, priority int, system string, system_version string"),
    )


def test_all_georeferencing_outcomes(spark):
    rows = georef.evaluate_georeferencing(*georef_inputs(spark)).collect()
    got = {(r.cog_id, r.performer): (r.annotated_system, r.log) for r in rows}
    assert got == {
        ("both", "p"): ("ann", georef.SUCCESS),
        ("both", "q"): ("ann", georef.PERFORMER_BAD),
        ("fallback", "p"): ("old", georef.SUCCESS),
        ("fallback", "q"): ("old", georef.PERFORMER_MISSING),
        ("onlyann", None): ("ann", georef.PERFORMER_MISSING),
        ("onlyperf", None): (None, georef.ANNOTATED_MISSING),
        ("badann", None): ("ann", georef.ANNOTATED_BAD),
        ("unparsed", None): ("ann", georef.ANNOTATED_UNPARSED),
        ("wrongversion", None): (None, georef.BOTH_MISSING),
        ("nothing", None): (None, georef.BOTH_MISSING),
    }
    by_key = {(r.cog_id, r.performer): r for r in rows}
    hit = by_key[("both", "p")]
    # A shift of 0.01 degrees east at about 35 north.
    assert hit.rmse == pytest.approx(0.9129, abs=2e-3)
    assert len(hit.geodesic_pnts) == hit.sample_pnts == 3
    assert by_key[("fallback", "p")].rmse == pytest.approx(0.0, abs=1e-6)


def test_affine_exact_coefficients(spark):
    pts = [("m", float(r), float(c), 3 + 2.0 * c - 0.5 * r, -7 + 0.25 * c + 1.5 * r) for r, c in ((0, 0), (10, 3), (4, 20), (17, 9))]
    t = georef.fit_affine(spark.createDataFrame(pts, "k string, row double, col double, lon double, lat double"), ["k"]).first().transform
    assert tuple(t) == pytest.approx((2.0, -0.5, 3.0, 0.25, 1.5, -7.0))


def test_samples_are_distinct_and_repeatable(spark):
    rasters = spark.createDataFrame([("a", 30, 200), ("b", 5, 7)], "id string, height int, width int")
    first = georef.sample_pixels(rasters, 10).collect()
    again = georef.sample_pixels(rasters.repartition(5), 10).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    rows = [r.random_pix_height for r in first if r.id == "a"]
    assert len(set(rows)) == 10 and min(rows) >= 1 and max(rows) <= 30
    assert sorted(map(tuple, georef.sample_pixels(rasters, 10, seed=1).collect())) != sorted(map(tuple, first))


def test_planar_rmse_units(spark):
    pts = spark.createDataFrame([("a", "ft", 0.0, 0.0, 3.0, 4.0), ("a", "ft", 0.0, 0.0, 0.0, 5.0)], "id string, unit string, x double, y double, pred_x double, pred_y double")
    units = spark.createDataFrame([("ft", 0.3048)], "unit string, metres double")
    row = georef.planar_rmse(pts, ["id"], units).first()
    assert (row.rmse, row.rmse_km) == pytest.approx((5.0, 5 * 0.3048 / 1000))
    assert georef.rmse_summary(georef.planar_rmse(pts, ["id"], units)).first()["count"] == 1


def files(spark):
    rows = [
        ("/m/22660/x/", "a.tif", ".tif", 10), ("/m/22660/x/", "b.shp", ".shp", 5), ("/m/22660/y/", "c.tif", ".tif", 3),
        ("/m/333/", "d.shp", ".shp", 1), ("/m/VT_12/", "e.tif", ".tif", 1), ("/m/9226601/", "f.tif", ".tif", 1),
    ]
    return spark.createDataFrame(rows, "directory string, filename string, file_ext string, size long")


def test_directories_match_ids_exactly(spark):
    ids = spark.createDataFrame([("22660",), ("333",), ("VT_12",), ("44",)], "id string")
    got = {(r.id, r.directory) for r in inventory.id_directories(ids, files(spark)).collect()}
    # In the longer number the first five digits differ, so it is no match.
    assert got == {("22660", "/m/22660/x/"), ("22660", "/m/22660/y/"), ("333", "/m/333/"), ("VT_12", "/m/VT_12/")}


def test_inventory_flags(spark):
    ids = spark.createDataFrame([("22660", "Map"), ("333", "Map"), ("44", "Map")], "id string, source string")
    found = inventory.files_of_ids(ids, files(spark))
    got = {r.id: (r.in_dir_t, r.has_tif, r.has_shp, r.value_match) for r in inventory.inventory_features(ids, found).collect()}
    assert got == {"22660": (True, True, True, False), "333": (True, False, True, False), "44": (False, False, False, False)}
    states = inventory.inventory_ids(ids.select("id"), found.withColumn("has_file", F.col("file_ext") == ".tif"))
    assert {r.id: r.state for r in states.collect()} == {"22660": "present", "333": "missing", "44": "different"}
    smallest = inventory.one_raster_per_id(
        found.where("file_ext = '.tif'").select("id", F.concat("directory", "filename").alias("path"), "size", F.lit(True).alias("has_file"))
    )
    assert [tuple(r) for r in smallest.collect()] == [("22660", "/m/22660/y/c.tif")]
    counted = inventory.inspect_maps(found)
    assert [tuple(r) for r in inventory.missing_maps(counted, 3).collect()] == [(1, 2)]


def test_eval_subsets(spark):
    cols = "ID string, `COG ID` string, Source string, Georeferencing string, `Feature Extraction` string"
    rows = [("1", "a", "Map", "Yes", "Yes"), ("1", "a", "Map", "Yes", "Yes"), ("2", "b", "Topo", "Yes", "Yes"), ("3", "c", "Map", "No", "No")]
    df = spark.createDataFrame(rows, cols)
    assert {r.id for r in inventory.eval_subset(df, "Georeferencing").collect()} == {"1", "2"}
    assert [tuple(r) for r in inventory.eval_subset(df, "Feature Extraction").collect()] == [("1", "a", "Map")]


def test_routes(spark):
    keys = "id string, cog_id string, system string, system_version string, feature_type string"
    files = [(i, "c", "s", "1", "line") for i in ("some", "all", "none", "empty", "failed")]
    schema = spark.createDataFrame(
        [(*f, "failed" if f[0] == "failed" else "success-done", "extracted data") for f in files], keys + ", message string, data string"
    )
    labels = spark.createDataFrame([(f[0], v, n) for f in files for v, n in (("a", 2), ("b", 3), ("c", 1))], "id string, geo_value string, count long")
    syn = spark.createDataFrame(
        [(*files[0], "a", 4), *[(*files[1], v, 1) for v in "abc"], (*files[2], "zz", 2)], keys + ", geo_value string, count long"
    )
    got = {r.id: (r.route, r.num_missing, r.perc_missing, r.missing_val) for r in orchestrate.file_orchestration(schema, labels, syn).collect()}
    assert got == {
        "some": ("direct", 2, pytest.approx(66.7), ["b", "c"]),
        "all": ("direct", 0, 0.0, []),
        "none": ("crude", 3, 100.0, ["a", "b", "c"]),
        "empty": ("invalid", None, 100.0, None),
    }
    work = orchestrate.label_orchestration(schema, labels, syn).where("id = 'some'").first()
    assert (work.ratio, work.combinations) == (2.0, 8)


def test_stream_equals_batch_after_a_restart(spark, tmp_path):
    schema = "id string, path string, file_ext string"
    base = spark.createDataFrame([("1", False), ("2", False), ("3", True)], "id string, has_tif boolean")
    landed = [("1", "/n/a.tif", ".tif"), ("2", "/n/b.shp", ".shp")]
    later = [("1", "/n/a.tif", ".tif"), ("2", "/n/c.tif", ".tif")]
    for part in (landed, later):
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = arrivals.arrival_stream(spark, str(tmp_path / "in"), schema)
        arrivals.track_arrivals(stream, str(tmp_path / "t"), str(tmp_path / "ck"), ".tif").awaitTermination()
        now = arrivals.current_inventory(spark, base, str(tmp_path / "t"), schema, ["has_tif"])
        so_far = landed if part is landed else landed + later
        batch = inventory.update_inventory(
            base, spark.createDataFrame(so_far, schema).where("file_ext = '.tif'"), ["has_tif"]
        )
        assert sorted(map(tuple, now.collect())) == sorted(map(tuple, batch.collect()))
    assert sorted(map(tuple, now.collect())) == [("1", True), ("2", True), ("3", True)]


def test_shared_folder_is_the_configured_one(spark, tmp_path, monkeypatch):
    from cartomark import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "/shared"}.get(key, default)

    class Fake:
        conf = Conf()

    assert session.shared_folder(Fake()) == "/shared"

    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    for master in ("yarn", "local-cluster[2,1,1024]"):
        Bare.sparkContext.master = master
        with pytest.raises(RuntimeError):
            session.shared_folder(Bare())


def test_rmse_is_null_where_a_distance_is_unknown(spark):
    point = "struct<x:double,y:double>"
    rows = [("a", 1, 3.0, (0.0, 0.0), (0.0, 0.0)), ("a", 2, None, (0.0, 0.0), (0.0, 0.0)), ("b", 1, 3.0, (0.0, 0.0), (0.0, 0.0))]
    errors = spark.createDataFrame(rows, f"m string, k int, km double, annotated_pnt {point}, performer_pnt {point}")
    got = {r.m: (r.rmse, r.sample_pnts) for r in georef.rmse(errors, ["m"]).collect()}
    assert got == {"a": (None, 2), "b": (3.0, 1)}
