import json

import pytest
from pyspark.sql import functions as F

from cartomark import schemas
from cartomark.functions.geometry import USE_SPATIAL_INDEX
from cartomark.plans import jobs, labels, report
from cartomark.sources import readers

CELL = 50.0


def ring(x, y, w):
    return [[x, y], [x + w, y], [x + w, y + w], [x, y + w], [x, y]]


@pytest.fixture(scope="module")
def truth(spark, tmp_path_factory):
    geojson = "struct<type:string,coordinates:string>"
    cols = f"fid string, id string, shp_file string, field_name string, field_pos int, value string, geom_kind string, read_corrupt string, geojson {geojson}"

    def poly(fid, value, *rings, corrupt="no_corrupt"):
        kind, coords = ("Polygon", [rings[0]]) if len(rings) == 1 else ("MultiPolygon", [[r] for r in rings])
        return (fid, "m", "poly.shp", "unit", 0, value, "polygon", corrupt, (kind, json.dumps(coords)))

    rows = [
        poly("t1", "Qal-1", ring(0, 0, 100)),
        poly("t2", "Qal-1", ring(300, 0, 100), ring(600, 0, 100)),
        poly("t3", "Tv", ring(0, 300, 80)),
        ("t4", "m", "line.shp", "type", 0, "thrust fault line", "line", "no_corrupt", ("LineString", "[[0,0],[200,0]]")),
    ]
    features = spark.createDataFrame(rows, cols)
    wanted = spark.createDataFrame([("m", "Qal 1"), ("m", "Tv"), ("m", "Thrust Fault"), ("m", "Quarry"), ("m", "Odd")], "id string, binary_value string")
    tables = jobs.prepare_truth(features, wanted, labels.ontology_table(spark), cell=CELL, threshold=0.7)
    folder = str(tmp_path_factory.mktemp("truth"))
    jobs.write_tables(tables, folder)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in tables}


def test_truth_tables(truth):
    counts = {(r.geo_value, r["count"]) for r in truth["labels"].collect()}
    assert counts == {("Qal1", 3), ("Tv", 1), ("thrustfaultline", 1)}
    assert {(r.unmatched_binary, r.reason) for r in truth["unmatched"].collect()} == {
        ("Quarry", labels.NOT_IN_TRUTH), ("Odd", labels.NOT_IN_DICTIONARY),
    }
    assert truth["success"].first().success_rate == 0.6
    assert truth["truth"].join(truth["cover"], "fid", "left_anti").count() == 0


def maps(spark):
    t = F.struct(*[F.lit(v).alias(k) for k, v in zip("abcdef", (1.0, 0.0, 0.0, 0.0, 1.0, 0.0))])
    df = spark.createDataFrame([("m", "c", "EPSG:32612", True, 2000, 2000, 9)], "id string, cog_id string, crs string, crs_valid boolean, width int, height int, total_pix long")
    return df.withColumn("transform", t)


def test_conversion_and_evaluation(spark, truth, tmp_path):
    def rec(kind, coords, abbreviation="", px=None, version="1"):
        return {
            "cog_id": "c", "system": "s", "system_version": version, "legend_id": f"c_s_{version}_k_x",
            "legend_item": {"abbreviation": abbreviation, "px_bbox": px},
            "projected_feature": [{"projected_geojson": {"type": kind, "coordinates": coords}}],
        }

    polygons = [
        rec("Polygon", [ring(0, 0, 100)], px=[0, 0, 10, 10]),
        rec("Polygon", [ring(350, 0, 100)], px=[0, 0, 10, 10]),
        rec("Polygon", [ring(0, 300, 80)], px=None),
        rec("Polygon", [ring(0, 0, 5)], px=[0, 0, 10, 10], version="0"),
    ]
    lines = [rec("LineString", [[0, 1], [200, 1]], abbreviation="Unknown thing")]
    for kind, recs in (("polygon", polygons), ("line", lines)):
        folder = tmp_path / "landed" / f"feature_type={kind}"
        folder.mkdir(parents=True)
        (folder / "c.json").write_text(json.dumps([recs]))
    pages = readers.read_json_pages(spark, str(tmp_path / "landed"), schemas.FEATURE_RECORD)
    records = pages.withColumn("feature_type", F.regexp_extract("source_file", "feature_type=([a-z]+)", 1))
    legend = spark.createDataFrame(
        [("c", 0, [1.0, 0.0, 11.0, 10.0], "Qal-1", "alluvium"), ("c", 1, [500.0, 0.0, 510.0, 10.0], "Tv", "volcanic")],
        "cog_id string, item int, px_bbox array<double>, abbreviation string, label string",
    )
    keys = "id string, cog_id string, system string, system_version string, feature_type string, message string"
    manifest = spark.createDataFrame(
        [("m", "c", "s", "1", kind, "success-done") for kind in ("polygon", "line", "point")], keys
    )
    systems = spark.createDataFrame([("s", "1")], "system string, system_version string")
    out = jobs.convert_performers(
        records, systems, maps(spark), manifest, truth["matches"], truth["crude"], legend, legend_cell=20.0
    )
    found = {(r.feature_type, r.geo_value, r.match_binary) for r in out["features"].collect()}
    assert found == {("polygon", "Qal1", None), ("polygon", USE_SPATIAL_INDEX, False), ("line", USE_SPATIAL_INDEX, False)}
    status = {r.feature_type: (r.data, r.n_features) for r in out["schema"].collect()}
    assert status == {
        "polygon": ("extracted data", 3), "line": ("extracted data", 1), "point": ("no-data extracted/missing features", 0),
    }
    jobs.write_tables({**out, "truth": truth["truth"], "labels": truth["labels"]}, str(tmp_path / "tables"))

    def table(name):
        return spark.read.parquet(str(tmp_path / "tables" / name))

    scales = spark.createDataFrame([("m", 24000)], "id string, scale long")
    scored = jobs.evaluate_features(
        table("features"), table("truth"), table("schema"), table("labels"), table("synopsis"),
        maps(spark), scales, cell=CELL, dynamic_buffer=0.005,
    )
    routes = {r.feature_type: r.route for r in scored["orchestration"].collect()}
    assert routes == {"polygon": "direct", "line": "crude"}
    rows = scored["metrics"].collect()
    got = {(r.match_type, r.feature_type, round(r.iou)) for r in rows}
    assert got == {
        ("matched", "polygon", 100), ("matched", "polygon", 34),
        ("unlabelled", "polygon", 100), ("crude", "line", round(next(r.iou for r in rows if r.match_type == "crude"))),
    }
    assert scored["unmatched_features"].count() == 0
    rolled = report.label_rollup(scored["metrics"], by=["feature_type"])
    assert rolled.where("geo_value is null").count() == 2


def test_map_job(spark):
    rasters = maps(spark).withColumn("crs", F.lit("EPSG:4326"))
    pts = [("c", s, "1", float(r), float(c), c * 1e-3 + d, r * 1e-3) for s, d in (("a", 0.0), ("p", 0.001)) for r, c in ((0, 0), (0, 9), (9, 0))]
    gcps = spark.createDataFrame(pts, "cog_id string, system string, system_version string, row double, col double, lon double, lat double")
    systems = spark.createDataFrame([("annotated", 1, "a", "1"), ("performer", 1, "p", "1")], "role string, priority int, system string, system_version string")
    maps_set = spark.createDataFrame([("c", "UT")], "cog_id string, state string")
    out = jobs.evaluate_maps(rasters, gcps, systems, maps_set, samples_per_map=5)
    row = out["report"].first()
    assert row.log == "success" and row.state == "UT" and row.sample_pnts == 5
    assert row.rmse == pytest.approx(0.111, abs=0.002)
