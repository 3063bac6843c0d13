import difflib
import math
import random

import pytest
from pyspark.sql import functions as F

from cartomark.functions import text as T
from cartomark.functions.geometry import USE_SPATIAL_INDEX
from cartomark.operators import similarity
from cartomark.plans import labels
from helpers import plan_of


def values(spark, expr, inputs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
    return [r.v for r in df.select("i", expr(F.col("s")).alias("v")).orderBy("i").collect()]


def test_normalisers(spark):
    assert values(spark, T.strip_nonword, ["a-b c_d", "Qál (x)"]) == ["abc_d", "Qálx"]
    assert values(spark, T.to_words, ["A-b__C", "x"]) == ["a b  c", "x"]
    assert values(spark, T.to_spaced, ["A-b_C"]) == ["a b_c"]


def test_file_parts(spark):
    names = ["VT_Burl_Thrust fault_line.tif", "a.tar.gz", "noext", ".hidden"]
    assert values(spark, T.file_extension, names) == [".tif", ".gz", "", ""]
    assert values(spark, T.raster_label, names[:1]) == ["Burl Thrust fault"]
    assert values(spark, T.raster_kind, names[:1]) == ["line"]
    assert values(spark, T.file_stem, ["/x/y/map_1.tif"]) == ["map_1"]
    assert values(spark, lambda c: T.path_id(c, F.lit("/r/")), ["/r/123/a", "/r", "/q/1"]) == ["123", None, None]


def test_example_patterns(spark):
    assert values(spark, T.example_pattern, ["VT_12-b 3", "a]"]) == [r"\w{2}[_]\d{2}[-]\w{1}\s{1}\d{1}", r"\w{1}[\]]"]


def test_prefixes(spark):
    assert values(spark, T.drop_sheet_prefix, ["foo A-12 34 Qal x", "plain"]) == ["Qal x", "plain"]
    def by_id(c):
        return T.abbreviation_or_id(c, F.lit("cog_sys_1_k_Qal_old"), F.lit("cog"), F.lit("sys"), F.lit("1"))

    assert values(spark, by_id, ["", "Q"]) == ["Qal old", "Q"]


def test_sizes(spark):
    sizes = {0: "0.000B", 1023: "1023.000B", 1024: "1.000KB", 1234567: "1.177MB", 5 * 1024**5: "5.000PB"}
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    assert {r.s: r.v for r in df.select("s", T.readable_size(F.col("s")).alias("v")).collect()} == sizes


@pytest.mark.parametrize("threshold", [0.55, 0.8, 0.9])
def test_sequence_pairs_miss_nothing(spark, threshold):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 13))) for _ in range(120)]
    words += [w[: len(w) // 2] + rng.choice("abx") + w[len(w) // 2 + rng.randrange(2):] for w in words]
    left = spark.createDataFrame([(i % 2, w) for i, w in enumerate(words)], "k int, value string")
    right = spark.createDataFrame([(i % 2, w) for i, w in enumerate(reversed(words))], "k int, candidate string")
    pairs = similarity.similar_pairs(left, right, ["k"], threshold)
    got = {(r.k, r.value, r.candidate): r.ratio for r in pairs.collect()}
    want = {}
    for k in (0, 1):
        for a in {w for i, w in enumerate(words) if i % 2 == k}:
            for b in {w for i, w in enumerate(reversed(words)) if i % 2 == k}:
                ratio = difflib.SequenceMatcher(None, a, b).ratio()
                if ratio > threshold:
                    want[(k, a, b)] = ratio
    assert got == pytest.approx(want)


def test_similarity_join_has_no_nested_loop(spark):
    df = spark.createDataFrame([("a", "x")], "k string, value string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(similarity.similar_pairs(df, df.withColumnRenamed("value", "candidate"), ["k"], 0.8))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tfidf_of_two_texts(spark):
    texts = spark.createDataFrame([("a", "red bolt red"), ("b", "red gear"), ("c", "x"), ("d", "other words")], "id string, text string")
    pairs = spark.createDataFrame([("a", "b"), ("a", "d"), ("a", "c")], "a_id string, b_id string")
    got = {(r.a_id, r.b_id): r.cosine for r in similarity.tfidf_cosine(pairs, texts).collect()}
    rare = math.log(1.5) + 1
    want = 2 / (math.sqrt(4 + rare**2) * math.sqrt(1 + rare**2))
    assert got == pytest.approx({("a", "b"): want, ("a", "d"): 0.0, ("a", "c"): 0.0})


def test_units(spark):
    df = spark.createDataFrame([("metre",), ("meter",), ("US survey foot",), ("zz",), (None,)], "unit string")
    got = {r.unit: (r.metres, r.unit_matched) for r in labels.match_units(df).collect()}
    assert got["metre"] == (1.0, "metre")
    assert got["meter"][1] == max(
        [n for _, n, _ in labels.UNITS], key=lambda n: difflib.SequenceMatcher(None, "meter", n).ratio()
    )
    assert got["zz"][1] == min(n for _, n, _ in labels.UNITS) and got["zz"][0] is not None
    assert got[None] == (None, None)


def test_label_tiers(spark):
    features = spark.createDataFrame(
        [(1, "f1", "Qal-x"), (1, "f2", "thrust fault"), (1, "f3", "nothing"), (2, "f4", "qal x"), (1, "f5", None)],
        "id int, fid string, abbreviation string",
    )
    direct = spark.createDataFrame([(1, "Qal x"), (1, "other")], "id int, geo_value_vector string")
    crude = spark.createDataFrame([(1, "Thrust Fault"), (1, "Qal x")], "id int, unmatched_binary string")
    got = {r.fid: (r.geo_value, r.match_binary) for r in labels.assign_by_abbreviation(features, direct, crude).collect()}
    assert got == {
        "f1": ("Qal x", True),
        "f2": ("Thrust Fault", False),
        "f3": (USE_SPATIAL_INDEX, False),
        "f4": (USE_SPATIAL_INDEX, False),
        "f5": (USE_SPATIAL_INDEX, False),
    }


def test_legend_boxes(spark):
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    features = spark.createDataFrame(
        [("m", "near", (0.0, 0.0, 10.0, 10.0)), ("m", "away", (900.0, 900.0, 910.0, 910.0)), ("m", "none", None),
         ("x", "nolegend", (0.0, 0.0, 1.0, 1.0))],
        f"cog_id string, fid string, bbox {box}",
    )
    legend = spark.createDataFrame(
        [("m", 0, (100.0, 0.0, 110.0, 10.0), "Q-1", "first"), ("m", 1, (2.0, 0.0, 12.0, 10.0), "", "second item")],
        f"cog_id string, item int, bbox {box}, abbreviation string, label string",
    )
    got = {r.fid: (r.geo_value, r.legend_iou, r.match_binary) for r in labels.assign_by_legend(features, legend, 10.0).collect()}
    assert got == {
        "near": ("seconditem", 66.667, None),
        "away": ("Q1", 0.0, None),
        "none": (USE_SPATIAL_INDEX, None, False),
        "nolegend": (USE_SPATIAL_INDEX, None, None),
    }


def test_field_matching_tiers(spark):
    wanted = spark.createDataFrame(
        [("m", "Qal deposit"), ("m", "T-v x"), ("m", "Thrust Fault"), ("m", "Quarry"), ("m", "gone")], "id string, binary_value string"
    )
    cols = "id string, shp_file string, geom_kind string, field_name string, field_pos int, value string, read_corrupt string"
    found = spark.createDataFrame(
        [
            ("m", "poly.shp", "polygon", "name", 0, "QAL DEPOSITS", "no_corrupt"),
            ("m", "poly.shp", "polygon", "code", 1, "Qal deposit", "no_corrupt"),
            ("m", "poly.shp", "polygon", "code", 1, "Tv (x)", "no_corrupt"),
            ("m", "line.shp", "line", "type", 0, "thrust-fault_line", "no_corrupt"),
            ("m", "pt.shp", "point", "type", 0, "quarrys", "no_corrupt"),
            ("m", "bad.shp", "point", "type", 0, "quarry", "corrupted"),
        ],
        cols,
    )
    got = {
        r.binary_value: (r.field_name, r.geo_value_vector, r.match_method, r.geom_type)
        for r in labels.match_field_values(wanted, found, labels.ontology_table(spark), 0.9).collect()
    }
    assert got == {
        "Qal deposit": ("name", "QAL DEPOSITS", "sequence", "Polygon"),
        "T-v x": ("code", "Tv (x)", "sequence-regex", "Polygon"),
        "Thrust Fault": ("type", "thrust-fault_line", "naive-regex-ontology", "LineString"),
        "Quarry": ("type", "quarrys", "sequence-regex-ontology", "Point"),
    }


def test_crude_reasons(spark):
    unmatched = spark.createDataFrame(
        [("m", "Fault", "no_corrupt"), ("m", "Quarry", "no_corrupt"), ("m", "Odd", "no_corrupt"), ("n", "Fault", "corrupted")],
        "id string, unmatched_binary string, read_corrupt string",
    )
    kinds = spark.createDataFrame([("m", "l.shp", "LineString")], "id string, shp_file string, geom_type string")
    matched, rest = labels.crude_matches(unmatched, kinds, labels.ontology_table(spark))
    assert [tuple(r) for r in matched.collect()] == [("m", "Fault", "LineString", "l.shp")]
    assert {(r.id, r.unmatched_binary, r.geom_type, r.reason) for r in rest.collect()} == {
        ("m", "Quarry", "Point", labels.NOT_IN_TRUTH),
        ("m", "Odd", "Unknown", labels.NOT_IN_DICTIONARY),
        ("n", "Fault", "Unknown", labels.CORRUPT_TRUTH),
    }


def test_ontology_report(spark):
    onto = labels.ontology_from_csv(
        spark.createDataFrame([("thrust fault", "fault", "line", "thrust, low angle fault"), ("adit", "mine", "point", None)],
                              "label string, ftr_type string, geometry_type string, alternate_example string")
    )
    found = spark.createDataFrame([("Thrust faults",), ("Adit",), ("zzz",)], "geo_value string")
    got = {(r.geo_value, r.field): (r.match, r.geometry_type) for r in labels.ontology_report(found, onto).collect()}
    assert got == {("Thrust faults", "label"): ("thrust fault", "line"), ("Adit", "label"): ("adit", "point")}


def test_key_value_matcher(spark):
    onto = spark.createDataFrame([("m", "fault", "normal fault"), ("m", "adit", "mine tunnel")], "id string, label string, alias string")
    found = spark.createDataFrame([("m", "fault line"), ("m", "normal fault line")], "id string, value string")
    got = {r.method: (r.key, r.value) for r in labels.key_value_matches(found, onto, 0.5).collect()}
    assert got["sequence-ontology_value"] == ("normal fault", "normal fault line")
    assert got["sequence-ontology_key"] == ("fault", "fault line")
    assert got["cosine-ontology_value"] == ("normal fault", "normal fault line")
