"""Check queries for text functions, similarity and nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from cartomark.functions import nested as N
from cartomark.functions import text as T
from cartomark.operators import similarity
from cartomark.plans import labels
from cartomark.workload import logical as L
from cartomark.workload.join_queries import names
from cartomark.workload.registry import query
from cartomark.workload.scan_queries import RECORDS_SQL, records


def raster_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster file names made of part attributes."""
    part = L.table(spark, sf_dir, "part")
    name = F.concat(
        F.lit("M_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.lower("p_type"),
        F.when(F.col("p_size") % 2 == 0, ".tif").otherwise(".shp"),
    )
    directory = F.concat(
        F.lit("/data/"), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.replace("p_brand", F.lit("#"), F.lit("")))
    )
    return part.select("p_partkey", name.alias("filename"), directory.alias("directory"))


NAMES_SQL = """WITH f AS (SELECT p_partkey, p_size, 'M_' || replace(p_name, ' ', '_') || '_' || lower(p_type) || CASE WHEN p_size % 2 = 0 THEN '.tif' ELSE '.shp' END AS filename,
  p_name, p_type, p_brand FROM part)
"""


@query("t01_strip_nonword", r"SELECT p_partkey, regexp_replace(p_brand || ' ' || p_name || '-' || p_type, '\W+', '', 'g') AS clean FROM part")
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("p_brand", F.lit(" "), "p_name", F.lit("-"), "p_type")
    return L.table(spark, sf_dir, "part").select("p_partkey", T.strip_nonword(raw).alias("clean"))


@query("t02_normalise_words", r"SELECT p_partkey, lower(replace(regexp_replace(p_brand || '_' || p_name || '--' || p_type, '\W+', ' ', 'g'), '_', ' ')) AS words FROM part")
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("p_brand", F.lit("_"), "p_name", F.lit("--"), "p_type")
    return L.table(spark, sf_dir, "part").select("p_partkey", T.to_words(raw).alias("words"))


@query(
    "t03_filename_parse",
    NAMES_SQL + """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '.tif' ELSE '.shp' END AS file_ext, p_name AS geologic,
      lower(p_type) || CASE WHEN p_size % 2 = 0 THEN '' ELSE '.shp' END AS feat_type,
      regexp_replace(filename, '\\.[a-z]+$', '') AS stem FROM f""",
)
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("filename")
    return raster_names(spark, sf_dir).select(
        "p_partkey",
        T.file_extension(name).alias("file_ext"),
        T.raster_label(name).alias("geologic"),
        T.raster_kind(name).alias("feat_type"),
        T.file_stem(name).alias("stem"),
    )


@query("t04_id_from_path", "SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN replace(p_brand, '#', '') END AS id FROM part")
def t04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster_names(spark, sf_dir).select("p_partkey", T.path_id(F.col("directory"), F.lit("/data/")).alias("id"))


@query(
    "t05_pattern_from_example",
    r"""SELECT DISTINCT p_brand, '\w{5}[#]\d{' || (length(p_brand) - 6) || '}' AS pattern FROM part""",
)
def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "part").select("p_brand").distinct().select(
        "p_brand", T.example_pattern(F.col("p_brand")).alias("pattern")
    )


@query("t06_prefix_cleanup", "SELECT p_partkey, p_name AS clean, p_type || ' x' AS abbreviation FROM part")
def t06(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = F.concat("p_type", F.lit("-"), F.col("p_size").cast("string"), F.lit(" 7 "), "p_name")
    legend_id = F.concat(F.lit("cog_sys_1.0_7_"), "p_type", F.lit("_x"))
    return L.table(spark, sf_dir, "part").select(
        "p_partkey",
        T.drop_sheet_prefix(sheet).alias("clean"),
        T.abbreviation_or_id(F.lit(""), legend_id, F.lit("cog"), F.lit("sys"), F.lit("1.0")).alias("abbreviation"),
    )


@query("t07_split_trim_list", "SELECT p_partkey, unnest([p_name, p_type]) AS alt_name FROM part")
def t07(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.concat(F.lit(" "), "p_name", F.lit(" ,  "), "p_type")
    return L.table(spark, sf_dir, "part").select("p_partkey", F.explode(T.split_trimmed(listed)).alias("alt_name"))


@query("t08_sequence_similarity")
def t08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similar_pairs(*names(spark, sf_dir), ["id"], 0.8)


@query(
    "t08_levenshtein_similarity",
    """WITH l AS (SELECT DISTINCT p_brand AS id, p_name || ' ' || lower(p_type) AS value FROM part WHERE p_partkey % 2 = 0),
    r AS (SELECT DISTINCT p_brand AS id, p_name || ' ' || lower(p_type) AS candidate FROM part WHERE p_partkey % 2 = 1)
    SELECT id, value, candidate, 1.0::DOUBLE - CAST(levenshtein(value, candidate) AS DOUBLE) / greatest(length(value), length(candidate)) AS ratio
    FROM l JOIN r USING (id) WHERE 1.0::DOUBLE - CAST(levenshtein(value, candidate) AS DOUBLE) / greatest(length(value), length(candidate)) > 0.7""",
)
def t08_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similar_pairs(*names(spark, sf_dir), ["id"], 0.7, method="levenshtein")


@query(
    "t09_tfidf_cosine",
    r"""WITH t AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z0-9_]{2,}')) AS w FROM
        (SELECT conv_id, turn, regexp_replace(text, '[^a-zA-Z0-9_ ]', ' ', 'g') AS text FROM conversations)),
    c AS (SELECT conv_id, turn, w, count(*) AS tf FROM t GROUP BY ALL),
    p AS (SELECT a.conv_id, a.turn AS a_turn, b.turn AS b_turn FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
    j AS (SELECT p.*, a.w, a.tf AS ta, coalesce(b.tf, 0) AS tb FROM p JOIN c a ON a.conv_id = p.conv_id AND a.turn = p.a_turn
          LEFT JOIN c b ON b.conv_id = p.conv_id AND b.turn = p.b_turn AND b.w = a.w
          UNION ALL SELECT p.*, b.w, 0, b.tf FROM p JOIN c b ON b.conv_id = p.conv_id AND b.turn = p.b_turn
          WHERE NOT EXISTS (SELECT 1 FROM c a WHERE a.conv_id = p.conv_id AND a.turn = p.a_turn AND a.w = b.w)),
    s AS (SELECT conv_id, a_turn, b_turn, sum(ta * tb) AS dot,
       sqrt(sum(CASE WHEN tb > 0 THEN ta * ta ELSE ta * ta * (ln(1.5) + 1) ** 2 END)) AS na,
       sqrt(sum(CASE WHEN ta > 0 THEN tb * tb ELSE tb * tb * (ln(1.5) + 1) ** 2 END)) AS nb FROM j GROUP BY ALL)
    SELECT p.conv_id, p.a_turn, round(CASE WHEN na > 0 AND nb > 0 THEN dot / (na * nb) ELSE 0 END, 7) AS cosine FROM p LEFT JOIN s USING (conv_id, a_turn, b_turn)""",
)
def t09(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = L.table(spark, sf_dir, "conversations").select(
        F.struct("conv_id", "turn").alias("id"),
        F.regexp_replace("text", "[^a-zA-Z0-9_ ]", " ").alias("text"),
        "conv_id",
        "turn",
    )
    first = turns.select(F.col("id").alias("a_id"), "conv_id", (F.col("turn") + 1).alias("turn"))
    pairs = first.join(turns.select(F.col("id").alias("b_id"), "conv_id", "turn"), ["conv_id", "turn"])
    scored = similarity.tfidf_cosine(pairs.select("a_id", "b_id"), turns.select("id", "text"))
    return scored.select(
        F.col("a_id.conv_id").alias("conv_id"),
        F.col("a_id.turn").alias("a_turn"),
        F.round("cosine", 7).alias("cosine"),
    )


@query(
    "t10_unit_match",
    """SELECT l_suppkey AS id, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 1000.0::DOUBLE WHEN 2 THEN 0.3048::DOUBLE ELSE 1000.0::DOUBLE END AS metres,
      CASE l_linenumber % 4 WHEN 0 THEN 'metre' WHEN 1 THEN 'kilometer' WHEN 2 THEN 'International Foot' ELSE 'kilometer' END AS unit_matched FROM lineitem""",
)
def t10(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber") % 4
    unit = (
        F.when(line == 0, "metre").when(line == 1, "kilometer").when(line == 2, "International Foot").otherwise("kilometre")
    )
    rows = L.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("id"), "l_linenumber", unit.alias("unit")
    )
    return labels.match_units(rows).select("id", "l_linenumber", "metres", "unit_matched")


@query(
    "t11_readable_size",
    """SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%.3fB', b) WHEN b < 1048576 THEN printf('%.3fKB', b / 1024)
      WHEN b < 1073741824 THEN printf('%.3fMB', b / 1048576) ELSE printf('%.3fGB', b / 1073741824) END AS size_hrf
    FROM (SELECT o_orderkey, floor(o_totalprice) * (o_orderkey % 1000) ** 2 AS b FROM orders)""",
)
def t11(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = (F.floor("o_totalprice") * F.pow(F.col("o_orderkey") % 1000, 2)).cast("bigint")
    return L.table(spark, sf_dir, "orders").select("o_orderkey", T.readable_size(size).alias("size_hrf"))


@query("t12_key_value_matcher")
def t12(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part")
    onto = part.where("p_partkey % 2 = 0").select(
        F.col("p_brand").alias("id"), F.col("p_name").alias("label"), F.concat_ws(" ", "p_name", F.lower("p_type")).alias("alias")
    )
    values = part.where("p_partkey % 2 = 1").select(F.col("p_brand").alias("id"), F.col("p_name").alias("value"))
    return labels.key_value_matches(values, onto, 0.6)


# --- nested JSON --------------------------------------------------------------------------


@query(
    "n01_match_systems",
    RECORDS_SQL + "SELECT fid, 'sys_' || line AS system FROM recs WHERE line IN (1, 2)",
)
def n01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir).select("record.system", "record.system_version", "record.legend_item.pattern")
    wanted = L.performers(spark, sf_dir).select("system", "system_version").union(
        L.performers(spark, sf_dir).select(F.lit("sys_2"), "system_version")
    ).where("system <> 'sys_3'")
    return N.match_systems(rows, wanted).select(F.col("pattern").alias("fid"), "system")


FLAT_SQL = RECORDS_SQL + """, rings AS (
  SELECT *, CASE WHEN line = 1 AND wide > 5 AND {shown} THEN unnest([0, 1]) ELSE 0 END AS ring_index FROM recs WHERE line = 1 AND wide > 5 AND {shown}
  UNION ALL SELECT *, 0 FROM recs WHERE NOT (line = 1 AND wide > 5) AND {shown}
)
"""


@query(
    "n02_projected_features",
    FLAT_SQL.format(shown="high > 0") + """SELECT fid, id::VARCHAR AS cog_id, 'sys_' || line AS system,
      CASE WHEN high = 1 THEN geo_value || ' x' ELSE geo_value END AS abbreviation, 0 AS feature_index, ring_index,
      CASE line WHEN 1 THEN 'Polygon' WHEN 2 THEN 'LineString' ELSE 'Point' END AS type,
      CASE line WHEN 1 THEN CASE ring_index WHEN 0 THEN 5 ELSE 4 END WHEN 2 THEN 2 ELSE 1 END::BIGINT AS p_num_geom FROM rings
    UNION ALL SELECT fid, id::VARCHAR, 'sys_' || line, geo_value, NULL, CASE WHEN line = 1 THEN NULL ELSE 0 END, feature_type, 0 FROM recs WHERE high = 0""",
)
def n02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.projected_features(records(spark, sf_dir), explode_rings=True)
    return rows.select(
        F.col("pattern").alias("fid"), "cog_id", "system", "abbreviation", "feature_index", "ring_index", "type", "p_num_geom"
    )


@query(
    "n03_pixel_features",
    FLAT_SQL.format(shown="true") + """SELECT id::VARCHAR AS cog_id, 'sys_' || line AS system, fid, ring_index,
      x0::DOUBLE AS box_x0, CASE line WHEN 1 THEN CASE ring_index WHEN 0 THEN 5 ELSE 4 END WHEN 2 THEN 3 ELSE 1 END::BIGINT AS vertices
      FROM (SELECT *, CASE WHEN line = 3 THEN NULL ELSE fid END AS f FROM rings) r""",
)
def n03(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir)
    # Points carry no legend item of their own; keep the key beside the record.
    keyed = rows.withColumn("record", F.col("record").withField("cog_id", F.concat_ws("|", "record.cog_id", "record.legend_item.pattern")))
    flat = N.pixel_features(keyed, explode_rings=True)
    return flat.select(
        F.split_part("cog_id", F.lit("|"), F.lit(1)).alias("cog_id"),
        "system",
        F.split_part("cog_id", F.lit("|"), F.lit(2)).alias("fid"),
        "ring_index",
        F.col("px_bbox")[0].alias("box_x0"),
        N.vertex_count(F.col("rings")).alias("vertices"),
    )


def feature_schema() -> StructType:
    geometry = StructType().add("type", StringType()).add("coordinates", ArrayType(DoubleType()))
    model = StructType().add("name", StringType()).add("score", LongType())
    properties = StructType().add("model", model).add("label", StringType())
    return StructType().add("id", StringType()).add("geometry", geometry).add("properties", properties)


@query(
    "n04_feature_documents",
    L.with_sql(L.BOXES_SQL) + """SELECT fid AS id, id AS map_id, 'Point' AS geometry_type, x0::DOUBLE AS x, 'm' || line AS properties_model_name,
      y1 AS properties_model_score, geo_value AS properties_label FROM perf""",
)
def n04(spark: SparkSession, sf_dir: str) -> DataFrame:
    perf = L.performers(spark, sf_dir)
    feature = F.struct(
        F.col("fid").alias("id"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col("x0").cast("double"), F.col("y0").cast("double")).alias("coordinates")).alias("geometry"),
        F.struct(
            F.struct(F.concat(F.lit("m"), F.col("line").cast("string")).alias("name"), F.col("y1").alias("score")).alias("model"),
            F.col("geo_value").alias("label"),
        ).alias("properties"),
    )
    holder = F.struct(
        F.col("id").alias("map"), F.struct(F.array(feature).alias("features")).alias("point_features")
    )
    as_list = F.to_json(F.array(holder))
    as_object = F.to_json(F.struct(F.lit("x").alias("name"), F.array(holder).alias("results")))
    docs = perf.select(
        F.col("id").alias("map_id"), F.when(F.col("line") == 1, as_list).otherwise(as_object).alias("value")
    )
    flat = N.feature_documents(docs, feature_schema())
    return flat.select(
        "id", "map_id", "geometry_type", F.col("geometry_coordinates")[0].alias("x"),
        "properties_model_name", "properties_model_score", "properties_label",
    )


@query(
    "n05_vertex_and_coordinate_size",
    RECORDS_SQL + """SELECT fid, CASE line WHEN 1 THEN CASE WHEN wide > 5 THEN 9 ELSE 5 END WHEN 2 THEN 3 ELSE 1 END::BIGINT AS vertices,
      CASE line WHEN 1 THEN CASE WHEN wide > 5 THEN 18 ELSE 10 END WHEN 2 THEN 6 ELSE 2 END::BIGINT AS geom_size FROM recs WHERE high > 0""",
)
def n05(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.with_data(N.projected_features(records(spark, sf_dir)))
    return rows.select(
        F.col("pattern").alias("fid"),
        N.vertex_count(F.col("rings")).alias("vertices"),
        N.coordinate_size(F.col("rings")).alias("geom_size"),
    )


@query(
    "n06_legend_items",
    "SELECT p_partkey AS item, p_name AS label, CASE WHEN p_size % 2 = 0 THEN p_brand END AS abbreviation, NULL::VARCHAR AS description, p_size::DOUBLE AS box_x0 FROM part",
)
def n06(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = L.table(spark, sf_dir, "part")
    item = F.struct(
        F.col("p_name").alias("label"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("abbreviation"),
        F.array(F.col("p_size").cast("double"), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("px_bbox"),
    )
    text = F.to_json(F.array(item))
    rows = part.select(F.col("p_partkey").alias("item"), F.explode(N.legend_items(text)).alias("l"))
    return rows.select("item", "l.label", "l.abbreviation", "l.description", F.col("l.px_bbox")[0].alias("box_x0"))


@query(
    "n07_gcp_parse",
    L.with_sql(L.GCPS_SQL) + """SELECT cog_id, system, "row" AS rows_from_top, CASE WHEN col = 7 THEN NULL ELSE col END AS columns_from_left,
      round(lon, 9) AS longitude, round(lat, 9) AS latitude, col = 7 AS incompatible FROM gcps""",
)
def n07(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = L.gcps(spark, sf_dir)
    text = F.to_json(
        F.array(
            F.struct(
                "system", "system_version", F.col("row").alias("rows_from_top"),
                F.when(F.col("col") != 7, F.col("col")).alias("columns_from_left"),
                F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
            )
        )
    )
    rows = g.select("cog_id", F.explode(N.gcps(text)).alias("p"))
    return rows.select(
        "cog_id", "p.system", "p.rows_from_top", "p.columns_from_left",
        F.round("p.longitude", 9).alias("longitude"), F.round("p.latitude", 9).alias("latitude"),
        F.col("p.columns_from_left").isNull().alias("incompatible"),
    )
