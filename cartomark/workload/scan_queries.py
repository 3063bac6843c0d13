"""Check queries for scans, sinks, projections and filters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartomark.functions import nested as N
from cartomark.operators import balance
from cartomark.operators.spatial import with_cells
from cartomark.plans import orchestrate
from cartomark.session import materialize, run_folder
from cartomark.sources import manifest, readers, writers
from cartomark.workload import logical as L
from cartomark.workload.registry import query


#: Records of a landed page, about.
PAGE_RECORDS = 500


def scratch(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "s01_parquet_scan",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45",
)
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.read_tables(
        spark, f"{sf_dir}/lineitem.parquet", schema="l_orderkey long, l_partkey long, l_quantity double"
    )
    return rows.where("l_quantity > 45")


@query("s02_csv_scan", L.with_sql(L.EVAL_SET_SQL) + "SELECT id, scale, state || ' é' AS state, source FROM eval_set")
def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.eval_set(spark, sf_dir).withColumn("state", F.concat("state", F.lit(" é")))
    path = scratch(spark, "eval-set-csv")
    for encoding, part in (("ISO-8859-1", rows.where("id % 2 = 0")), ("UTF-8", rows.where("id % 2 = 1"))):
        part.write.mode("append").option("encoding", encoding).csv(path, header=True)
    return readers.read_csv(spark, path, "id long, scale long, state string, source string")


RECORDS_SQL = L.with_sql(L.BOXES_SQL) + """, recs AS (
  SELECT *, CASE line WHEN 1 THEN 'polygon' WHEN 2 THEN 'line' ELSE 'point' END AS feature_type,
    (x1 - x0 - 100) // 20 AS wide, (y1 - y0 - 100) // 20 AS high FROM boxes)
"""


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction records as JSON text: one polygon, line or point per box.

    Wide polygons have a second ring, boxes of lowest height no feature, those of
    the next height no abbreviation; every other text is a plain list, not pages.
    """
    return written_records(L.boxes(spark, sf_dir)).select("fid", "feature_type", "value")


def written_records(boxes: DataFrame) -> DataFrame:
    """:func:`record_texts` beside the columns of their boxes."""
    rows = boxes.withColumns(
        {
            "wide": F.expr("(x1 - x0 - 100) div 20"),
            "high": F.expr("(y1 - y0 - 100) div 20"),
            "feature_type": F.expr("CASE line WHEN 1 THEN 'polygon' WHEN 2 THEN 'line' ELSE 'point' END"),
        }
    )

    def pair(x: str, y: str) -> F.Column:
        return F.array(F.col(x).cast("double"), F.col(y).cast("double"))

    ring = F.array(pair("x0", "y0"), pair("x1", "y0"), pair("x1", "y1"), pair("x0", "y1"), pair("x0", "y0"))
    hole = F.array(pair("x0", "y0"), pair("x1", "y0"), pair("x1", "y1"), pair("x0", "y0"))
    polygon = F.when(F.col("wide") > 5, F.array(ring, hole)).otherwise(F.array(ring))
    line = F.array(pair("x0", "y0"), pair("x1", "y1"), pair("x1", "y0"))

    def geojson(kind: str, coords: F.Column) -> F.Column:
        return F.to_json(F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")))

    shape = (
        F.when(F.col("line") == 1, geojson("Polygon", polygon))
        .when(F.col("line") == 2, geojson("LineString", line))
        .otherwise(geojson("Point", pair("x0", "y0")))
    )
    # Named, so that the geometry is written out once though the text holds it twice.
    rows = rows.withColumn("shape", shape)
    shown = F.when(F.col("high") == 0, "").otherwise(F.concat(F.lit('{"projected_geojson":'), F.col("shape"), F.lit("}")))
    abbreviation = F.when(F.col("high") == 1, "").otherwise(F.col("geo_value"))
    box = ["[", "{x0}", ",", "{y0}", ",", "{x1}", ",", "{y1}", "]"]
    parts = [
        '{"cog_id":"', "{id}", '","system":"sys_', "{line}", '","system_version":"1.0","legend_id":"', "{id}", "_sys_", "{line}", "_1.0_k_", "{geo_value}",
        '_x","px_bbox":', *box, ',"legend_item":{"abbreviation":"', abbreviation, '","pattern":"', "{fid}", '","color":"c', "{wide}", '","px_bbox":', *box,
        '},"projected_feature":[', shown, '],"px_geojson":', "{shape}", "}",
    ]

    def written(part: str | F.Column) -> F.Column:
        """A literal or a value; unknown values are written as null."""
        if isinstance(part, str) and not (part.startswith("{") and part.endswith("}") and len(part) > 2):
            return F.lit(part)
        value = F.col(part[1:-1]) if isinstance(part, str) else part
        return F.coalesce(value.cast("string"), F.lit("null"))

    paged = F.col("x0") % 200 == 0
    text = F.concat(F.when(paged, "[[").otherwise("["), *[written(p) for p in parts], F.when(paged, "]]").otherwise("]"))
    return rows.withColumn("value", text)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartomark import schemas

    parsed = readers.json_records(F.col("value"), schemas.FEATURE_RECORD)
    return record_texts(spark, sf_dir).select("feature_type", F.explode(parsed).alias("record"))


@query(
    "s03_json_pages",
    RECORDS_SQL + """SELECT 'no_corrupt' AS read_corrupt, fid, id::VARCHAR AS cog_id, 'sys_' || line AS system,
      CASE WHEN high = 1 THEN '' ELSE geo_value END AS abbreviation, x0::DOUBLE AS box_x0,
      CASE WHEN high = 0 THEN 0 ELSE 1 END AS n_features FROM recs WHERE id % 25 <> 7
      UNION ALL SELECT DISTINCT 'corrupted', NULL, id::VARCHAR, NULL, NULL, NULL::DOUBLE, NULL::INTEGER FROM recs WHERE id % 25 = 7""",
)
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages landed as files of bounded size, one page each; those of some maps are cut off.

    A cut-off map gives one row, however many pages it has.
    """
    record = F.expr("trim(TRAILING ']' FROM trim(LEADING '[' FROM value))")
    boxes = L.boxes(spark, sf_dir)
    counts = boxes.groupBy(F.col("id").alias("map")).agg(F.ceil(F.count(F.lit(1)) / PAGE_RECORDS).alias("n_pages"))
    # Written, so that its size is known: while it is small, it goes to the boxes.
    counts = materialize(counts, "page-counts")
    # A feature stands on the map of every row of its name; each row travels once for that.
    maps = F.collect_list("id").over(Window.partitionBy("fid"))
    # Boxes travel to the task of their page and become text there, which is many times longer.
    placed = (
        boxes.where("fid is not null")
        .withColumn("_maps", maps)
        .withColumn("map", F.explode("_maps"))
        .drop("_maps")
        .join(counts, "map")
        .withColumn("page", F.pmod(F.xxhash64("fid"), F.col("n_pages")))
        .repartition("map", "page")
    )
    pages = (
        written_records(placed)
        .groupBy(F.col("map").alias("id"), "page")
        .agg(F.concat(F.lit("[["), F.array_join(F.collect_list(record), ","), F.lit("]]")).alias("value"))
    )
    cut = F.when(F.col("id") % 25 == 7, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))
    path = scratch(spark, "pages")
    pages.withColumn("value", cut).write.partitionBy("id", "page").text(path, compression="gzip")
    r = F.col("record")
    landed = F.regexp_extract("source_file", r"/id=(\d+)/", 1)
    read = readers.read_json_pages(spark, path).select(
        "read_corrupt",
        r["legend_item"]["pattern"].alias("fid"),
        F.coalesce(r["cog_id"], landed).alias("cog_id"),
        r["system"].alias("system"),
        r["legend_item"]["abbreviation"].alias("abbreviation"),
        r["px_bbox"][0].alias("box_x0"),
        F.size(r["projected_feature"]).alias("n_features"),
    )
    broken = F.col("read_corrupt") == "corrupted"
    return read.where(~broken).unionByName(read.where(broken).distinct())


@query("s04_id_map", "SELECT s_suppkey::VARCHAR AS id, s_name AS cog_id FROM supplier")
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = L.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("cog_id")
    )
    path = scratch(spark, "id-map")
    writers.write_id_map(ids, path)
    return spark.read.text(path).select(F.explode(readers.id_map(F.col("value"))).alias("id", "cog_id"))


@query(
    "s05_multi_file_concat",
    "SELECT o_orderstatus, count(*) AS n, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'other' END AS part "
    "FROM orders GROUP BY ALL",
)
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = L.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    base = scratch(spark, "concat")
    done, other = f"{base}/done", f"{base}/other"
    writers.write_table(orders.where("o_orderstatus = 'F'"), done)
    writers.write_table(orders.where("o_orderstatus <> 'F'"), other)
    both = readers.read_tables(spark, done, other, with_path=True)
    part = F.regexp_extract("source_file", r"/(done|other)/", 1)
    return both.groupBy("o_orderstatus", part.alias("part")).agg(F.count("*").alias("n"))


@query(
    "s06_file_listing",
    "SELECT DISTINCT 'flag=' || l_returnflag || '/status=' || l_linestatus AS folder, '.parquet' AS file_ext, "
    "true AS has_bytes FROM lineitem",
)
def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), "l_orderkey"
    )
    path = scratch(spark, "listing")
    writers.write_partitioned(rows, path, by=("flag", "status"))
    files = readers.with_file_type(readers.list_files(spark, path, "*.parquet"), ".parquet")
    folder = F.regexp_extract("directory", r"(flag=[^/]+/status=[^/]+)/$", 1)
    return files.where("has_file").select(
        folder.alias("folder"), "file_ext", (F.col("size") > 0).alias("has_bytes")
    ).distinct()


TRUTH_LINES_SQL = L.with_sql(L.BOXES_SQL)


@query(
    "s07_vector_scan",
    TRUTH_LINES_SQL + """SELECT id || '.shp' AS shp_file,
      CASE WHEN (y1 - y0 - 100) // 20 = 0 THEN 'corrupted' ELSE 'no_corrupt' END AS read_corrupt,
      count(*) AS n, count(DISTINCT CASE WHEN (y1 - y0 - 100) // 20 > 0 THEN geo_value END) AS n_labels
      FROM truth GROUP BY ALL""",
)
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = L.truths(spark, sf_dir)
    line = F.format_string(
        '{"type":"Feature","properties":{"label":"%s","fid":"%s"},'
        '"geometry":{"type":"Point","coordinates":[%d,%d]}}',
        "geo_value", "fid", "x0", "y0",
    )
    broken = F.expr("(y1 - y0 - 100) div 20 = 0")
    path = scratch(spark, "vector-lines")
    lines = truth.select("id", F.when(broken, F.substring(line, 1, 40)).otherwise(line).alias("value"))
    # Maps come together before they are written, so that files grow with maps, not with tasks times maps; large maps are split.
    lines.hint("rebalance", "id").write.partitionBy("id").text(path)
    landed = F.concat(F.regexp_extract("shp_file", r"/id=(\d+)/", 1), F.lit(".shp"))
    features = readers.read_vector_features(spark, path).withColumn("shp_file", landed)
    return features.groupBy("shp_file", "read_corrupt").agg(
        F.count("*").alias("n"),
        F.count_distinct(F.when(F.col("read_corrupt") == "no_corrupt", F.col("properties")["label"])).alias("n_labels"),
    )


@query(
    "s08_raster_facts",
    """SELECT s_suppkey AS id, 100 + s_suppkey % 7 AS width, 80 + s_suppkey % 5 AS height, 0.5::DOUBLE AS pixel_x,
       (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey AND l_linenumber % 2 = 1) AS total_pix FROM supplier""",
)
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = L.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_suppkey") % 7 + 100).alias("width"),
        (F.col("s_suppkey") % 5 + 80).alias("height"),
        *[F.lit(v).alias(c) for c, v in zip("abcdef", (0.5, 0.0, 10.0, 0.0, -0.5, 90.0))],
    )
    pixels = L.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("id"), (F.col("l_linenumber") % 2).alias("value")
    )
    return readers.raster_facts(meta, pixels).select(
        "id", "width", "height", F.col("transform.a").alias("pixel_x"), "total_pix"
    )


@query("s09_parquet_sink", "SELECT l_returnflag, count(*) AS n, sum(l_linenumber)::BIGINT AS s FROM lineitem GROUP BY 1")
def s09(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sink")
    writers.write_table(L.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber"), path)
    return spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_linenumber").alias("s")
    )


@query(
    "s10_partitioned_sink",
    L.with_sql(L.BOXES_SQL) + "SELECT id, fid, x0 FROM truth WHERE geo_value = 'A'",
)
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "truth-by-label")
    writers.write_partitioned(L.truths(spark, sf_dir).select("id", "geo_value", "fid", "x0"), path, by=("geo_value",))
    return spark.read.parquet(path).where("geo_value = 'A'").select("id", "fid", "x0")


@query("s11_csv_sink", L.with_sql(L.EVAL_SET_SQL) + "SELECT id::VARCHAR AS id, state FROM eval_set")
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "report-csv")
    writers.write_csv(L.eval_set(spark, sf_dir).select("id", "state"), path)
    return spark.read.csv(path, header=True)


@query(
    "s12_ingest_manifest",
    """WITH pages AS (
      SELECT o_custkey AS cog_id, CASE WHEN o_orderkey % 3 = 0 THEN 'line' ELSE 'point' END AS feature_type,
        CASE WHEN o_orderkey % 97 = 0 THEN 500 ELSE 200 END AS code,
        CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 4 + 1 END AS n FROM orders),
    agg AS (SELECT cog_id, feature_type, sum(n)::BIGINT AS n_records, max(code) AS response_code,
        bool_or(code <> 200) AS failed, bool_or(code = 200 AND n = 0) AS ended FROM pages GROUP BY ALL)
    SELECT c_custkey AS cog_id, t AS feature_type, response_code::INTEGER AS response_code, coalesce(n_records, 0) AS n_records,
      CASE WHEN n_records > 0 THEN c_custkey || '_' || t || '.json' END AS output_file,
      CASE WHEN failed IS NULL THEN 'empty' WHEN failed THEN 'failed' WHEN ended THEN 'success-done' ELSE 'success' END AS message
    FROM customer CROSS JOIN (VALUES ('line'), ('point')) v(t)
    LEFT JOIN agg ON agg.cog_id = c_custkey AND agg.feature_type = t""",
)
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = {"system": F.lit("sys_1"), "system_version": F.lit("1.0")}
    expected = (
        L.table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("cog_id"),
            F.explode(F.array(F.lit("line"), F.lit("point"))).alias("feature_type"),
        )
        .withColumns(named)
    )
    key = F.col("o_orderkey")
    failed = key % 97 == 0
    pages = (
        L.table(spark, sf_dir, "orders")
        .select(
            F.col("o_custkey").alias("cog_id"),
            F.when(key % 3 == 0, "line").otherwise("point").alias("feature_type"),
            key.alias("page"),
            F.when(failed, 500).otherwise(200).alias("response_code"),
            F.when(failed | (key % 5 == 0), F.lit(0)).otherwise(key % 4 + 1).alias("n_records"),
        )
        .withColumn("output_file", F.concat_ws("", F.col("cog_id").cast("string"), F.lit("_"), "feature_type", F.lit(".json")))
        .withColumns(named)
    )
    return manifest.ingest_status(expected, pages).drop("system", "system_version")


# --- projections and filters ------------------------------------------------------------


@query("p01_select_reorder", L.with_sql(L.BOXES_SQL) + "SELECT y0, x0, fid FROM truth")
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.truths(spark, sf_dir).select("y0", "x0", "fid")


@query("p02_computed_column", L.with_sql(L.BOXES_SQL) + "SELECT fid, (x1 - x0) * (y1 - y0) AS area, x1 - x0 AS w FROM truth")
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.truths(spark, sf_dir).withColumns(
        {"area": F.expr("(x1 - x0) * (y1 - y0)"), "w": F.expr("x1 - x0")}
    ).select("fid", "area", "w")


@query("p03_rename_suffix", "SELECT s_suppkey AS suppkey_grnd, s_name AS name_grnd FROM supplier")
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").withColumnsRenamed(
        {"s_suppkey": "suppkey_grnd", "s_name": "name_grnd"}
    )


@query(
    "p04_boolean_filter",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def p04(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = L.table(spark, sf_dir, "orders").withColumns(
        {
            "message": F.when(F.col("o_orderstatus") == "F", "success-done").otherwise("failed"),
            "data": F.when(F.col("o_orderpriority") == "1-URGENT", "extracted data").otherwise("no-data"),
        }
    )
    return orchestrate.evaluable_files(status).select("o_orderkey", "o_orderstatus")


@query(
    "p05_null_aware_filter",
    RECORDS_SQL + "SELECT fid, CASE line WHEN 3 THEN 1 WHEN 2 THEN 2 ELSE 5 END::BIGINT AS p_num_geom FROM recs WHERE high > 0",
)
def p05(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.with_data(N.projected_features(records(spark, sf_dir)))
    return rows.select(F.col("pattern").alias("fid"), "p_num_geom")


ROUTE_SQL = L.with_sql(L.BOXES_SQL) + """, files AS (
  SELECT DISTINCT id, system FROM perf),
labels AS (SELECT DISTINCT id, geo_value FROM truth UNION SELECT DISTINCT id, 'Z' FROM truth),
syn AS (SELECT id, system, geo_value, count(*) AS n FROM perf
  WHERE id % 5 <> 0 AND (id % 5 <> 1 OR x0 < 0) GROUP BY ALL
  UNION ALL SELECT DISTINCT id, system, 'other', 1 FROM perf WHERE id % 5 = 1),
stats AS (
  SELECT f.id, f.system, count(*) AS total, count(*) FILTER (WHERE s.n IS NULL) AS miss,
    string_agg(CASE WHEN s.n IS NULL THEN l.geo_value END, ',' ORDER BY l.geo_value) AS miss_list,
    (SELECT count(*) FROM syn x WHERE x.id = f.id AND x.system = f.system) > 0 AS valid
  FROM files f JOIN labels l USING (id) LEFT JOIN syn s ON s.id = f.id AND s.system = f.system AND s.geo_value = l.geo_value
  GROUP BY f.id, f.system)
"""


def route_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Performer schema, truth labels and synopsis with direct, crude and invalid files."""
    perf, truth = L.performers(spark, sf_dir), L.truths(spark, sf_dir)
    file_cols = {
        "cog_id": F.col("id").cast("string"),
        "feature_type": F.lit("polygon"),
        "message": F.lit("success-done"),
        "data": F.lit("extracted data"),
    }
    schema = perf.select("id", "system", "system_version").distinct().withColumns(file_cols)
    labels = truth.groupBy("id", "geo_value").agg(F.count("*").alias("count")).unionByName(
        truth.select("id").distinct().select("id", F.lit("Z").alias("geo_value"), F.lit(1).cast("bigint").alias("count"))
    )
    kept = perf.where("id % 5 <> 0 and (id % 5 <> 1 or x0 < 0)")
    counts = kept.groupBy("id", "system", "system_version", "geo_value").agg(F.count("*").alias("count"))
    others = (
        perf.where("id % 5 = 1")
        .select("id", "system", "system_version")
        .distinct()
        .select("*", F.lit("other").alias("geo_value"), F.lit(1).cast("bigint").alias("count"))
    )
    synopsis = counts.unionByName(others).withColumns(
        {"cog_id": file_cols["cog_id"], "feature_type": file_cols["feature_type"]}
    )
    return schema, labels, synopsis


@query(
    "p06_evaluation_router",
    ROUTE_SQL + """SELECT id, system, CASE WHEN valid AND round(miss / total, 3) * 100 < 100 AND total > miss THEN 'direct'
      WHEN valid AND miss = total THEN 'crude' ELSE 'invalid' END AS route FROM stats""",
)
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchestrate.file_orchestration(*route_inputs(spark, sf_dir)).select("id", "system", "route")


@query(
    "p07_membership_filter",
    "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_tax = 0)",
)
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = L.table(spark, sf_dir, "lineitem").where("l_quantity = 50 and l_tax = 0").select(
        F.col("l_suppkey").alias("s_suppkey")
    )
    return L.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").join(wanted, "s_suppkey", "left_semi")


@query(
    "p08_explode",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
)
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "part").select("p_partkey", F.explode_outer(F.split("p_name", " ")).alias("word"))


@query(
    "p09_zipped_explode",
    "SELECT p_partkey, unnest([p_name, p_type]) AS binary_value, unnest([p_brand, 'x']) AS geo_value_vector FROM part",
)
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    zipped = F.arrays_zip(
        F.array("p_name", "p_type").alias("binary_value"), F.array("p_brand", F.lit("x")).alias("geo_value_vector")
    )
    return L.table(spark, sf_dir, "part").select("p_partkey", F.inline(zipped))


def z_sql(x: str, y: str) -> str:
    """Z-order key in SQL, bit by bit."""
    return (
        f"CAST(list_sum(list_transform(range(0, 31), lambda k: (((({x}) >> k) & 1) << (2 * k)) "
        f"+ (((({y}) >> k) & 1) << (2 * k + 1)))) AS BIGINT)"
    )


CELL_BIAS = 1 << 30
CELLS_SQL = L.with_sql(L.BOXES_SQL) + f""", cells AS (
  SELECT fid, id, geo_value, ix, iy, {z_sql(f'ix + {CELL_BIAS}', f'iy + {CELL_BIAS}')} AS fine_cell FROM (
    SELECT *, unnest(range(y0 // {L.CELL}, y1 // {L.CELL} + 1)) AS iy FROM (
      SELECT fid, id, geo_value, x0, y0, x1, y1, unnest(range(x0 // {L.CELL}, x1 // {L.CELL} + 1)) AS ix FROM truth)))
"""


@query(
    "p10_product_explode",
    CELLS_SQL + f"""SELECT a.fid, b.fine_cell >> {2 * L.COARSE_LEVELS} AS coarse_cell, a.fine_cell
      FROM cells a JOIN (SELECT DISTINCT fid, fine_cell >> {2 * L.COARSE_LEVELS} << {2 * L.COARSE_LEVELS} AS fine_cell FROM cells) b USING (fid)""",
)
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = with_cells(L.truths(spark, sf_dir), L.CELL, L.COARSE_LEVELS)
    first = covered.select("fid", F.explode("coarse_cells").alias("coarse_cell"), "fine_cells")
    return first.select("fid", "coarse_cell", F.explode("fine_cells").alias("fine_cell"))


@query(
    "p11_stack_to_columns",
    "SELECT c_custkey, c_name AS label, c_mktsegment AS category, NULL::VARCHAR AS description FROM customer",
)
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = L.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.inline(
            F.array(
                F.struct(F.lit("label").alias("key"), F.col("c_name").alias("value")),
                F.struct(F.lit("category").alias("key"), F.col("c_mktsegment").alias("value")),
            )
        ),
    )
    return N.stack_columns(pairs, ["c_custkey"], "key", "value", ["label", "category", "description"])


@query(
    "p12_row_index",
    L.with_sql(L.BOXES_SQL) + "SELECT id, fid, row_number() OVER (PARTITION BY id ORDER BY fid) - 1 AS ref_index FROM truth",
)
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.row_index(L.truths(spark, sf_dir).select("id", "fid"), ["id"], ["fid"])


@query(
    "p13_constant_columns",
    "SELECT s_suppkey AS id, 'Unknown' AS geom_type, 'corrupt ground-truth shapefile' AS reason, false AS match_binary FROM supplier",
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.lit("Unknown").alias("geom_type"),
        F.lit("corrupt ground-truth shapefile").alias("reason"),
        F.lit(False).alias("match_binary"),
    )


@query(
    "p14_dictionary_lookup",
    "SELECT o_orderkey, c_name AS cog_id, c_name IS NULL AS missing_key FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey <> 3",
)
def p14(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = L.table(spark, sf_dir, "customer").where("c_nationkey <> 3").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("cog_id")
    )
    return L.table(spark, sf_dir, "orders").join(dim, "o_custkey", "left").select(
        "o_orderkey", "cog_id", F.col("cog_id").isNull().alias("missing_key")
    )
