"""Matching of labels: raster labels to field values, predictions to labels, ontologies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartomark.functions import text as T
from cartomark.functions.geometry import USE_SPATIAL_INDEX, boxes_intersect
from cartomark.functions.projection import UNITS, unit_lookup
from cartomark.functions.text import sequence_ratio
from cartomark.operators.balance import first_per_key
from cartomark.operators.similarity import best_matches, similar_pairs, tfidf_cosine
from cartomark.operators.spatial import score_boxes, spatial_pairs
from cartomark.session import materialize

NOT_IN_DICTIONARY = "Not in Dictionary"
NOT_IN_TRUTH = "Does Not Exist In Ground-Truth"
CORRUPT_TRUTH = "corrupt ground-truth shapefile"

#: Point and line labels with their kind and other names (fixed values).
ONTOLOGY: list[tuple[str, str, list[str]]] = [
    ("Pit", "Point", ["Pit", "1_pt"]),
    ("Mine Shaft", "Point", ["Mine Shaft", "2_pt", "shaft"]),
    ("Prospect", "Point", ["3_pt", "prospect pit", "prospect"]),
    ("Mine Tunnel", "Point", ["Mine Tunnel", "4_pt", "adit"]),
    ("Quarry", "Point", ["5_pt", "1_pt", "quarry"]),
    (
        "Inclined Bedding",
        "Point",
        ["strike and dip", "bedding", "bedding_pt", "bedding_inclined_pt", "inclined bedding"],
    ),
    ("Overturned Bedding", "Point", ["overturned", "bedding_overturned_pt"]),
    ("Horizontal Bedding", "Point", ["horiz bedding", "horizontal bedding", "flat bedding"]),
    ("Vertical Bedding", "Point", ["vertical", "bedding vertical"]),
    ("Bedding and Foliation", "Point", ["bedding and foliation"]),
    ("Bedding", "Point", ["bedding", "bedding w/tops", "crumpled bedding"]),
    ("Inclined Foliation", "Point", ["foliation", "inclined metamorphic foliation"]),
    (
        "Inclined Foliation Igneous",
        "Point",
        ["igneous foliation", "inclined flow banding", "inclined igneous"],
    ),
    ("Vertical Foliation", "Point", ["vert foliation", "foliation vertical"]),
    ("Foliation", "Point", ["foliation"]),
    ("Lineation", "Point", ["lineation pt", "plunge direction"]),
    ("Vertical Joint", "Point", ["joint vertical"]),
    ("Sink Hole", "Point", ["sink hole"]),
    (
        "Drill Hole",
        "Point",
        ["drillhole", "well pt", "Saprolite_pt", "paleomag_reversed_pt"],
    ),
    ("Gravel Pit", "Point", ["1_pt", "Pit"]),
    ("Inclined Metamorphic", "Point", ["inclined_foliation_pt"]),
    (
        "Inclined Foliation Metamorphic",
        "Point",
        ["inclined foliation", "inclined metamorphic", "metamorphic foliation"],
    ),
    ("Inclined Flow Banding", "Point", ["inclined_foliation_igneous"]),
    (
        "Drill Hole Filled",
        "Point",
        [
            "loc_strat_section_pt",
            "Crystalline_rocks_pt",
            "well_pt",
            "coll_breccia_pipe_pt",
            "sample_locality_pt",
            "drill hole filled",
        ],
    ),
    (
        "Fault",
        "LineString",
        [
            "fault_line",
            "normal_fault_line",
            "left_lat_slip_fault_line",
            "strike_slip_fault_line",
            "wrench_fault_line",
            "hi_angle_fault_line",
            "lo_angle_fault_line",
            "nrlssfault_line",
            "strike-slip_fault_line",
            "generic_fault_line",
            "normal_rl_ss_fault_line",
            "wrfault_line",
            "sinistral_strike-slip_fault_line",
            "reverse",
            "inferred",
            "normal fault",
        ],
    ),
    ("Thrust Fault", "LineString", ["Thrust fault line"]),
    ("Contour", "LineString", ["Contour_line"]),
]


def ontology_table(spark: SparkSession) -> DataFrame:
    """``(label, feature_type, alias)`` rows of the fixed ontology."""
    rows = [(label, kind, alias) for label, kind, aliases in ONTOLOGY for alias in aliases]
    return spark.createDataFrame(rows, "label string, feature_type string, alias string")


def ontology_from_csv(rows: DataFrame) -> DataFrame:
    """Ontology rows from a table with a comma list of other names."""
    return rows.select(
        "label",
        "ftr_type",
        "geometry_type",
        F.explode_outer(T.split_trimmed(F.col("alternate_example"))).alias("alt_name"),
    )


# --- raster labels against the text fields of vector files --------------------------


def match_field_values(
    labels: DataFrame, values: DataFrame, ontology: DataFrame, threshold: float = 0.9
) -> DataFrame:
    """Field value of each map's raster labels in its vector files.

    ``labels``: id, binary_value. ``values``: id, shp_file, geom_kind (``polygon``
    or other), field_name, field_pos, value, read_corrupt. Polygon labels outside the
    ontology take the first field (in order) with a value above the threshold,
    as written before stripped of non-word characters. Point and line labels go
    through their ontology names: equal names before similar ones.
    """
    clean = values.where("read_corrupt = 'no_corrupt' and value is not null").distinct()
    wanted = labels.select("id", "binary_value").distinct()
    known = ontology.select(F.col("label").alias("binary_value")).distinct()

    # Polygons: the label itself, in two spellings.
    poly_labels = wanted.join(known, "binary_value", "left_anti")
    poly_values = clean.where("geom_kind = 'polygon'")

    def polygon_tier(tier: int, method: str, spell) -> DataFrame:
        left = poly_labels.withColumn("_l", spell(F.col("binary_value")))
        right = poly_values.withColumn("_r", spell(F.col("value")))
        hits = similar_pairs(left, right, ["id"], threshold, left_text="_l", right_text="_r")
        return (
            hits.join(left, ["id", "_l"])
            .join(right, ["id", "_r"])
            .withColumns(
                {
                    "_tier": F.lit(tier),
                    "match_method": F.lit(method),
                    "geom_type": F.lit("Polygon"),
                }
            )
        )

    polygons = polygon_tier(0, "sequence", F.lower).unionByName(
        polygon_tier(
            1,
            "sequence-regex",
            lambda c: F.replace(T.strip_nonword(F.lower(c)), F.lit("_"), F.lit(" ")),
        )
    )
    first_field = first_per_key(
        polygons,
        ["id", "shp_file", "binary_value"],
        [F.asc("field_pos"), F.asc("_tier"), F.desc("ratio"), F.asc("value")],
    )

    # Points and lines: every ontology name of the label.
    aliases = (
        wanted.join(ontology.withColumnRenamed("label", "binary_value"), "binary_value")
        .withColumn("_l", T.to_words(F.col("alias")))
        .select("id", "binary_value", "feature_type", "_l")
        .distinct()
    )
    other_values = clean.where("geom_kind <> 'polygon'").withColumn("_r", T.to_words(F.lower("value")))
    equal = (
        aliases.join(other_values.withColumn("_l", F.col("_r")), ["id", "_l"])
        .withColumn("ratio", F.lit(1.0))
        .withColumn("_tier", F.lit(0))
        .withColumn("match_method", F.lit("naive-regex-ontology"))
    )
    near = similar_pairs(
        aliases, other_values, ["id"], threshold, left_text="_l", right_text="_r"
    )
    near = (
        near.where("ratio < 1")
        .join(aliases, ["id", "_l"])
        .join(other_values, ["id", "_r"])
        .withColumn("_tier", F.lit(1))
        .withColumn("match_method", F.lit("sequence-regex-ontology"))
    )
    named = equal.unionByName(near).withColumnRenamed("feature_type", "geom_type")
    best_named = first_per_key(
        named,
        ["id", "shp_file", "binary_value"],
        [F.desc("ratio"), F.asc("field_pos"), F.asc("_tier"), F.asc("value")],
    )
    out = [
        "id",
        "binary_value",
        "field_name",
        F.col("value").alias("geo_value_vector"),
        F.col("ratio").alias("matched_ratio"),
        "shp_file",
        "match_method",
        "geom_type",
        F.lit("no_corrupt").alias("read_corrupt"),
    ]
    return first_field.select(*out).unionByName(best_named.select(*out))


def group_matches(matches: DataFrame) -> DataFrame:
    """Matched values as parallel lists per file, field, method and kind."""
    keys = ["id", "shp_file", "field_name", "match_method", "geom_type", "read_corrupt"]
    item = F.struct("binary_value", "geo_value_vector", "matched_ratio")
    grouped = matches.groupBy(*keys).agg(F.array_sort(F.collect_set(item)).alias("_m"))
    return grouped.select(
        *keys,
        F.transform("_m", lambda m: m["binary_value"]).alias("binary_value"),
        F.transform("_m", lambda m: m["geo_value_vector"]).alias("geo_value_vector"),
        F.transform("_m", lambda m: m["matched_ratio"]).alias("matched_ratio"),
    )


def unmatched_labels(labels: DataFrame, matches: DataFrame) -> DataFrame:
    """Labels without a match: one row per id and label."""
    wanted = labels.select("id", "binary_value").distinct()
    return wanted.join(matches.select("id", "binary_value"), ["id", "binary_value"], "left_anti").select(
        "id", F.col("binary_value").alias("unmatched_binary")
    )


def success_rates(labels: DataFrame, matches: DataFrame) -> DataFrame:
    """Share of each map's labels that found a match, to three decimals."""
    wanted = labels.select("id", "binary_value").distinct()
    found = matches.select("id", "binary_value").distinct().withColumn("_hit", F.lit(1))
    counts = (
        wanted.join(found, ["id", "binary_value"], "left")
        .groupBy("id")
        .agg(F.count("binary_value").alias("n_labels"), F.count("_hit").alias("n_matched"))
    )
    rate = F.coalesce(F.try_divide(F.col("n_matched"), F.col("n_labels")), F.lit(0.0))
    return counts.withColumn("success_rate", F.round(rate, 3))


def compile_labels(matches: DataFrame, unmatched: DataFrame) -> DataFrame:
    """All labels with their vector value and ratio, null for the unmatched."""
    cols = ["binary_value", "geo_value_vector", "matched_ratio"]
    left = unmatched.select(F.col("unmatched_binary").alias("binary_value"))
    return (
        matches.select(*cols).dropDuplicates(cols).unionByName(left, allowMissingColumns=True)
    )


def crude_matches(
    unmatched: DataFrame, file_kinds: DataFrame, ontology: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Files of the same geometry kind for unmatched labels, and reasons for the rest.

    ``unmatched``: id, unmatched_binary, read_corrupt. ``file_kinds``: id, shp_file,
    geom_type.
    """
    kinds = ontology.select(
        F.col("label").alias("unmatched_binary"), F.col("feature_type").alias("geom_type")
    ).distinct()
    rows = unmatched.join(kinds, "unmatched_binary", "left").join(
        file_kinds, ["id", "geom_type"], "left"
    )
    corrupt = F.col("read_corrupt") != "no_corrupt"
    tagged = rows.withColumn(
        "reason",
        F.when(corrupt, CORRUPT_TRUTH)
        .when(F.col("geom_type").isNull(), NOT_IN_DICTIONARY)
        .when(F.col("shp_file").isNull(), NOT_IN_TRUTH),
    )
    matched = tagged.where("reason is null").select("id", "unmatched_binary", "geom_type", "shp_file")
    kind = F.when(F.col("reason") == NOT_IN_TRUTH, F.col("geom_type")).otherwise(F.lit("Unknown"))
    rest = (
        tagged.where("reason is not null")
        .select("id", "unmatched_binary", kind.alias("geom_type"), "reason")
        .distinct()
    )
    return matched, rest


def ontology_report(values: DataFrame, onto: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Best label, feature type and other name of each value, with geometry type.

    ``values``: geo_value; ``onto``: label, ftr_type, geometry_type, alt_name.
    """
    tall = onto.select(
        "geometry_type",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("field"), F.col(c).alias("match"))
                    for c in ("label", "ftr_type", "alt_name")
                ]
            )
        ),
    ).where("match is not null")
    geometry = tall.groupBy("field", "match").agg(F.min("geometry_type").alias("geometry_type"))
    wanted = (
        values.select("geo_value")
        .distinct()
        .select(
            "geo_value",
            F.lower("geo_value").alias("value"),
            F.explode(F.array(F.lit("label"), F.lit("ftr_type"), F.lit("alt_name"))).alias("field"),
        )
    )
    best = best_matches(wanted, geometry, ["field"], threshold, right_text="match")
    return (
        wanted.join(best, ["field", "value"])
        .join(geometry, ["field", "match"])
        .select("geo_value", "field", "match", F.col("ratio").alias("threshold"), "geometry_type")
    )


def match_units(rows: DataFrame, unit: str = "unit") -> DataFrame:
    """Metres per unit name: exact name first, else the most similar one.

    Adds ``metres``, ``unit_matched`` and ``unit_similarity``. The best name always
    counts, however low its ratio; ties go to the first name by spelling. Only the
    distinct names are matched, each with the fixed list of units.
    """
    wanted = rows.select(F.col(unit).alias("value")).where("value is not null").distinct()
    exact = wanted.withColumns(
        {
            "unit_matched": F.col("value"),
            "unit_similarity": F.lit(1.0),
            "metres": unit_lookup(F.col("value"), by="name"),
        }
    )
    names = F.array(*[F.lit(n) for _, n, _ in UNITS])
    scored = exact.where("metres is null").select("value", F.explode(names).alias("candidate"))
    scored = scored.withColumn("ratio", sequence_ratio(F.col("value"), F.col("candidate")))
    near = first_per_key(scored, ["value"], [F.desc("ratio"), F.col("candidate")])
    near = near.select(
        "value",
        F.col("candidate").alias("unit_matched"),
        F.col("ratio").alias("unit_similarity"),
        unit_lookup(F.col("candidate"), by="name").alias("metres"),
    )
    found = exact.where("metres is not null").unionByName(near)
    return rows.join(found.withColumnRenamed("value", unit), unit, "left")


def key_value_matches(values: DataFrame, onto: DataFrame, threshold: float) -> DataFrame:
    """Best ontology key and other name per group, by sequence and by word cosine.

    ``values``: id, value; ``onto``: id, label, alias. One row per id and method with
    the value of the highest score above the threshold.
    """
    keys = onto.select("id", F.col("label").alias("key")).distinct()
    names = onto.select("id", F.col("alias").alias("key")).distinct()
    found = None
    for kind, table in (("key", keys), ("value", names)):
        near = similar_pairs(table, values, ["id"], threshold, left_text="key", right_text="value")
        near = near.withColumn("method", F.lit(f"sequence-ontology_{kind}"))
        cosine = word_cosine_pairs(table, values, threshold).withColumn(
            "method", F.lit(f"cosine-ontology_{kind}")
        )
        both = near.unionByName(cosine)
        found = both if found is None else found.unionByName(both)
    return first_per_key(
        found, ["id", "method"], [F.desc("ratio"), F.asc("key"), F.asc("value")]
    ).select("id", "method", "key", "value", F.round("ratio", 9).alias("ratio"))


def word_cosine_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs of equal id that share a word and whose TF-IDF cosine exceeds the threshold.

    Texts without a common word have cosine 0, so pairs come from a join on words.
    """
    lefts = left.select("id", "key").distinct()
    rights = right.select("id", "value").distinct()
    pairs = (
        lefts.select("id", "key", F.explode(F.array_distinct(T.tokens(F.col("key")))).alias("_w"))
        .join(
            rights.select("id", "value", F.explode(F.array_distinct(T.tokens(F.col("value")))).alias("_w")),
            ["id", "_w"],
        )
        .select("id", F.col("key").alias("a_id"), F.col("value").alias("b_id"))
        .distinct()
    )
    texts = lefts.select(F.col("key").alias("id")).union(rights.select("value")).distinct()
    scored = tfidf_cosine(pairs, texts.withColumn("text", F.col("id")))
    return scored.where(F.col("cosine") > threshold).select(
        "id", F.col("a_id").alias("key"), F.col("b_id").alias("value"), F.col("cosine").alias("ratio")
    )


# --- predictions to labels -------------------------------------------------------------


def assign_by_abbreviation(
    features: DataFrame, matched: DataFrame, crude: DataFrame, threshold: float = 0.9, method: str = "sequence"
) -> DataFrame:
    """Label of each feature from its abbreviation, by falling tiers.

    ``matched``: id, geo_value_vector; ``crude``: id, unmatched_binary. The tier is
    kept in ``match_binary``: true for the matched table, false for the crude
    table or for the marker to search spatially.
    """
    names = features.select("id", T.to_spaced(F.col("abbreviation")).alias("value")).distinct()

    def tier(table: DataFrame, column: str, out: str) -> DataFrame:
        known = table.select("id", F.col(column).alias(f"{out}_value")).distinct()
        known = known.withColumn("candidate", F.lower(f"{out}_value"))
        best = best_matches(names, known, ["id"], threshold, method=method)
        spelled = first_per_key(known, ["id", "candidate"], [F.asc(f"{out}_value")])
        return best.join(spelled, ["id", "candidate"]).select(
            "id", "value", f"{out}_value", F.col("ratio").alias(f"{out}_ratio")
        )

    found = (
        names.join(tier(matched, "geo_value_vector", "direct"), ["id", "value"], "left")
        .join(tier(crude, "unmatched_binary", "crude"), ["id", "value"], "left")
        .select(
            "id",
            "value",
            F.coalesce("direct_value", "crude_value", F.lit(USE_SPATIAL_INDEX)).alias("geo_value"),
            F.coalesce("direct_ratio", "crude_ratio").alias("matched_ratio"),
            F.col("direct_value").isNotNull().alias("match_binary"),
        )
    )
    return (
        features.withColumn("value", T.to_spaced(F.col("abbreviation")))
        .join(found, ["id", "value"], "left")
        .withColumn("geo_value", F.coalesce("geo_value", F.lit(USE_SPATIAL_INDEX)))
        .withColumn("match_binary", F.coalesce("match_binary", F.lit(False)))
        .drop("value")
    )


def assign_by_legend(features: DataFrame, legend: DataFrame, cell: float) -> DataFrame:
    """Label of each feature from the legend item its box overlaps most.

    ``features``: cog_id, bbox (null when absent); ``legend``: cog_id, item, bbox,
    abbreviation, label. Distinct boxes meet by grid cell; a box that meets none
    takes the map's first item at 0. Without a box or a legend the feature keeps
    the marker to search spatially.
    """
    label = F.coalesce(
        F.nullif(T.strip_nonword(F.col("abbreviation")), F.lit("")), T.strip_nonword(F.col("label"))
    )
    # An item listed twice labels its features twice, so its names are a list.
    named = legend.groupBy("cog_id", "item").agg(
        F.collect_list(F.struct(label.alias("_name"))).alias("_names"), F.collect_set("bbox").alias("_boxes")
    )
    known = F.when(F.col("item").isNotNull(), F.struct("item", "_names"))
    items = named.select("cog_id", F.explode("_boxes").alias("bbox"), known.alias("_item"))
    items = items.groupBy("cog_id", "bbox").agg(F.min("_item").alias("item"))
    pairs = score_boxes(
        spatial_pairs(
            features.where("bbox is not null").select("cog_id", "bbox").distinct(),
            items, ["cog_id"], cell, condition=boxes_intersect(F.col("p_bbox"), F.col("g_bbox")),
        )
    ).where("iou_units > 0")
    met = pairs.groupBy("cog_id", F.col("p_bbox").alias("bbox")).agg(
        F.min(F.struct((-F.col("iou_units")).alias("u"), F.col("g_item").alias("item"))).alias("_m")
    )
    met = met.select("cog_id", "bbox", (-F.col("_m.u")).alias("_units"), F.col("_m.item._names").alias("_names"))
    # One row per map, written, so that its size is known: while it is small, it goes to the features.
    first = named.where(F.size("_boxes") > 0).groupBy("cog_id").agg(F.min(known).alias("_first"))
    first = materialize(first.select("cog_id", F.col("_first._names").alias("_first")), "first-items")
    missed = F.col("_units").isNull()
    names = F.when(~missed, F.col("_names")).when(F.col("bbox").isNotNull(), F.col("_first"))
    columns = ["cog_id", "bbox", *[c for c in features.columns if c not in ("cog_id", "bbox")]]
    return (
        features.join(met, ["cog_id", "bbox"], "left")
        .join(first, "cog_id", "left")
        .withColumns({"_names": names, "_units": F.when(names.isNotNull(), F.coalesce("_units", F.lit(0).cast("bigint")))})
        .select(*columns, "_units", F.explode_outer("_names").alias("_of"))
        .withColumns(
            {
                "geo_value": F.coalesce("_of._name", F.lit(USE_SPATIAL_INDEX)),
                "legend_iou": F.col("_units") / F.lit(1000.0),
                "match_binary": F.when(F.col("bbox").isNull(), F.lit(False)),
            }
        )
        .drop("_of", "_units")
    )
