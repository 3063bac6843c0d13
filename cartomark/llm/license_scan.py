"""License notices found by MinHash bands over overlapping windows, in SQL expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Notices as their licenses print them, and short forms in use.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: One hash per band: a window sharing half its shingles with a template collides in
#: one of 16 bands with probability 1 - 0.5**16, one sharing 0.8 with 1 - 0.2**16.
BANDS = 16


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_at(words: Column, i: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(size)])


def shingles_of(words: Column, size: int) -> Column:
    """Shingle hashes in order; none where there are fewer words than ``size``."""
    return F.when(
        F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: shingle_at(words, i, size))
    ).otherwise(F.array().cast("array<long>"))


def minhash(window: Column, bands: int) -> Column:
    def least(band: int) -> Column:
        return F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.lit(band))))

    return F.array(*[least(band) for band in range(bands)])


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...], shingle_words: int, bands: int) -> DataFrame:
    """``template, license, shingles, width, bands`` of each notice."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    words = rows.withColumn("words", words_of(F.col("text")))
    shingled = words.withColumn("shingles", F.array_distinct(shingles_of(F.col("words"), shingle_words))).withColumn("width", F.size("shingles"))
    return shingled.where("width > 0").withColumn("bands", minhash(F.col("shingles"), bands))


def scan_licenses(
    docs: DataFrame,
    *,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    containment: float = 0.8,
    bands: int = BANDS,
) -> DataFrame:
    """License notices in whole texts: ``doc_id, license, containment, n_windows, first_word``.

    For each template width, windows of that many shingles overlap by three
    quarters, so one window lies within an eighth of any occurrence. A window
    sharing a MinHash band with a template retrieves it; the template is
    reported if at least ``containment`` of its shingles stand in the window or
    within one width around it. A band can only be shared through a shingle of
    the template, so windows without any template shingle are skipped unhashed;
    that loses nothing.

    One row per document and license, with the best containment, the number of
    verified windows and the word where the first of them begins. Null, empty
    and short texts hold nothing. Rows without an id are left out. Repeated rows
    give one row, and rows repeating an id are scanned each and reported
    together. Other columns are ignored; an empty table gives an empty table.
    The template list is the caller's own and is broadcast.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates, shingle_words, bands)
    known = table.select("words", "shingles", "width").collect()
    vocabulary = sorted({w for r in known for w in r["words"]})
    hashes = sorted({h for r in known for h in r["shingles"]})
    widths = sorted({r["width"] for r in known})

    def may_start(words: Column, i: Column) -> Column:
        found = F.get(words, i).isin(vocabulary)
        for k in range(1, shingle_words):
            found &= F.get(words, i + k).isin(vocabulary)
        return found & shingle_at(words, i, shingle_words).isin(hashes)

    def hits_in(words: Column) -> Column:
        last = F.size(words) - shingle_words
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda i: may_start(words, i))

    text = F.col(f"`{text_col}`")
    # A lambda over a one-element array binds the words once; a filter on them in
    # a later step would be pushed down and would split the text again per word.
    bound = F.transform(F.array(words_of(text)), lambda w: F.struct(hits_in(w).alias("hits"), w.alias("words")))
    hit = (
        docs.where(F.col(f"`{id_col}`").isNotNull() & text.isNotNull())
        .select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.xxhash64(text).alias("version"),
            F.explode(F.filter(bound, lambda b: F.size(b["hits"]) > 0)).alias("b"),
        )
        .select("doc_id", "version", "b.hits", shingles_of(F.col("b.words"), shingle_words).alias("shingles"))
    )

    def windows_of(width: int) -> Column:
        step = max(1, width // 4)
        starts = F.array_distinct(
            F.flatten(
                F.transform(
                    "hits",
                    lambda p: F.transform(
                        F.sequence(F.greatest(F.ceil((p - width + 1) / step), F.lit(0)), F.floor(p / step)), lambda k: (k * step).cast("int")
                    ),
                )
            )
        )
        return F.transform(
            starts,
            lambda s: F.struct(
                F.lit(width).alias("width"),
                s.alias("start"),
                F.slice("shingles", s + 1, F.lit(width)).alias("inside"),
                F.slice("shingles", F.greatest(s - width, F.lit(0)) + 1, F.lit(3 * width)).alias("around"),
            ),
        )

    windows = hit.select("doc_id", "version", F.explode(F.concat(*[windows_of(w) for w in widths])).alias("w")).select("doc_id", "version", "w.*")
    banded = windows.select("doc_id", "version", "width", "start", "around", F.posexplode(minhash(F.col("inside"), bands)).alias("band", "value"))
    templated = table.select("template", "license", "shingles", F.col("width"), F.posexplode("bands").alias("band", "value"))
    # The templates are a list the caller holds, so this broadcast has a proven bound;
    # verified at once, candidates shuffle without their shingles.
    share = F.size(F.array_intersect("shingles", "around")) / F.size("shingles")
    verified = banded.join(F.broadcast(templated), ["width", "band", "value"]).select(
        "doc_id", "license", "start", F.struct("version", "width", "start").alias("window"), share.alias("containment")
    )
    return (
        verified.where(F.col("containment") >= containment)
        .groupBy("doc_id", "license")
        .agg(
            F.max("containment").alias("containment"),
            F.countDistinct("window").alias("n_windows"),
            F.min("start").cast("long").alias("first_word"),
        )
    )
