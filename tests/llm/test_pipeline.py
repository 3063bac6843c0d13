import corpus_pipeline as P

import __spark_entry__ as entry
from cartomark.session import materialize

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_the_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in P.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == COLUMNS and docs.count() <= before
        before = docs.count()
    packed = P.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, odd_docs, SF)
        assert got.columns == odd_docs.columns, name
        assert got.where("doc_id is null").count() == 2, name
        assert stage(spark, no_docs, SF).count() == 0, name
    # A sentence and its triple share 11 of 15 shingles, which is below 0.8: both stay.
    assert {r["doc_id"] for r in P.drop_near_duplicates(spark, odd_docs, SF).collect()} == {1, 2, 5, 6, 7, None}


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert {"op3_exact_top_k", "op5_line_dedup", "op12_ranked_lexical_search", "op13_filter_interaction_audit"} <= set(entry.oracle_sql())


def test_extra_columns_may_be_maps(spark):
    docs = spark.sql("select id as doc_id, 'some words that two rows share' as text, map('k', id) as tags from range(2)")
    assert [r["doc_id"] for r in P.drop_near_duplicates(spark, docs, SF).collect()] == [0]


def test_a_copy_of_similarity_above_four_fifths_goes(spark):
    words = [f"word{i}" for i in range(300)]
    edited = [w if i % 50 else "other" for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words[150:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in P.drop_near_duplicates(spark, docs, SF).orderBy("doc_id").collect()] == [1, 3]


def test_rows_that_repeat_an_id_are_decided_by_their_own_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, b), (1, c), (1, c), (2, a), (3, a), (3, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, b), (1, c), (2, a)]
