import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FAST = ["flagship_iou_by_map_and_performer", "p06_evaluation_router", "j16_pattern_containment", "t11_readable_size", "g03_pixel_and_coordinate", "s12_ingest_manifest"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 110


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "system", "n_matched", "iou_mean", "iou_median"]
    assert df.count() > 0


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("supplier", "nation", "customer", "orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = entry.queries()[name](spark, SF).toArrow()
    want = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(want.column_names)

    def rows(table):
        return sorted(tuple(repr(r[n]) for n in names) for r in table.to_pylist())

    assert rows(got) == rows(want)
