import numpy as np
import pytest
from pyspark.sql import functions as F

from cartomark.functions import geometry as G
from cartomark.operators import cover


@pytest.mark.parametrize("top", [0, 1, 3, 10])
def test_runs_become_the_largest_aligned_cells(top):
    rng = np.random.default_rng(top)
    rows, c0, c1, base = [], [], [], set()
    for row in range(0, 70):
        at = int(rng.integers(0, 20))
        while at < 90:
            end = at + int(rng.integers(0, 60))
            rows.append(row)
            c0.append(at)
            c1.append(end)
            base |= {(row, c) for c in range(at, end + 1)}
            at = end + 2 + int(rng.integers(0, 9))
    seen = set()
    for level, r, a, b in cover.quadtree_runs(np.array(rows), np.array(c0), np.array(c1), top):
        for row, x, y in zip(r.tolist(), a.tolist(), b.tolist(), strict=True):
            for col in range(x, y + 1):
                held = {(row << level | i, col << level | j) for i in range(1 << level) for j in range(1 << level)}
                assert not held & seen
                seen |= held
                # No cell's parent is full, or the parent would be there instead.
                up = {((row >> 1) << (level + 1) | i, (col >> 1) << (level + 1) | j) for i in range(2 << level) for j in range(2 << level)}
                assert level == top or not up <= base
    assert seen == base


def shapes(spark, rows):
    df = spark.createDataFrame(rows, "fid string, kind string, c array<array<array<double>>>")
    return df.select("fid", G.geometry(F.col("kind"), F.transform("c", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))).alias("geom"))


def test_slanted_shapes_lines_and_points(spark):
    diamond = [[[0.0, -40.5], [63.2, 0.3], [0.0, 41.1], [-63.4, 0.3], [0.0, -40.5]]]
    hole = [[[-100.0, -100.0], [100.0, -100.0], [100.0, 100.0], [-100.0, 100.0], [-100.0, -100.0]], [[-50.0, -50.0], [50.0, -50.0], [50.0, 50.0], [-50.0, 50.0], [-50.0, -50.0]]]
    rows = [("d", "polygon", diamond), ("h", "polygon", hole), ("l", "line", [[[0.5, 0.5], [10.5, 5.5]]]), ("p", "point", [[[3.5, -7.5]]]), ("e", "polygon", [])]
    got = cover.compact_cover(shapes(spark, rows), 1.0).groupBy("fid").agg(F.count("*").alias("rows"), F.sum(F.pow(F.lit(4), F.col("level"))).cast("long").alias("cells"))
    got = {r.fid: (r.rows, r.cells) for r in got.collect()}
    assert set(got) == {"d", "h", "l", "p"} and got["p"] == (1, 1)
    assert got["h"][1] == 201 * 201 - 99 * 99 and got["h"][0] < 2500
    area = 2 * 63.3 * 40.8
    assert area < got["d"][1] < area + 2 * (127 + 82) and got["d"][0] < got["d"][1] / 4
    # Every cell that a dense walk along the line meets is there.
    walked = {(int(np.floor(0.5 + 10 * t)), int(np.floor(0.5 + 5 * t))) for t in np.linspace(0, 1, 5001)}
    assert len(walked) <= got["l"][1] <= len(walked) + 4


def test_features_of_one_name_and_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(f"f{i % 25}", "line", [[[0.5, 0.5 + i], [0.5, 30.5 + i]]]) for i in range(50)]
        got = cover.compact_cover(shapes(spark, rows), 1.0)
        assert got.count() == got.distinct().count()
        cells = {r.fid: r.n for r in got.groupBy("fid").agg(F.sum(F.pow(F.lit(4), F.col("level"))).cast("long").alias("n")).collect()}
        assert cells == {f"f{i}": 56 for i in range(25)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
