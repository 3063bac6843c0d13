"""Small helpers shared by the tests."""

import random

from pyspark.sql import functions as F

from cartomark.functions import geometry as G

BOX_COLS = "id int, geo_value string, fid string, x0 double, y0 double, x1 double, y1 double"


def boxes(spark, rows, extra=""):
    """Feature rows with a ``bbox`` from corner values."""
    rows = [(*r[:3], *map(float, r[3:7]), *r[7:]) for r in rows]
    df = spark.createDataFrame(rows, BOX_COLS + extra)
    return df.withColumn("bbox", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).drop("x0", "y0", "x1", "y1")


def random_boxes(rng: random.Random, n: int, prefix: str, ids=2, labels="ab", span=400.0, big=0.05):
    rows = []
    for i in range(n):
        x, y = rng.uniform(-span, span), rng.uniform(-span, span)
        reach = 600.0 if rng.random() < big else 30.0
        rows.append(
            (rng.randrange(ids), rng.choice(labels), f"{prefix}{i}", x, y, x + rng.uniform(0, reach), y + rng.uniform(0, reach))
        )
    return rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
