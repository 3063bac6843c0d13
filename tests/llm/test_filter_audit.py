import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from cartomark.llm import filter_audit as A

DOCS = "doc_id long, text string, source string, part string, mask string, n string"
LABELS = "doc_id long, quality int, toxic int, id string"


def masks(rows):
    """For each row the letters it fails, straight from the definition."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text))]
        fails.append(doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in rows))
        out.append({x for x, f in zip("ABCDE", fails, strict=True) if f})
    return out


def brute_audit(rows, labels):
    good = {d for d, q, _, *_ in labels if d is not None and q == 1}
    toxic = {d for d, _, t, *_ in labels if d is not None and t == 1}
    parts = {r[2] or "" for r in rows}
    found = {}
    for part in parts:
        of_part = [(r, f) for r, f in zip(rows, masks(rows), strict=True) if (r[2] or "") == part]
        shares = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = of_part
            for step, x in enumerate(order, 1):
                gone = [r for r, f in left if x in f]
                left = [(r, f) for r, f in left if x not in f]
                failing = sum(x in f for _, f in of_part)
                only = sum(f == {x} for _, f in of_part)
                shares[x] += len(gone)
                found[part, order, step] = [len(left), len(gone), failing - len(gone), only, sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), x]
        for key, row in found.items():
            if key[0] == part:
                row[-1] = shares[row[-1]]
    return found


def audited(docs, labels):
    got = A.audit(A.failure_histogram(docs, labels)).collect()
    keys = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = {(r["part"], r["filter_order"], r["step"]): [r[k] for k in keys] for r in got}
    assert len(found) == len(got)
    return found


def test_audit_equals_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n ", "word " * 250, "SHOUT " * 250, " ".join(f"w{i}" for i in range(220)), " ".join(f"w{i}" for i in range(199)), "a | b", "é" * 49 + "A", "é" * 48 + "AB"]
    texts += [" ".join(rng.choice(["x", "Y", "zz", "#", "ü"]) + str(rng.randrange(300)) for _ in range(rng.choice([5, 150, 400]))) for _ in range(12)]
    rows = [(rng.randrange(40) if rng.random() < 0.9 else None, rng.choice(texts), rng.choice(["a", "b", None, ""]), "p", "m", "n") for _ in range(150)]
    rows += [(50 + i, texts[3], "a", "p", "m", "n") for i in range(40)] + [rows[0]] * 3
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in [*range(0, 90, 2), 4, 4, None]]
    got = audited(spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS))
    assert got == brute_audit(rows, labels)


def test_audit_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    got = audited(odd_docs, none)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    assert got == brute_audit(rows, [])
    assert audited(no_docs, none) == {}


@pytest.mark.parametrize("m", [1, 2, 3, 5])
def test_least_squares_gives_the_mean_over_all_orders(m):
    rng = random.Random(m)
    values = [0, *(rng.randrange(-50, 1000) for _ in range(2**m - 1))]
    orders = list(itertools.permutations(range(m)))
    for f, share in enumerate(A.shapley(values, m)):
        total = 0
        for order in orders:
            before = sum(1 << x for x in order[: order.index(f)])
            total += values[before | 1 << f] - values[before]
        assert share * len(orders) == total


def test_other_filters_and_losses(spark):
    rows = [("p", 0, 5, 1), ("p", 3, 2, 2), ("p", None, 1, 0), ("p", 1, None, 4), (None, 2, 7, None)]
    got = A.audit(spark.createDataFrame(rows, "part string, mask int, n long, seen long"), "XY", ["seen"])
    first = {(r["part"], r["filter_order"]): r for r in got.where(F.col("step") == 1).collect()}
    assert (first["p", "XY"]["kept"], first["p", "XY"]["removed"], first["p", "XY"]["seen_lost"], first["p", "XY"]["shapley"]) == (6, 2, 6, 2)
    assert first[None, "YX"]["removed"] == 7 and got.count() == 8
