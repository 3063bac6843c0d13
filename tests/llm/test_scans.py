import math
import random
import re
import string
import zlib

import pytest
from pyspark.sql import functions as F

from cartomark.llm import decontamination as D
from cartomark.llm import license_scan as L
from cartomark.llm import secret_scan as S
from cartomark.llm import toxicity as T

PATTERNS = {"assign": re.compile(S.ASSIGN.replace("(?i)", ""), re.I | re.A), "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+")}


def base_spans(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        _, group, least = S.BASE[kind]
        spans += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(spans)


def random_text(rng):
    parts = ["token", "Secret", "API_KEY", "=", ": ", '"', "'", "short", "abcdefgh12", "AKIA", "AKIAABCDEFGHIJKL", "0123456789abcdef" * 2, "é🙂", " ", "\n", "g", "="]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(60)))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [random_text(rng) for _ in range(150)] + [None, "", "token=" + "x" * 9 + " é token=abcdefgh " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("base", F.lit("clash"))
    got = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in S.scan_secrets(docs).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(texts)}


def statistic(value, alphabet):
    k, n = len(alphabet), len(value)
    counts = [value.count(c) for c in alphabet]
    uniform = max(0.0, (sum(c * c for c in counts) * k / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n)))
    bits = [alphabet.index(c) >= k // 2 for c in value]
    ones, turns = sum(bits), sum(a != b for a, b in zip(bits, bits[1:], strict=False))
    product = 2 * ones * (n - ones)
    spread = product * (product - n) / (n * n * (n - 1))
    runs = (turns - product / n) / math.sqrt(spread)
    at = [alphabet.index(c) for c in value]
    mean = sum(at) / n
    power = sum((x - mean) ** 2 for x in at)
    serial = (sum((a - mean) * (b - mean) for a, b in zip(at, at[1:], strict=False)) / power + 1 / n) * math.sqrt(n)
    return uniform**2 + runs**2 + serial**2


def test_the_battery_equals_its_formulas(spark):
    rng = random.Random(2)
    values = ["".join(rng.choice(S.ENCODINGS["hex"][2]) for _ in range(n)) for n in (24, 40, 64, 300)]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", S.statistic(F.col("v"), S.ENCODINGS["hex"][2]).alias("q")).collect()
    for r in rows:
        assert r["q"] == pytest.approx(statistic(r["v"], S.ENCODINGS["hex"][2]))


def test_random_runs_are_found_and_structured_ones_not(spark):
    rng = random.Random(3)
    letters = string.ascii_letters + string.digits
    secret = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(60)]
    plain = ["Aa1" + "reconsiderationreconsiderations" + "e" * (i % 9) for i in range(60)] + ["Aa1" + "ab" * 20 for _ in range(60)]
    rows = [(i, f"see {v} here") for i, v in enumerate(secret + plain)]
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["added"]] for r in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[i] == [(4, 44)] for i in range(60)) >= 57
    assert sum(bool(found[i]) for i in range(60, 180)) == 0


def test_discovery_limits():
    limits = S.thresholds({"x": {0: 90, 400: 10}, "y": {4: 5}}, 0.01)
    assert limits == {"x": 400, "y": S.TOP + 1}
    assert S.survival(0) == 1 and S.survival(7.815) == pytest.approx(0.05, abs=1e-4)


def test_odd_rows_have_no_secrets(odd_docs, no_docs):
    rows = S.scan_secrets(odd_docs).collect()
    assert len(rows) == 10 and all(r["base"] == [] and r["added"] == [] for r in rows)
    assert S.scan_secrets(no_docs).count() == 0


NOTICE = "This work is licensed under the GNU General Public License, version 3."


def test_licenses_equal_brute_force(spark):
    rng = random.Random(4)
    words = "license version the under a of this work software gnu public general".split()
    rows, want = [], set()
    for i in range(60):
        text = [rng.choice(words) + rng.choice(["", ",", "."]) for _ in range(rng.randrange(80))]
        if i % 3 == 0:
            name, notice = L.TEMPLATES[i // 3 % len(L.TEMPLATES)]
            cut = rng.randrange(len(text) + 1)
            text[cut:cut] = notice.upper().split() if i % 2 else notice.split()
        rows.append((i, " ".join(text), "x"))
    tables = {i: (name, notice) for i, (name, notice) in enumerate(L.TEMPLATES)}
    split = lambda t: re.findall(r"[^\W_]+", t.lower())
    shingles = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    for i, text, _ in rows:
        mine = shingles(split(text))
        for name, notice in tables.values():
            theirs = set(shingles(split(notice)))
            if any(len(theirs & set(mine[k : k + len(theirs)])) >= 0.8 * len(theirs) for k in range(len(mine))):
                want.add((i, name))
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = {(r["doc_id"], r["license"]) for r in L.scan_licenses(docs).collect()}
    assert want <= got and len(want) >= 18
    assert all(i % 3 == 0 for i, _ in got)


def test_a_changed_notice_is_still_found(spark):
    changed = "We say: " + L.TEMPLATES[3][1].replace("distributed on an", "shipped on an") + " and more " * 30
    other = "This work is licensed under terms that we made up for this very purpose."
    got = L.scan_licenses(spark.createDataFrame([(1, changed), (2, other), (3, NOTICE)], "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"]) for r in got} >= {(3, "GPL-3.0")} and all(r["doc_id"] != 2 for r in got)


def test_odd_rows_have_no_license(odd_docs, no_docs, spark):
    assert L.scan_licenses(odd_docs).count() == 0 and L.scan_licenses(no_docs).count() == 0
    twice = spark.createDataFrame([(1, NOTICE), (1, NOTICE), (None, NOTICE)], "doc_id long, text string")
    assert [(r["doc_id"], r["license"]) for r in L.scan_licenses(twice).collect()] == [(1, "GPL-3.0")]


ITEM = "A train leaves Boston at 9 km distance and then the driver named Alice counts 40 kg of apples before Bob arrives with 12 more apples for her"
REPEATED = "the clerk named Alice sold bread and then Alice went home while later Alice told nobody about it"
BENCH = "item_id long, text string, doc_id string"


def test_leaks_verbatim_renamed_and_inconsistent(spark):
    renamed = ITEM.replace("Boston", "Paris").replace("Alice", "Maria").replace("Bob", "Ivan").replace("40", "71").replace("12", "8")
    mixed = "we saw that " + ITEM.replace("Alice", "Bob") + " and Alice too"
    filler = " ".join(f"filler{i} words" for i in range(40))
    docs = [(1, f"{filler} {ITEM} {filler}"), (2, f"{filler}. {renamed}, {filler}"), (3, filler), (4, ITEM.upper()), (5, mixed), (6, " ".join(ITEM.split()[:9]))]
    # One value replaced by three others: no thirteen words are left once the windows that contradict are dropped.
    docs += [(20, REPEATED.replace("Alice", "Maria", 1).replace("Alice", "Eve", 1).replace("Alice", "Zoe")), (21, REPEATED.replace("Alice", "Maria"))]
    docs += [(7, None), (8, ""), (None, ITEM), (1, f"{filler} {ITEM} {filler}")]
    bench = spark.createDataFrame([(10, ITEM, "z"), (11, None, "z"), (12, "too short", "z"), (13, REPEATED, "z"), (None, ITEM, "z")], BENCH)
    table = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, item_id string, pos string")
    got = {r["doc_id"]: r for r in D.find_leaks(table, bench).collect()}
    # Document 5 repeats thirteen words of the item before the name that contradicts.
    assert {d: r["item_id"] for d, r in got.items()} == {1: 10, 2: 10, 4: 10, 5: 10, 21: 13}
    assert got[1]["n_changed"] == 0 and got[2]["n_changed"] == 5 and got[1]["coverage"] == 1.0


def leaks(spark, docs, items):
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in D.find_leaks(table, bench).collect()}


def test_windows_beside_a_contradiction_still_leak(spark):
    fruit = "we know that someone bought 3 apples from the shop and later sold 3 pears to the neighbours who live there"
    sums = "the sum that someone must pay for 3 ripe apples is 5 coins and nobody knows whether that price is fair"
    other = "here that contradicts 3 then 7 with none of the item at all"
    docs = [ITEM.replace("Alice", "Bob"), fruit.replace("3 pears", "9 pears"), sums.replace("3", "4").replace("5", "4"), other]
    got = leaks(spark, docs, [ITEM, fruit, sums])
    assert set(got) == {(0, 0), (1, 1), (2, 2)}
    assert got[2, 2]["n_slots"] == got[2, 2]["n_changed"] == 2


def test_items_full_of_slots_or_very_short_are_found_verbatim(spark):
    items = [
        "What is 12 + 7 * 3 - 4 / 2 ?",
        "In 1990 2000 2010 and 2020 which city won the prize",
        "add 3 to 9",
        "Kyzyl gorge",
        "他们昨天在北京大学的图书馆里读了三本书",
        "12 kg 7 km 3 m 4 s 9 t 1 mg 2 g 5 l",
    ]
    docs = [f"some words before it {x} and other words after it" for x in items]
    docs += [x.replace("12", "13").replace("1990", "1991").replace("3", "8") for x in docs[:3]] + [items[5].upper(), "前言" + items[4] + "后记"]
    got = set(leaks(spark, docs, items))
    assert {(i, i) for i in range(6)} | {(9, 5), (10, 4)} <= got
    # Too few plain words for a template: only a verbatim copy counts.
    assert not {(6, 0), (8, 2)} & got


def test_leaks_equal_brute_force_on_plain_words(spark):
    rng = random.Random(5)
    vocabulary = [a + b for a in "bcdfghklm" for b in ("ato", "ire", "une", "ola")]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(14, 40))) for i in range(12)]
    rows, want = [], set()
    for d in range(50):
        parts = [text(rng.randrange(40))]
        if d % 3 == 0:
            item, words = rng.choice(items)[0], None
            words = items[item][1].split()
            take = len(words) if d % 2 else 13
            parts.append(" ".join(w + rng.choice(["", "&&&", "."]) for w in words[:take]))
            want.add((d, item))
        rows.append((d, " ".join([*parts, text(20)])))
    got = D.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_leaks_of_empty_tables(spark, odd_docs, no_docs):
    bench, none = spark.createDataFrame([(1, ITEM, "z")], BENCH), spark.createDataFrame([], BENCH)
    assert D.find_leaks(no_docs, bench).count() == D.find_leaks(odd_docs, none).count() == D.find_leaks(odd_docs, bench).count() == 0


def labelled(spark, n=400):
    rng = random.Random(6)
    words = ["river", "stone", "garden", "window", "yellow", "market", "paper", "engine", "summer", "letter"]
    bad = ["dreckig", "vermin", "grotling"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(60)]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(bad) + rng.choice(["", "s", "en"])
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_a_lexicon_is_learned_and_sees_through_disguise(spark):
    docs, labels = labelled(spark)
    scored = T.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in scored if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored)
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in scored)
    model = T.learn(T.training_sample(docs, labels, sample_rows=1000, folds=3, fold_out=1))
    disguised = [(1, "river stone v3rm1n garden vеrmin gr0t|ing"), (2, "river stone garden window yellow market")]
    got = T.score_documents(spark.createDataFrame(disguised, "doc_id long, text string"), model).collect()
    assert [r["predicted"] for r in sorted(got)] == [1, 0]


def test_exception_phrases_do_not_count():
    matcher = T.Matcher({T.fold("trash"): 3.0}, ("trash can",))
    assert matcher.features("the trash can is full")[0] == 0 and matcher.features("you trash")[0] > 0
    assert matcher.features("x")[0] == T.Matcher({}, ()).features("x")[0] == 0


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    _, labels = labelled(spark, 1)
    odd_labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    for rows in (labels, odd_labels, odd_labels.where("false")):
        got = T.classify(odd_docs, rows)
        assert got.columns == odd_docs.columns + ["held_out", "predicted"] and dict(got.dtypes)["score"] == "double"
        assert all(r["predicted"] == 0 for r in got.collect())
    assert T.classify(no_docs, odd_labels).count() == 0


def test_plain_words_are_read_without_patterns(monkeypatch):
    tokens = ["word", "Name", "Name,", "mm", "mm.", "End!", "Éa", "éA?", "über;", "a", "A.", "ǅx", "漢字", "ªb:"]
    others = ["", ".", "..", "a..", '"Quote"', "x1", "12", "1,000.", "5kg", "5%", "it's", "_a", "a_", "é1.", "+3.5", "--", "a.b", "Ⅷ", "²"]

    def slowly(token):
        core = D._EDGE.sub("", token)
        tail = token[token.rfind(core) + len(core) :] if core else token
        ends = any(c in ".!?" for c in tail)
        if not core:
            return "", "", -1, -1, ends
        if D._NUMBER.fullmatch(core) or D._NUMBER_UNIT.fullmatch(core):
            return core, core, 1, 1, ends
        low = core.lower()
        if low in D.UNITS:
            return low, low, 2, 2, ends
        return low, low, 3 if core[0].isupper() else 0, 0, ends

    want = [slowly(t) for t in tokens]
    assert [D.canonical(t) for t in others] == [slowly(t) for t in others]
    for name in ("_EDGE", "_NUMBER", "_NUMBER_UNIT"):
        monkeypatch.setattr(D, name, None)
    assert [D.canonical(t) for t in tokens] == want
