"""Secrets in texts: fixed patterns and a randomness test battery, all in SQL expressions."""

from __future__ import annotations

import math
import string
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.session import materialize

#: The base patterns, with the group whose length counts and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (ASSIGN, 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Encodings in the order they are tried: what a run must look like, least length, alphabet.
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])(?=.*[A-Fa-f])([0-9a-f]+|[0-9A-F]+)$", 24, string.digits + "abcdef"),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", 20, string.ascii_uppercase + "234567"),
    "alnum": (r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", 24, string.digits + string.ascii_lowercase),
    "base64": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$", 20, string.ascii_letters + string.digits + "+/"),
}
#: The statistic is counted in steps of a quarter up to 250.
STEP, TOP = 0.25, 1000
BLOCK = 256


def running_sum(values: Column) -> Column:
    """Sums before each value, in blocks: appending to one array would be quadratic."""

    def sums(array: Column) -> Column:
        return F.aggregate(array, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    n = F.size(values)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(n / BLOCK).cast("int") - 1, F.lit(0))), lambda b: F.slice(values, b * BLOCK + 1, BLOCK)
    )
    inner = F.transform(blocks, sums)
    before = sums(F.transform(inner, lambda s: F.element_at(s, -1)))
    shifted = F.zip_with(inner, F.slice(before, 1, F.size(blocks)), lambda s, b: F.transform(F.slice(s, 1, F.size(s) - 1), lambda x: x + b))
    return F.flatten(shifted)


def located(text: Column, pattern: str, group: int) -> Column:
    """All leftmost non-overlapping matches: ``start, end`` (code points, end exclusive), ``value``.

    The text between matches comes from ``split``, so a running sum of lengths
    gives every start.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(gaps, F.concat(F.array(F.lit(0)), sizes), lambda g, s: g + s)
    # steps[i] = match i-1 and the gap before match i; the sums before i+1 end at start i.
    starts = F.slice(running_sum(F.concat(steps, F.array(F.lit(0)))), 2, F.size(found))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    return F.transform(
        F.arrays_zip(starts.alias("start"), sizes.alias("size"), values.alias("value")),
        lambda m: F.struct(m["start"].alias("start"), (m["start"] + m["size"]).alias("end"), m["value"].alias("value")),
    )


def statistic(run: Column, alphabet: str) -> Column:
    """Distance of a run from a uniformly random string over ``alphabet``.

    The sum of three squared normal scores, about chi-squared with three degrees
    of freedom for a random string: alphabet uniformity (upper side only), runs
    above and below the middle of the alphabet, serial correlation of neighbours.
    """
    k = len(alphabet)
    n = F.length(run).cast("double")
    counts = F.transform(F.array(*map(F.lit, alphabet)), lambda c: n - F.length(F.replace(run, c, F.lit(""))))
    squares = F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c)
    uniform = F.greatest((squares * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n)), F.lit(0.0))

    bits = F.translate(run, alphabet, "0" * (k // 2) + "1" * (k - k // 2))
    ones = n - F.length(F.replace(bits, F.lit("1"), F.lit("")))
    turns = (2 * n - F.length(F.replace(bits, F.lit("01"), F.lit(""))) - F.length(F.replace(bits, F.lit("10"), F.lit("")))) / 2
    product = 2 * ones * (n - ones)
    spread = product * (product - n) / (n * n * (n - 1))
    runs = F.when(spread > 0, (turns + 1 - 1 - product / n) / F.sqrt(spread)).otherwise(F.sqrt(n))

    at = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
    mean = F.aggregate(at, F.lit(0.0), lambda acc, x: acc + x) / n
    around = F.transform(at, lambda x: x - mean)
    power = F.aggregate(around, F.lit(0.0), lambda acc, x: acc + x * x)
    lagged = F.zip_with(F.slice(around, 1, F.size(at) - 1), F.slice(around, 2, F.size(at) - 1), lambda a, b: a * b)
    serial = F.when(power > 0, (F.aggregate(lagged, F.lit(0.0), lambda acc, x: acc + x) / power + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
    return uniform * uniform + runs * runs + serial * serial


def assessed(candidates: Column) -> Column:
    """Candidates with an inferred encoding: ``start, end, stratum, step``."""

    def normal(value: Column, name: str) -> Column:
        return F.lower(value) if name == "hex" else F.translate(value, "-_", "+/") if name == "base64" else value

    encoding, score = F.lit(None).cast("string"), F.lit(None).cast("double")

    def judge(m: Column) -> Column:
        nonlocal encoding, score
        value = m["value"]
        encoding, score = F.lit(None).cast("string"), F.lit(None).cast("double")
        for name, (shape, least, alphabet) in reversed(ENCODINGS.items()):
            fits = value.rlike(shape) & (F.length(value) >= least)
            encoding = F.when(fits, F.lit(name)).otherwise(encoding)
            score = F.when(fits, statistic(normal(value, name), alphabet)).otherwise(score)
        octave = F.least(F.floor(F.log2(F.length(value).cast("double"))), F.lit(10)).cast("string")
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.concat(encoding, F.lit("/"), octave).alias("stratum"),
            F.least(F.floor(score / STEP), F.lit(TOP)).cast("int").alias("step"),
        )

    return F.filter(F.transform(candidates, judge), lambda m: m["stratum"].isNotNull())


def survival(q: float) -> float:
    """Upper tail of chi-squared with three degrees of freedom."""
    return math.erfc(math.sqrt(q / 2)) + math.sqrt(2 * q / math.pi) * math.exp(-q / 2)


def thresholds(histogram: dict[str, dict[int, int]], level: float) -> dict[str, int]:
    """First step that is no longer random, per stratum, by Benjamini-Hochberg.

    The hypothesis is that a run is random; a stratum holds the runs of one
    encoding and one octave of length, since short runs have little power. At
    most a share ``level`` of the runs called structured are truly random.
    """
    limits = {}
    for stratum, counts in histogram.items():
        total, seen, limit = sum(counts.values()), 0, TOP + 1
        for step in sorted(counts, reverse=True):
            seen += counts[step]
            if survival(step * STEP) <= level * seen / total:
                limit = step
        limits[stratum] = limit
    return limits


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", level: float = 0.01) -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of ``start, rank, end, kind``, sorted.

    ``base`` holds the matches of the fixed patterns (assign, access, hex).
    ``added`` holds runs of an inferred encoding that the test battery cannot
    tell from random strings and that overlap no base span (kind random).
    Offsets are code points, ends exclusive. A null text is empty and has no
    spans; a null id stays null; repeated rows are scanned alike; other columns
    are ignored and an empty table gives an empty table.

    Texts are scanned once, into a small table of spans and test results. The
    false-discovery limits come from its histogram: some hundred counts, however
    many candidates there are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def guarded(pattern: str, group: int, present: Column) -> Column:
        return F.when(present, located(text, pattern, group)).otherwise(none)

    def base_of(kind: str) -> Column:
        pattern, group, least = BASE[kind]
        present = F.contains(text, F.lit("AKIA")) if kind == "access" else text.rlike(pattern)
        kept = F.filter(guarded(pattern, group, present), lambda m: F.length(m["value"]) >= least)
        rank = KINDS.index(kind)
        return F.transform(
            kept, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"))
        )

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scanned = materialize(
        source.select(
            "doc_id",
            F.sort_array(F.concat(*[base_of(k) for k in BASE])).alias("base"),
            assessed(guarded(CANDIDATE, 0, text.rlike(CANDIDATE))).alias("tested"),
        ),
        "spans",
    )
    histogram: dict[str, dict[int, int]] = defaultdict(dict)
    for r in scanned.select(F.explode("tested").alias("t")).groupBy("t.stratum", "t.step").count().collect():
        histogram[r["stratum"]][r["step"]] = r["count"]
    limits = thresholds(histogram, level)
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]) if limits else F.create_map(F.lit(""), F.lit(0))
    random = F.filter(
        "tested",
        lambda t: (t["step"] < F.element_at(limit, t["stratum"]))
        & ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    added = F.transform(
        random, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("rank"), t["end"].alias("end"), F.lit("random").alias("kind"))
    )
    return scanned.select("doc_id", "base", F.sort_array(added).alias("added"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
