"""Toxicity by a learned, weighted lexicon matched with Aho-Corasick."""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters that look like Latin ones, and the Latin letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ᴏ": "o",
}
#: Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "|": "i"}
#: Soft hyphen, zero-width characters and the byte order mark are dropped.
INVISIBLE = "­​‌‍⁠﻿"
#: ``1`` stands for i and for l, so both letters fold to one.
FOLDED = str.maketrans(
    HOMOGLYPHS | SUBSTITUTES | {"l": "i"} | {chr(0xFF41 + k): chr(97 + k) for k in range(26)} | {"ｌ": "i"} | dict.fromkeys(INVISIBLE, "")
)
#: Phrases that hold a lexicon word but are no insult.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "sore loser", "pond scum", "soap scum")
MIN_PREFIX, MAX_PREFIX = 4, 12
#: Counts a task holds before it hands on its sums so far.
PARTIAL_ENTRIES = 300_000
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case, look-alikes and digits as the letters they stand for."""
    return text.lower().translate(FOLDED)


@dataclass(frozen=True)
class Model:
    """Weights by folded word beginning, exception phrases, and the logistic curve."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]


class Matcher:
    """Finds lexicon words in a folded text, the longest at each word's start."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            self.automaton.add_word(entry, (len(entry), weight))
        self.allowed = ahocorasick.Automaton()
        for phrase in exceptions:
            self.allowed.add_word(fold(phrase), len(phrase))
        for automaton in (self.automaton, self.allowed):
            if len(automaton):
                automaton.make_automaton()

    def features(self, text: str) -> tuple[float, float, float]:
        """Weight per hundred words, weight in all (both damped), log of the length."""
        folded = fold(text)
        words = max(1, len(folded.split()))
        hits: dict[int, tuple[int, float]] = {}
        if len(self.automaton):
            for end, (size, weight) in self.automaton.iter(folded):
                start = end - size + 1
                if (start == 0 or not folded[start - 1].isalnum()) and hits.get(start, (0, 0.0))[0] < size:
                    hits[start] = (size, weight)
        if hits and len(self.allowed):
            for end, size in self.allowed.iter(folded):
                for start in [s for s in hits if end - size + 1 <= s <= end]:
                    del hits[start]
        total = sum(w for _, w in hits.values())
        return math.log1p(100 * total / words), math.log1p(total), math.log(words)


def _held_out(id_col: Column, folds: int, fold_out: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(folds)) == fold_out


def training_sample(docs: DataFrame, labels: DataFrame, *, sample_rows: int, folds: int, fold_out: int) -> DataFrame:
    """``text, toxic`` of at most ``sample_rows`` labelled documents outside the held-out fold.

    The rows with the smallest hash of their id, so the sample does not depend on
    partitioning. Its ids and labels are the only broadcast: ``sample_rows`` pairs.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out(F.col("doc_id"), folds, fold_out))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def learn(sample: DataFrame, *, lexicon_size: int = 2000, min_toxic: int = 5, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Weights of word beginnings that toxic documents hold far oftener than others.

    A beginning's weight is the logarithm of the ratio of the two shares of
    documents that hold it, less 2.33 standard errors. At most ``lexicon_size``
    candidates reach the driver. A beginning is dropped where a longer one covers
    nearly the same documents, or a shorter kept one covers it. The curve is a
    logistic regression on the three features of each sampled document.
    Without toxic and other rows to learn from, every score is 0.
    """

    def beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def partial(counts: tuple[Counter, Counter], sizes: list[int]) -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array([*keys, None], pa.string()), *(pa.array([*(counts[c][k] for k in keys), sizes[c]], pa.int64()) for c in (1, 0))],
                ["entry", "toxic", "other"],
            )

        counts, sizes = (Counter(), Counter()), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                words = set(_WORD.findall(fold(text.as_py())))
                label = toxic.as_py() > 0
                counts[label].update({w[:k] for w in words for k in range(MIN_PREFIX, min(len(w), MAX_PREFIX) + 1)})
                sizes[label] += 1
                if len(counts[0]) + len(counts[1]) > PARTIAL_ENTRIES:
                    yield partial(counts, sizes)
                    counts, sizes = (Counter(), Counter()), [0, 0]
        yield partial(counts, sizes)

    counted = sample.mapInArrow(beginnings, "entry string, toxic long, other long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    ).persist()
    total = counted.where("entry is null").first()
    if total is None or not total["toxic"] or not total["other"]:
        counted.unpersist()
        return Model({}, exceptions, (-20.0, 0.0, 0.0, 0.0))
    ratio = F.log((F.col("toxic") + 0.5) / (total["toxic"] + 1)) - F.log((F.col("other") + 0.5) / (total["other"] + 1))
    bound = ratio - 2.33 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    best = (
        counted.where(F.col("entry").isNotNull() & (F.col("toxic") >= min_toxic))
        .withColumn("weight", bound)
        .where("weight > 1")
        .orderBy(F.desc("toxic"), "entry")
        .limit(lexicon_size)
        .collect()
    )
    counted.unpersist()
    rows = {r["entry"]: (r["toxic"], r["weight"]) for r in best}
    longer = Counter()
    for entry, (toxic, _) in rows.items():
        longer[entry[:-1]] = max(longer[entry[:-1]], toxic)
    lexicon: dict[str, float] = {}
    for entry in sorted(rows, key=lambda e: (len(e), e)):
        toxic, weight = rows[entry]
        if longer[entry] < 0.95 * toxic and not any(entry[:k] in lexicon for k in range(MIN_PREFIX, len(entry))):
            lexicon[entry] = float(weight)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, exceptions)
        for batch in batches:
            found = np.array([matcher.features(t) for t in batch.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*(pa.array(found[:, k]) for k in range(3)), batch.column(1)], ["a", "b", "c", "toxic"])

    points = sample.mapInArrow(measured, "a double, b double, c double, toxic int").toPandas().sort_values(["a", "b", "c", "toxic"])
    return Model(lexicon, exceptions, logistic(points[["a", "b", "c"]].to_numpy(), (points["toxic"] > 0).to_numpy(dtype=float)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 50) -> tuple[float, ...]:
    """Intercept and slopes of a ridge-penalised logistic regression, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * beta
        curvature = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curvature, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def score_documents(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Every input column plus ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``).

    Whole texts are scored, map-only; a null text is scored as an empty one.
    Input columns named like the two results are replaced. Equal texts get equal
    scores; an empty table gives an empty table.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(model.lexicon, model.exceptions)
        b0, *slopes = model.curve
        for texts in batches:
            z = [b0 + sum(s * f for s, f in zip(slopes, matcher.features(t or ""), strict=True)) for t in texts]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -30, 30))))

    scored = docs.withColumn("score", score(F.col(f"`{text_col}`")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 20_000, folds: int = 3, fold_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """Learn from labelled documents outside the held-out fold and score all.

    Adds ``held_out``, ``score`` and ``predicted``. A row without an id is never
    learned from and not held out.
    """
    model = learn(training_sample(docs, labels, sample_rows=sample_rows, folds=folds, fold_out=fold_out))
    return score_documents(docs.withColumn("held_out", _held_out(F.col("doc_id"), folds, fold_out)), model, threshold=threshold)
