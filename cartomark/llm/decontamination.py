"""Benchmark decontamination by canonical template windows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartomark.llm.common import slices
from cartomark.session import materialize

#: Units that may follow a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg lb oz t ml l s sec secs min mins h hr hrs ms hz khz mhz ghz w kw mw v a k c f pa kpa bar j kj "
    "cal kcal mol n px kb mb gb tb percent dollars dollar euros euro pounds pound cents cent yen meters metres meter metre "
    "kilometers kilometres grams gram kilograms liters litres hours hour minutes minute seconds second days day weeks week "
    "months month years year miles mile feet foot inches inch degrees degree mph kmh".split()
)
#: Positions of the filter over benchmark windows: 512 KB, however large the benchmark.
FILTER_BITS = 1 << 22
#: Letters of scripts written without spaces: each is a token.
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*\d|\d")
_NUMBER_UNIT = re.compile(r"([+-]?\d[\d.,]*)([^\W\d_]+|%)")
_MARKS = frozenset(".,;:!?")
PLACEHOLDERS = {1: "<number>", 2: "<unit>", 3: "<name>"}
WINDOWS = "key long, pos int, hash long, size int, words int, slots array<string>"


def canonical(token: str) -> tuple[str, str, int, int, bool]:
    """How a token reads: inside a sentence, at its start, the two kinds, ends one?

    Kinds: 0 word, 1 number, 2 unit, 3 name, -1 nothing but punctuation. A
    capitalised word is a name unless it starts a sentence.
    """
    # Most tokens are letters, with one mark behind at most: no pattern needs to look at them.
    mark = token[-1:] if token[-1:] in _MARKS else ""
    core = token[:-1] if mark else token
    if core.isalpha():
        low = core.lower()
        ends = mark != "" and mark in ".!?"
        if low in UNITS:
            return low, low, 2, 2, ends
        if core[0].isupper():
            return low, low, 3, 0, ends
        return low, low, 0, 0, ends
    core = _EDGE.sub("", token)
    tail = token[token.rfind(core) + len(core) :] if core else token
    ends = any(c in ".!?" for c in tail)
    if not core:
        return "", "", -1, -1, ends
    if _NUMBER.fullmatch(core) or _NUMBER_UNIT.fullmatch(core):
        return core, core, 1, 1, ends
    low = core.lower()
    if low in UNITS:
        return low, low, 2, 2, ends
    if core[0].isupper():
        return low, low, 3, 0, ends
    return low, low, 0, 0, ends


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def template_windows(source: DataFrame, *, sizes: tuple[int, ...], min_words: int, keep: np.ndarray | None, key_col: str, text_col: str) -> DataFrame:
    """Windows of canonical tokens: ``key, pos, hash, size, words, slots``.

    Numbers, units and names become typed placeholders before hashing; ``slots``
    holds their values in order. A unit counts as one only behind a number.
    Windows with names come a second time with the names as plain words, so that
    an upper-cased or lower-cased copy still meets its item, and windows with any
    slot once more with all values as words, so that a verbatim copy meets its
    item however many slots it has. Windows with fewer than ``min_words`` plain
    words (or their whole size, if smaller) say nothing as templates and come only
    with their values. ``keep`` is a bit filter of window
    hashes; without it every window is returned. ``words`` is the number of
    tokens of the whole text.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        constants = {k: xxhash.xxh64_intdigest(v) for k, v in PLACEHOLDERS.items()}
        for batch in slices(batches, 1, 4 << 20):
            text = pc.fill_null(batch.column(1), "")
            if pc.any(pc.match_substring_regex(text, _UNSPACED)).as_py():
                text = pc.replace_substring_regex(text, _UNSPACED, r" \1 ")
            lists = pc.utf8_split_whitespace(text)
            coded = pc.list_flatten(lists).dictionary_encode()
            names = coded.dictionary.to_pylist()
            forms = [canonical(t) for t in names]
            kinds = np.array([[f[2], f[3]] for f in forms], dtype=np.int8).reshape(-1, 2)
            ends = np.array([f[4] for f in forms], dtype=bool)
            hashes = np.array([xxhash.xxh64_intdigest(f[0]) for f in forms], dtype=np.uint64)
            token = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            if not len(token):
                continue
            first = np.diff(doc, prepend=-1) != 0
            at_start = first | np.concatenate([[True], ends[token[:-1]]])
            kind = kinds[token, at_start.astype(np.int8)]
            real = kind >= 0
            token, doc, kind = token[real], doc[real], kind[real]
            if not len(token):
                continue
            first = np.diff(doc, prepend=-1) != 0
            after_number = np.concatenate([[False], kind[:-1] == 1]) & ~first
            kind = np.where((kind == 2) & ~after_number, 0, kind)
            counts = np.bincount(doc, minlength=batch.num_rows)
            begin = np.cumsum(counts) - counts
            named = np.concatenate([[0], np.cumsum(kind == 3)])
            slotted = np.concatenate([[0], np.cumsum(kind > 0)])
            out = []
            # With names as placeholders, then as words (case may be lost in either text), then all values as words.
            for read, kinds_read in enumerate((kind, np.where(kind == 3, 0, kind), np.zeros_like(kind))):
                value = hashes[token]
                for k, h in constants.items():
                    value = np.where(kinds_read == k, np.uint64(h), value)
                value = _mix(value)
                plain = np.concatenate([[0], np.cumsum(kinds_read == 0)])
                for size in sizes:
                    n = len(token) - size + 1
                    if n <= 0:
                        continue
                    good = doc[:n] == doc[size - 1 :]
                    if read < 2:
                        good &= plain[size:] - plain[:n] >= min(min_words, size)
                    if read:
                        some = named if read == 1 else slotted
                        good &= some[size:] > some[:n]
                    at = np.flatnonzero(good)
                    h = np.zeros(len(at), dtype=np.uint64)
                    for k in range(size):
                        h = _mix(h + value[at + k])
                    if keep is not None:
                        place = (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                        kept = (keep[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                        at, h = at[kept], h[kept]
                    for i, hashed in zip(at.tolist(), h.view(np.int64).tolist(), strict=True):
                        slots = [_EDGE.sub("", names[token[j]]).lower() for j in range(i, i + size) if kinds_read[j] > 0]
                        out.append((doc[i], i - begin[doc[i]], hashed, size, counts[doc[i]], slots))
            if out:
                d, pos, h, size, words, slots = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(d)),
                        pa.array(pos, pa.int32()),
                        pa.array(h, pa.int64()),
                        pa.array(size, pa.int32()),
                        pa.array(words, pa.int32()),
                        pa.array(slots, pa.list_(pa.string())),
                    ],
                    ["key", "pos", "hash", "size", "words", "slots"],
                )

    return source.select(F.col(f"`{key_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").alias("text")).mapInArrow(rows, WINDOWS)


def window_filter(windows: DataFrame) -> np.ndarray:
    """Bit filter over window hashes, built by Spark in pieces of 4 KB: 512 KB in all."""
    place = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    pieces = (
        windows.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for piece in pieces:
        data = np.frombuffer(piece["bits"], dtype=np.uint8)
        at = (piece["bucket"] - 1) * len(data)
        bits[at : at + len(data)] = data
    return bits


def chosen(windows: Column) -> Column:
    """Slot pairs ``(item value, document value)`` that rename each item value to one document value.

    Of several document values of an item value the one in most windows is
    taken; ties go to the unchanged value, then to the least.
    """
    pairs = F.flatten(F.transform(windows, lambda w: w["pairs"]))
    known = F.array_distinct(pairs)
    voted = F.transform(
        known,
        lambda p: F.struct(
            p["item"].alias("item"),
            F.struct((-F.size(F.filter(pairs, lambda x: x == p))).alias("votes"), (p["item"] != p["doc"]).alias("changed"), p["doc"].alias("doc")).alias("rank"),
        ),
    )
    best = F.filter(voted, lambda p: ~F.exists(voted, lambda q: (q["item"] == p["item"]) & (q["rank"] < p["rank"])))
    values = F.array_distinct(F.transform(known, lambda p: p["item"]))
    return F.when(F.size(values) == F.size(known), known).otherwise(
        F.transform(best, lambda p: F.struct(p["item"].alias("item"), p["rank"]["doc"].alias("doc")))
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 8,
    min_words: int = 5,
    leak_words: int = 13,
) -> DataFrame:
    """Documents holding benchmark items, verbatim or with other slot values.

    Returns ``doc_id, item_id, n_windows, coverage, n_slots, n_changed``. Texts
    are read as canonical tokens; windows of ``window`` tokens meet by a hash
    join behind a bit filter of fixed size. A document leaks an item if the
    windows it shares cover ``leak_words`` of the item's tokens (or the whole
    item, if shorter). Along one alignment the same number, unit or name is
    always replaced by the same other; windows that contradict this do not count,
    unless all their values are unchanged. Several values may become one.

    Items shorter than ``window`` are compared whole, those of fewer than four
    tokens only verbatim.
    Null or empty texts hold nothing. Rows without an id cannot be reported and
    are left out, as are items without one; repeated rows give one result row.
    Other columns are ignored; empty tables give an empty result.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("item_id is not null")
    whole = {"min_words": min_words, "keep": None, "key_col": "item_id", "text_col": "text"}
    sizes = tuple(range(1, window + 1))
    # A size below the window serves only the items of just that many tokens.
    found = materialize(
        template_windows(items, sizes=sizes, **whole)
        .where((F.col("size") == window) | (F.col("words") == F.col("size")))
        .where((F.col("size") >= 4) | (F.size("slots") == 0)),
        "windows",
    )
    used = tuple(sorted(r["size"] for r in found.select("size").distinct().collect()))
    mine = found.select(
        F.col("key").alias("item_id"), "hash", "size", F.col("pos").alias("item_pos"), F.col("words").alias("item_words"), F.col("slots").alias("item_slots")
    )
    # The whole windows of all documents never travel: those outside the filter cannot match.
    theirs = template_windows(
        docs.where(F.col(f"`{id_col}`").isNotNull()),
        sizes=used or (window,),
        min_words=min_words,
        keep=window_filter(found),
        key_col=id_col,
        text_col=text_col,
    ).select(F.col("key").alias("doc_id"), "hash", "size", "pos", "slots")
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
    aligned = (
        theirs.join(mine, ["hash", "size"])
        .groupBy("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(
            F.collect_set(F.struct("item_pos", pairs.alias("pairs"))).alias("windows"),
            F.max("size").alias("size"),
            F.max("item_words").alias("item_words"),
        )
        .withColumn("_chosen", chosen(F.col("windows")))
        .withColumn(
            "windows",
            F.filter(
                "windows",
                lambda w: F.forall(w["pairs"], lambda p: p["item"] == p["doc"]) | F.forall(w["pairs"], lambda p: F.array_contains("_chosen", p)),
            ),
        )
        .withColumn("places", F.array_distinct(F.transform("windows", lambda w: w["item_pos"])))
        .withColumn("pairs", F.array_distinct(F.flatten(F.transform("windows", lambda w: w["pairs"]))))
    )
    covered = F.array_distinct(
        F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("size") - 1)))
    )
    return (
        aligned.select("doc_id", "item_id", "item_words", "pairs", "places", F.explode(covered).alias("word"))
        .groupBy("doc_id", "item_id")
        .agg(
            F.countDistinct("word").alias("_covered"),
            F.max("item_words").alias("_words"),
            F.max(F.size("places")).cast("long").alias("n_windows"),
            F.max(F.size("pairs")).cast("long").alias("n_slots"),
            F.max(F.size(F.filter("pairs", lambda p: p["item"] != p["doc"]))).cast("long").alias("n_changed"),
        )
        .where(F.col("_covered") >= F.least(F.lit(leak_words), F.col("_words")))
        .select("doc_id", "item_id", "n_windows", (F.col("_covered") / F.col("_words")).alias("coverage"), "n_slots", "n_changed")
    )
