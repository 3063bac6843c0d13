"""Ranked lexical search by the Best Position Algorithm over impact lists."""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartomark.llm.common import slices
from cartomark.session import materialize

#: Terms are runs of ASCII letters, digits and bytes of other characters; A-Z are lower-cased, all else parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
#: Item texts of one pass over the documents: their terms are all that a task receives.
QUERY_BYTES = 8 << 20
#: Postings of a stored segment (3 MB), and of the impact lists that are searched at once.
SEGMENT, INDEX = 1 << 18, 1 << 20
#: Entries read from each list in the first round; each next round reads twice as many.
FIRST_READ = 8


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a list for each piece of about ``PIECE`` bytes."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` of ``counts[i]`` numbers each, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    keep = np.lexsort((ids, -scores))[:k]
    return ids[keep], scores[keep]


class ImpactLists:
    """Postings of some documents, by document and as lists of falling impact by term.

    ``starts`` cuts ``terms, tfs`` by document; ``weights`` has a whole number
    for each term; a posting's impact is its share of the score.
    """

    def __init__(self, ids, lengths, starts, terms, tfs, weights, n_docs: int, n_terms: int):
        self.ids, self.starts, self.terms = ids, starts, terms
        rows = np.repeat(np.arange(len(ids)), np.diff(starts))
        if 90 * int(lengths.max(initial=0)) * n_docs >= 2**63:
            lengths = lengths.astype(object)
        norm = np.asarray(10 + (90 * lengths * n_docs) // max(n_terms, 1), dtype=np.int64)
        tfs = tfs.astype(np.int64)
        self.impacts = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * norm[rows]))
        order = np.lexsort((rows, -self.impacts, terms))
        self.list_rows, self.list_impacts = rows[order], self.impacts[order]
        self.list_starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        # Where in its list a posting stands: direct access gives impact and position.
        self.places = np.empty(len(order), dtype=np.int64)
        self.places[order] = np.arange(len(order))
        self.member, self.seen = np.zeros(len(weights), dtype=bool), np.zeros(len(order), dtype=bool)

    def search(self, terms: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The best ``k`` of these documents and those given, and how many were scored.

        Each round reads on in every list of ``terms`` from its best position, the
        end of its unbroken run of seen entries, and looks every new document up in
        all lists, which marks its entries there as seen too. A document not seen
        stands behind every best position, so the impacts found there add up to
        the most it can score; the search stops once that is strictly below the
        k-th score, as an equal score may come with a smaller id.
        """
        ends = self.list_starts[terms + 1]
        at = self.list_starts[terms]
        terms, at, ends = terms[ends > at], at[ends > at], ends[ends > at]
        begins, evaluated, read = at.copy(), np.zeros(len(self.ids), dtype=bool), FIRST_READ
        self.member[terms] = True
        while True:
            open_lists = at < ends
            most = int(self.list_impacts[at[open_lists]].sum())
            if most <= 0 or (len(ids) == k and most < scores[-1]):
                break
            new = self.list_rows[ranges(at, np.minimum(read, ends - at))]
            new = np.unique(new[~evaluated[new]])
            evaluated[new] = True
            counts = self.starts[new + 1] - self.starts[new]
            entries, owners = ranges(self.starts[new], counts), np.repeat(np.arange(len(new)), counts)
            kept = self.member[self.terms[entries]]
            entries, owners = entries[kept], owners[kept]
            self.seen[self.places[entries]] = True
            # Sums of whole numbers below 2**53 are exact.
            found = np.bincount(owners, weights=self.impacts[entries], minlength=len(new)).astype(np.int64)
            good = found >= (scores[-1] if len(ids) == k else 1)
            ids, scores = best_of(np.append(ids, self.ids[new[good]]), np.append(scores, found[good]), k)
            for i in np.flatnonzero(open_lists):
                run = self.seen[at[i] : ends[i]]
                ahead = int(run.argmin())
                at[i] = ends[i] if run[ahead] else at[i] + ahead
            read *= 2
        self.member[terms] = False
        for a, b in zip(begins, ends, strict=True):
            self.seen[a:b] = False
        return ids, scores, int(evaluated.sum())


def segments(ids: dict[bytes, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of the terms in ``ids`` of whole texts, document by document."""
    docs, lengths, ends, terms, tfs, totals = [], [], [0], [], [], [0, 0]

    def segment() -> pa.RecordBatch:
        kinds = zip((docs, lengths, ends, terms, tfs), ("<i8", "<i8", "<i8", "<i4", "<i4"), strict=True)
        arrays = [pa.array([np.array(x, dtype=t).tobytes()], pa.binary()) for x, t in kinds]
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in totals), *arrays], ["n_docs", "n_terms", "ids", "lengths", "starts", "terms", "tfs"])

    for batch in batches:
        for part in slices([batch], 1):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                counts: Counter[bytes] = Counter()
                for words in terms_of(text.as_py()):
                    counts.update(words)
                n = counts.total()
                totals[0] += n > 0
                totals[1] += n
                if hits := counts.keys() & ids.keys():
                    docs.append(doc)
                    lengths.append(n)
                    terms += [ids[w] for w in hits]
                    tfs += [counts[w] for w in hits]
                    ends.append(len(terms))
                if len(terms) >= SEGMENT:
                    yield segment()
                    docs, lengths, ends, terms, tfs, totals = [], [], [0], [], [], [0, 0]
    if totals[0]:
        yield segment()


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, df`` of each segment's postings."""
    for batch in batches:
        for terms in batch.column(0):
            found, df = np.unique(np.frombuffer(terms.as_py(), "<i4"), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(df.astype(np.int64))], ["term", "df"])


def lists_of(parts: list[tuple[np.ndarray, ...]], **corpus) -> ImpactLists:
    ids, lengths, _, terms, tfs = (np.concatenate([p[k] for p in parts]) for k in range(5))
    counts = np.concatenate([np.diff(p[2]) for p in parts])
    return ImpactLists(ids, lengths, np.append(0, np.cumsum(counts)), terms, tfs, **corpus)


def ranked(items: list[tuple[int, np.ndarray]], k: int, corpus: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best ``k`` documents of a task for each item; later lists start from what earlier ones gave."""
    if not items:
        return
    none = np.empty(0, dtype=np.int64)
    best = [(none, none)] * len(items)

    def search(parts: list[tuple[np.ndarray, ...]]) -> None:
        lists = lists_of(parts, **corpus)
        for i, (_, terms) in enumerate(items):
            best[i] = lists.search(terms, *best[i], k)[:2]

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for i in range(batch.num_rows):
            held.append(tuple(np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in enumerate(("<i8", "<i8", "<i8", "<i4", "<i4"))))
            if sum(len(h[3]) for h in held) >= INDEX:
                search(held)
                held = []
    if held:
        search(held)
    counts = [len(ids) for ids, _ in best]
    owners = np.repeat(np.array([item for item, _ in items], dtype=np.int64), counts)
    columns = [owners, *(np.concatenate([b[c] for b in best]) for c in range(2))]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])


def search_block(texts: DataFrame, asked: list[tuple[int, str]], k: int) -> DataFrame:
    """``item_id, doc_id, score``: candidates for the ranks of the items of one block."""
    own: dict[int, set[bytes]] = {}
    for item, text in asked:
        own.setdefault(item, set()).update(w for words in terms_of(text) for w in words)
    ids = {w: i for i, w in enumerate(sorted(set().union(*own.values())))}
    schema = "n_docs long, n_terms long, ids binary, lengths binary, starts binary, terms binary, tfs binary"
    stored = materialize(texts.mapInArrow(functools.partial(segments, ids), schema), "postings")
    n_docs, n_terms = (x or 0 for x in stored.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    # One row for each term of the block at most.
    counted = stored.select("terms").mapInArrow(term_counts, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    weights = np.zeros(len(ids), dtype=np.int64)
    for term, df in zip(counted.column("term").to_pylist(), counted.column("df").to_pylist(), strict=True):
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    items = [(item, np.array(sorted(ids[w] for w in words), dtype=np.int64)) for item, words in sorted(own.items())]
    corpus = {"weights": weights, "n_docs": n_docs, "n_terms": n_terms}
    parts = stored.select("ids", "lengths", "starts", "terms", "tfs")
    return parts.mapInArrow(functools.partial(ranked, items, k, corpus), "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` highest-scoring documents.

    A document's score adds up, over the item's distinct terms, the term's weight
    times ``(10**9 * tf) div (1000 * tf + 8 * m)``; m grows with the document's
    length. Scores are above zero; ties go to the smaller id; items with fewer
    such documents return all of them, items without terms none.

    Null texts have no terms. Rows without an id, of either table, take no part
    and are not counted. Rows repeating a document's id are documents each and
    may both be ranked; rows repeating an item's id are one item with the terms
    of all of them. Other columns are ignored; empty tables give no rows.

    One pass over the whole texts stores the postings of the items' terms and the
    counts; tasks then make impact lists of some hundred thousand postings at a
    time, search them for every item and hand on ``k`` documents per item. Items
    go in blocks of ``QUERY_BYTES`` of text, each with a pass of its own, so what
    a task receives is bounded.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("doc_id is not null")
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.coalesce(F.col(f"`{item_text_col}`"), F.lit("")).alias("text"))
    asked = asked.where("item_id is not null")
    blocks = max(1, math.ceil((asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / QUERY_BYTES))
    found = []
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        found.append(search_block(texts, list(zip(block.column("item_id").to_pylist(), block.column("text").to_pylist(), strict=True)), k))
    order = W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    placed = functools.reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return placed.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
