import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cartomark.llm import packing
from cartomark.llm.common import byte_bpe
from cartomark.llm.line_dedup import dedup_lines

SPACE = " \t\n\x0b\x0c\r"


def fold(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute_dedup(rows, min_chars=40, min_docs=5):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(fold(line)) >= min_chars:
                holders.setdefault(fold(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(fold(x), ())) < min_docs or max(holders[fold(x)]) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_lines_equal_brute_force(spark):
    rng = random.Random(1)
    pool = ["É" * 39, "É" * 40, "é" * 40, "A" * 45, "  " + "a" * 45 + "\r", "short", "", "b" * 60, "B" * 60 + "\t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for i in range(40)]
    rows += [(3, "A" * 45), (None, "a" * 45), (8, None)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got], key=repr) == brute_dedup(rows)


def test_odd_rows_keep_their_lines(odd_docs, no_docs):
    got = dedup_lines(odd_docs)
    assert got.columns == odd_docs.columns + ["n_dropped"]
    assert dict(got.dtypes)["n_lines"] == "bigint" and got.count() == 10
    assert got.agg({"n_dropped": "sum"}).first()[0] == 0
    assert dedup_lines(no_docs).count() == 0


def reference_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe()["tokenizer_json"]).encode(text, add_special_tokens=False).ids + [2]


def test_pieces_equal_the_tokenizer(odd_docs, no_docs):
    rows = packing.tokenize_pieces(odd_docs, **byte_bpe(), capacity=1024).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, text in {(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect() if r["doc_id"] not in (None, 1)}:
        ids, pieces = reference_ids(text or ""), sorted(by_doc[doc], key=lambda r: r["piece"])
        assert sum(p["length"] for p in pieces) == len(ids) and all(p["length"] == 1024 for p in pieces[1:])
        for p in pieces:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
    assert len(by_doc[1]) == 2 and len(by_doc[None]) == 2
    assert packing.pack(packing.tokenize_pieces(no_docs, **byte_bpe())).count() == 0


def test_both_encoders_agree_on_common_text():
    import base64
    import re

    import tiktoken

    files, rng = byte_bpe(), random.Random(2)
    with open(files["ranks_file"], "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("t", pat_str=files["pattern"], mergeable_ranks=ranks, special_tokens={})
    letters = [chr(c) for c in range(0x250) if re.fullmatch(packing.COMMON_TEXT, chr(c))] + list("‐–—’“…€") + [" "] * 60 + list("'st'll\n\n\t")
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(80))
        assert fast.encode_ordinary(text) + [2] == reference_ids(text)


def check_packing(lengths, bins, offsets, capacity, documents, attention):
    for b in set(bins.tolist()):
        at = np.flatnonzero(bins == b)
        order = at[np.argsort(offsets[at])]
        assert offsets[order].tolist() == [0, *np.cumsum(lengths[order])[:-1]]
        assert lengths[at].sum() <= capacity and len(at) <= documents and (lengths[at] ** 2).sum() <= attention


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=80), st.integers(1, 6), st.integers(4096, 9000), st.sampled_from(["norm", "dot"]))
def test_every_capacity_holds(lengths, documents, attention, rule):
    sizes = np.array(lengths)
    bins, offsets = packing.best_fit(sizes, capacity=64, max_documents=documents, max_attention=attention, weights=(1, 1, 1), rule=rule)
    check_packing(sizes, bins, offsets, 64, documents, attention)


def test_packing_is_tight(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1025, 5000)
    rows = spark.createDataFrame([(i, 0, int(n), "x") for i, n in enumerate(lengths)], "doc_id long, piece int, length long, offset string")
    got = packing.pack(rows, group_pieces=2500).toPandas()
    assert got["sequence_id"].nunique() <= 1.01 * lengths.sum() / 1024 + 2
    check_packing(got["length"].to_numpy(), got["sequence_id"].to_numpy(), got["offset"].to_numpy(), 1024, 1024, 1024**2)
