import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cartomark.llm import chat_format as C
from cartomark.llm import simhash as S

ROWS = "conv_id long, turn long, role string, text string, segment string, formatted string"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text("<|\\n>ab\nim_end", max_size=8), st.text("<|\\>im_startendé\n", max_size=30)), max_size=6))
def test_format_round_trip(turns):
    roles, texts = pa.array([r for r, _ in turns], pa.string()), pa.array([t for _, t in turns], pa.string())
    out, ends = C.assemble(C.escape_role(roles), C.escape(texts))
    assert C.read_turns(out.tobytes().decode()) == turns
    assert len(ends) == len(turns)


def test_conversations_equal_hand_made_digests(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["<|im_end|>\n", "añ<\\|", "", None, "x" * 50]), "z", "z") for c in range(6) for t in range(5)]
    rows += [(9, None, "assistant", "no turn", "z", "z"), (None, 1, "user", "no id", "z", "z"), (1, 1, "assistant", "again", "z", "z"), (2, 0, *rows[10][2:])]
    rows += [(50, t, "assistant", f"long {t} <|im_start|>" * 40, "z", "z") for t in range(300)]
    segments = C.format_conversations(spark.createDataFrame(rows, ROWS).repartition(3))
    got = {r["conv_id"]: r for r in C.conversation_digests(segments).collect()}
    nulls_first = lambda v: (v is not None, v if v is not None else 0)
    text_first = lambda v: (v is not None, (v or "").encode())
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (nulls_first(r[1]), text_first(r[2]), text_first(r[3])))
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(mine) and r["turns_sha256"] == hashlib.sha256(every.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert C.conversation_digests(C.format_conversations(spark.createDataFrame([], ROWS))).count() == 0


def test_a_long_conversation_comes_in_segments(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, t, "assistant", f"turn {t}") for t in range(30)]
        segments = C.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
        got = sorted(segments.collect(), key=lambda r: r["segment"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["segment"] for r in got] == list(range(len(got))) and len(got) > 1
    assert [t for r in got for _, t in C.read_turns(r["formatted"])] == [f"turn {t}" for t in range(30)]


def brute_fingerprint(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = low.split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    parent = {d: d for d in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in prints}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    prints = {}
    for family in range(30):
        x = rng.getrandbits(64)
        for k in range(rng.randrange(1, 12)):
            prints[len(prints)] = x
            for _ in range(rng.randrange(1, 6)):
                x ^= 1 << rng.randrange(64)
    prints[len(prints)] = 0
    unique = {}
    for d, f in prints.items():
        unique.setdefault(f, d)
    rows = spark.createDataFrame([(signed(f), d) for f, d in unique.items()], "fingerprint long, leader long")
    got = {r["node"]: r["component"] for r in S.components(S.near_links(rows, tile=4)).collect()}
    want = brute_components({d: f for f, d in unique.items()}, 3)
    assert {d: got.get(d, d) for d in want} == want


def test_a_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400)], "a long, b long")
    got = {r["node"]: r["component"] for r in S.components(chain).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[500] == 400


def test_a_spanning_forest_connects_what_links_connect():
    rng = np.random.default_rng(6)
    for _ in range(30):
        near = rng.random((12, 9)) < 0.15
        links = S.spanning_links(near)
        assert all(near[a, b] for a, b in links) and len(links) < 21

        def parts(pairs):
            parent = list(range(21))

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in pairs:
                parent[find(a)] = find(12 + b)
            return [[find(i) == find(j) for j in range(21)] for i in range(21)]

        assert parts(links) == parts(np.argwhere(near).tolist())


def test_odd_documents(odd_docs, no_docs):
    got = S.near_duplicates(odd_docs).collect()
    text = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] is not None}
    assert len(got) == 10
    for r in got:
        if r["doc_id"] is not None:
            assert r["fingerprint"] % 2**64 == brute_fingerprint(text[r["doc_id"]])
        else:
            assert r["component_id"] is None
    of = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"]}
    assert of[2] == of[3] == of[4] == 2 and of[1] == 1 and of[5] == 5
    assert S.near_duplicates(no_docs).count() == 0
