"""Chat formatting with a loss mask, assembled column by column in one buffer."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartomark.llm.common import slices

START, END = "<|im_start|>", "<|im_end|>"
#: Content bytes assembled in one buffer; longer batches are cut into such pieces.
BUFFER_BYTES = 32 << 20
SEGMENTS = "conv_id long, segment int, n_turns int, formatted string, loss_spans array<struct<start:int,end:int>>"
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: pa.Array) -> pa.Array:
    r"""Put one more ``\`` between ``<`` and ``|``, so that no control string is left."""
    return pc.replace_substring_regex(text, pattern=r"<(\\*)\|", replacement=r"<\\\1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: pa.Array) -> pa.Array:
    """Roles stand on one line, so their line breaks become a control string."""
    return pc.replace_substring(escape(role), pattern="\n", replacement="<|n|>")


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and data of a string column without nulls."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at, np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)


def assemble(role: pa.Array, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with all formatted turns, and where each turn ends in it.

    A turn is five segments: start tag, role, line break, text, end tag. Their
    lengths give each segment's place by one cumulative sum; every kind of
    segment is then copied by one scatter.
    """
    n = len(role)
    role_at, role_data = _bytes(role)
    text_at, text_data = _bytes(text)
    tags = [np.frombuffer(t.encode(), dtype=np.uint8) for t in (START, "\n", END + "\n")]
    lengths = np.empty((n, 5), dtype=np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = (len(t) for t in tags)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    begins = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, dtype=np.uint8)
    for k, tag in zip((0, 2, 4), tags, strict=True):
        out[(begins[:, k, None] + np.arange(len(tag))).ravel()] = np.tile(tag, n)
    for k, at, data in ((1, role_at, role_data), (3, text_at, text_data)):
        source = data[at[0] : at[-1]] if n else data[:0]
        out[np.arange(len(source)) + np.repeat(begins[:, k] - (at[:-1] - at[0]), lengths[:, k])] = source
    return out, ends[:, 4] if n else np.empty(0, np.int64)


def format_conversations(
    rows: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """Conversations as formatted text with loss spans.

    Returns ``conv_id, segment, n_turns, formatted, loss_spans``: a conversation's
    text is its segments in order. Most have one; a conversation too long for a
    batch has several, so no row and no task holds an unbounded one. Spans are
    code point offsets in the segment and cover the texts of ``trained_role``.

    Turns are ordered by turn, then role, then text (nulls first), so ties and
    repeated rows have one defined order and all are kept. Null roles and texts
    are empty; rows without a conversation id form one conversation. Other input
    columns, whatever their names, are ignored. An empty table gives no rows.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, segment = object(), 0
        for batch in slices(batches, 2, BUFFER_BYTES):
            conv = batch.column(0)
            plain_role = pc.fill_null(batch.column(1), "")
            role, text = escape_role(plain_role), escape(pc.fill_null(batch.column(2), ""))
            out, turn_ends = assemble(role, text)
            same = conv.to_pylist()
            changes = [i for i in range(len(same)) if i == 0 or same[i] != same[i - 1]]
            stops = [*changes[1:], len(same)]
            bounds = np.concatenate([[0], turn_ends[np.array(stops) - 1]]).astype(np.int32)
            numbers = []
            for i in changes:
                segment = segment + 1 if same[i] == last else 0
                last = same[i]
                numbers.append(segment)
            # Spans: code points before each text inside its segment.
            n_text = pc.utf8_length(text).to_numpy().astype(np.int64)
            before = len(START) + pc.utf8_length(role).to_numpy().astype(np.int64) + 1
            total = before + n_text + len(END) + 1
            reach = np.cumsum(total) - total
            base = np.repeat(reach[changes], np.diff([*changes, len(same)]))
            begin = reach - base + before
            trained = pc.equal(plain_role, trained_role).to_numpy(zero_copy_only=False)
            counts = np.add.reduceat(trained.astype(np.int32), changes)
            spans = pa.StructArray.from_arrays(
                [pa.array(begin[trained].astype(np.int32)), pa.array((begin + n_text)[trained].astype(np.int32))], ["start", "end"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([same[i] for i in changes], pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array(np.diff([*changes, len(same)]).astype(np.int32)),
                    pa.StringArray.from_buffers(len(changes), pa.py_buffer(bounds), pa.py_buffer(out)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), spans),
                ],
                ["conv_id", "segment", "n_turns", "formatted", "loss_spans"],
            )

    ordered = (
        rows.select(
            F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
            F.col(f"`{role_col}`").alias("role"),
            F.col(f"`{text_col}`").alias("text"),
            F.col(f"`{turn_col}`").alias("turn"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.select("conv_id", "role", "text").mapInArrow(segments, SEGMENTS)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted segment, unescaped."""
    return [(unescape(r.replace("<|n|>", "\n")), unescape(t)) for r, t in _TURN.findall(formatted)]


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Digests per conversation, read back from :func:`format_conversations`.

    Takes the segments as that function gives them: a conversation's lie in one
    partition, in order. Each is parsed and hashed as it passes by, so only the
    running digests of one conversation are held.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        open_one = None

        def close(c: dict) -> tuple:
            return c["id"], c["turns"], c["all"].hexdigest(), c["loss_chars"], c["loss"].hexdigest(), c["chars"]

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done, strict=True), types, strict=True)], names)

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if open_one is None or row["segment"] == 0:
                    if open_one is not None:
                        done.append(close(open_one))
                    open_one = {"id": row["conv_id"], "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                text = row["formatted"]
                for role, content in read_turns(text):
                    open_one["turns"] += 1
                    open_one["all"].update(f"{role}\n{content}\n".encode())
                for span in row["loss_spans"]:
                    part = unescape(text[span["start"] : span["end"]])
                    open_one["loss"].update(part.encode())
                    open_one["loss_chars"] += len(part)
                open_one["chars"] += len(text)
            if done:
                yield batch_of(done)
        if open_one is not None:
            yield batch_of([close(open_one)])

    return segments.mapInArrow(
        digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
