"""Chat formatting by columnar byte assembly, with a reversible escape and a loss mask.

A turn becomes ``### role:``, a line end, its text, a line end, ``</turn>`` and a line end. Inside texts and roles every
``\\``, ``#`` and ``<`` gets a ``\\`` before it (in roles also ``:`` and line ends), so that no text can contain a marker.
All texts of a batch are escaped at once: segment lengths give cumulative offsets, these give scatter indices, and headers
and contents are copied into one preallocated buffer that becomes the Arrow column.

A conversation that is larger than a batch, or that lies on both sides of a partition's edge, comes out in several parts
with ascending numbers; a hot conversation is thus formatted by many tasks.

Edge cases: null roles and texts are empty; a null conv_id is a conversation of its own; rows of equal turn are ordered by
role and text, repeated rows stay; an empty table gives no parts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import table, utf8
from shelfline.session import shared_folder

OPEN, MIDDLE, CLOSE = b"### ", b":\n", b"\n</turn>\n"
_TEXT_ESCAPES = np.isin(np.arange(256), list(b"\\#<"))
_ROLE_ESCAPES = np.isin(np.arange(256), list(b"\\#<:\n"))

PARTS = "conv_id long, part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def _escaped(data: np.ndarray, offsets: np.ndarray, escapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hit = escapes[data]
    extra = np.concatenate([[0], np.cumsum(hit)])
    out = np.full(len(data) + extra[-1], ord("\\"), np.uint8)
    out[np.arange(len(data)) + extra[1:]] = data
    return out, offsets + extra[offsets]


def unescaped(data: bytes) -> bytes:
    return re.sub(rb"\\(.)", rb"\1", data, flags=re.DOTALL) if b"\\" in data else data


def _copy(out: np.ndarray, to: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy each segment of ``data`` to its place in ``out``."""
    out[np.repeat(to - offsets[:-1], np.diff(offsets)) + np.arange(len(data))] = data


def assemble(role: tuple[np.ndarray, np.ndarray], text: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: the buffer, the end of each turn, start and end of each escaped text."""
    role_data, role_at = _escaped(*role, _ROLE_ESCAPES)
    text_data, text_at = _escaped(*text, _TEXT_ESCAPES)
    n = len(text_at) - 1
    lengths = np.column_stack(
        [np.full(n, len(OPEN)), np.diff(role_at), np.full(n, len(MIDDLE)), np.diff(text_at), np.full(n, len(CLOSE))]
    ).astype(np.int64)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for column, header in ((0, OPEN), (2, MIDDLE), (4, CLOSE)):
        out[(starts[:, column, None] + np.arange(len(header))).ravel()] = np.tile(np.frombuffer(header, np.uint8), n)
    _copy(out, starts[:, 1], role_data, role_at)
    _copy(out, starts[:, 3], text_data, text_at)
    return out, ends[:, 4], starts[:, 3], ends[:, 3]


def format_conversations(turns: DataFrame) -> DataFrame:
    """Parts of formatted conversations with the byte spans of the assistant's texts (the loss mask)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out, ends, text_starts, text_ends = assemble(utf8(batch.column("role")), utf8(batch.column("text")))
            ids = batch.column("conv_id")
            values, known = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (known[1:] != known[:-1])]))
            after = np.append(first[1:], len(values))
            cuts = np.concatenate([[0], ends[after - 1]])
            loss = pa.array(batch.column("role")).fill_null("").to_numpy(zero_copy_only=False) == "assistant"
            which = np.searchsorted(first, np.flatnonzero(loss), side="right") - 1
            spans_at = pa.array(np.searchsorted(which, np.arange(len(first) + 1)), pa.int32())
            buffer = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(out))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(first)),
                    pa.array(base + done + np.arange(len(first))),
                    pa.array(after - first),
                    buffer.cast(pa.string()),
                    pa.ListArray.from_arrays(spans_at, pa.array(text_starts[loss] - cuts[which])),
                    pa.ListArray.from_arrays(spans_at, pa.array(text_ends[loss] - cuts[which])),
                ],
                names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"],
            )
            done += len(first)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    order = ["conv_id", "turn", "role", "text"]
    # The text takes part in the order only within a partition; the cut itself needs short keys.
    rows = rows.repartitionByRange("conv_id", "turn", F.xxhash64("role", "text")).sortWithinPartitions("conv_id", "turn", F.xxhash64("role", "text"), *order[2:])
    return rows.mapInArrow(run, PARTS)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Role and text of each turn of a formatted part."""
    turns = []
    for turn in formatted.split(CLOSE)[:-1]:
        role, _, text = turn.removeprefix(OPEN).partition(MIDDLE)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def read_back(parts: DataFrame) -> DataFrame:
    """Counts and digests of every conversation, from its parts in order: hashes are carried from part to part."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done: list[tuple] = []
        state: list = []

        def close() -> None:
            conv, n, turns, chars, loss, formatted = state
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        for batch in batches:
            for row in batch.to_pylist():
                if not state or state[0] != row["conv_id"]:
                    if state:
                        close()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                whole = row["formatted"].encode()
                for role, text in parse(whole):
                    state[1] += 1
                    state[2].update(role + b"\n" + text + b"\n")
                for lo, hi in zip(row["loss_starts"], row["loss_ends"], strict=True):
                    text = unescaped(whole[lo:hi])
                    state[3] += len(text.decode())
                    state[4].update(text)
                state[5] += len(row["formatted"])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=fields)
                done = []
        if state:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=fields)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one that is made of control strings, store the parts and read them back."""
    hard = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    path = os.path.join(shared_folder(spark), f"chat-{uuid.uuid4().hex}")
    format_conversations(turns.unionByName(extra)).write.parquet(path)
    return read_back(spark.read.schema(PARTS).parquet(path))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(15 + length(role) + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))
    + length(regexp_replace(role, '[^\\#<:\n]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
