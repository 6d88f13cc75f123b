"""Arrow text blocks and word hashes shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are worked on at a time inside a task; a longer text forms a block of its own.
BLOCK_BYTES = 2 << 20

#: Words are runs of anything but the six white-space bytes of ASCII.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


#: Gives freed memory back to the system, where the C library can: a worker that is used again would else keep its peak.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

#: Powers of the bases of hashes, as many as the longest block of a task asked for.
_POWERS: dict[int, np.ndarray] = {}

#: What an operator keeps in a Python worker from task to task, and how it is given up.
_KEPT: dict[str, Callable[[], None]] = {}


def keep(owner: str, forget: Callable[[], None]) -> None:
    """Say how to give up what ``owner`` remembers in this worker."""
    _KEPT[owner] = forget


def make_room(owner: str) -> None:
    """A task of ``owner`` begins: workers are used again by other operators, whose memories would only take its space."""
    for other, forget in _KEPT.items():
        if other != owner:
            forget()
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside: for rows that hold whole sets or texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of multiply and shift steps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: One random-looking odd 64-bit value per byte value.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array and the offset of each; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    array = column.cast(pa.large_string()) if not pa.types.is_large_binary(column.type) else column
    array = pc.fill_null(array, b"" if pa.types.is_large_binary(array.type) else "").cast(pa.large_binary())
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = array.buffers()
    offsets = np.frombuffer(ends, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut whole texts into blocks of about ``limit`` bytes: first and last row, bytes, offsets."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n, lo + 65536)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, 2 * len(_POWERS.get(base, ())), 1 << 18), base, dtype=np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[base][:n]


def translated(data: np.ndarray, to: np.ndarray) -> np.ndarray:
    """``to[data]`` for bytes and a table of 256 values of one byte, several times as fast."""
    return np.frombuffer(bytearray(data.tobytes().translate(to.tobytes())), to.dtype)


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each text (one entry more than texts). ``between``: the bytes that end words."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~translated(data, between)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] |= inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[cuts > 0]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, wherever it stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=total[1:], dtype=np.uint64)
    value = (total[ends] - total[starts]) * _powers(_BASE_INVERSE, len(data) + 1)[starts]
    return mixed(value + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row, and the text of each; a shorter text is one shingle, an empty one has none."""
    n = np.diff(first)
    weights = mixed(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(977)) | np.uint64(1)
    if len(words) >= width:
        size = len(words) - width + 1
        value = words[:size] * weights[0]
        for j in range(1, width):
            value += words[j : j + size] * weights[j]
        doc = np.repeat(np.arange(len(n)), n)
        keep = doc[:size] == doc[width - 1 :]
        value, doc = mixed(value[keep]), doc[:size][keep]
    else:
        value, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            has = n[short] > j
            whole[has] += words[first[short[has]] + j] * weights[j]
        value = np.concatenate([value, mixed(whole + n[short].astype(np.uint64))])
        doc = np.concatenate([doc, short])
    return value, doc


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every lower-cased text, ascending in each text, and the offset of each text's set."""
    lowered = translated(data, LOWER)
    starts, ends, first = word_spans(lowered, offsets)
    value, doc = shingle_hashes(word_hashes(lowered, starts, ends), first, width)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    if len(value):
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(len(offsets)))
