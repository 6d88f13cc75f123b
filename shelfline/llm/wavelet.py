"""Token ids in wavelet matrix files: one row per shard holds the bit planes, their ranks and the document table.

Documents are range-partitioned by id, tokenised with the tokenizers library in that order, and cut into shards at document
ends. A shard stores bit ``bits - 1 - k`` of every id in plane k, after a stable split by the planes before it, and the
number of ones before each 512th bit. Access, counting and occurrence lookup need these parts only.

Edge cases: a null text is empty (its only id is the end id); null doc_ids come first; repeated doc_ids are documents of
their own, ordered by text; an empty table writes no shard; extra columns are ignored; a long text makes a long shard.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.bpe import PRE_TOKENS, byte_letters, cut_pieces, vocabulary_path
from shelfline.llm.common import batches_of, keep, make_room, table
from shelfline.session import shared_folder

#: Ids after which a shard is closed at the next document end.
SHARD_TOKENS = 1 << 20
#: Bits between two stored ranks.
STEP = 512
#: Pieces in each of the two generations that a task remembers while encoding.
MEMORY_PIECES = 450_000
#: Documents that a task gets from Spark at a time.
ROWS_A_BATCH = 1000

SHARD = (
    "part int, seq int, n_tokens long, n_docs long, bits int, doc_ids binary, id_known binary, doc_ends binary,"
    " planes binary, zeros binary, ranks binary"
)


class WaveletMatrix:
    """Bit planes of a sequence of unsigned integers with rank and select."""

    def __init__(self, n: int, bits: int, planes: np.ndarray, zeros: np.ndarray, ranks: np.ndarray):
        self.n, self.bits, self.planes, self.zeros, self.ranks = n, bits, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length() if len(ids) else 1)
        words = -(-len(ids) // STEP) * STEP // 8
        planes, zeros, ranks = np.zeros((bits, words), np.uint8), np.zeros(bits, np.int64), []
        rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for k in range(bits):
            ones = (rest & rest.dtype.type(1 << (bits - 1 - k))) != 0
            packed = np.packbits(ones, bitorder="little")
            planes[k, : len(packed)] = packed
            # A mask as an index takes four times as long.
            low = rest.compress(~ones)
            zeros[k] = len(low)
            rest = np.concatenate([low, rest.compress(ones)])
            counts = np.bitwise_count(planes[k].reshape(-1, STEP // 8)).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate([[0], np.cumsum(counts, dtype=np.uint32)]).astype(np.uint32))
        return cls(len(ids), bits, planes, zeros, np.stack(ranks))

    def _ones(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        at = np.asarray(at, np.int64)
        block, inside = at // STEP, at % STEP
        count = self.ranks[plane][block].astype(np.int64)
        if not self.planes.shape[1]:
            return count
        row = self.planes[plane].reshape(-1, STEP // 8)
        byte = inside // 8
        rows = row[np.minimum(block, len(row) - 1)]
        ahead = np.arange(STEP // 8) < byte[..., None]
        count += (np.bitwise_count(rows) * ahead).sum(axis=-1, dtype=np.int64)
        last = np.take_along_axis(rows, np.minimum(byte, STEP // 8 - 1)[..., None], -1)[..., 0]
        return count + np.bitwise_count(last & ((1 << (inside % 8)) - 1).astype(np.uint8)) * (inside % 8 > 0)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Ids at the given positions."""
        at = np.asarray(at, np.int64)
        out = np.zeros(at.shape, np.int64)
        for k in range(self.bits):
            bit = (self.planes[k][at // 8] >> (at % 8).astype(np.uint8)) & 1
            ones = self._ones(k, at)
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
            out = out << 1 | bit
        return out

    def rank(self, token: int, before: int) -> int:
        """How often ``token`` stands before a position."""
        lo, hi = self._range(token, before)
        return hi - lo

    def _range(self, token: int, before: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        edge = np.array([0, min(max(before, 0), self.n)], np.int64)
        for k in range(self.bits):
            ones = self._ones(k, edge)
            edge = self.zeros[k] + ones if token >> (self.bits - 1 - k) & 1 else edge - ones
        return int(edge[0]), int(edge[1])

    def select(self, token: int) -> np.ndarray:
        """All positions of ``token``, ascending: walks back from its run behind the last plane."""
        lo, hi = self._range(token, self.n)
        at = np.arange(lo, hi)
        for k in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[k], count=self.n, bitorder="little").astype(bool)
            of_one = token >> (self.bits - 1 - k) & 1
            at = np.flatnonzero(ones)[at - self.zeros[k]] if of_one else np.flatnonzero(~ones)[at]
        return at

    def all(self) -> np.ndarray:
        """The whole sequence: the splits are undone from the last plane to the first."""
        values = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[k], count=self.n, bitorder="little").astype(bool)
            back = np.empty_like(values)
            back[np.flatnonzero(~ones)] = values[: self.zeros[k]]
            back[np.flatnonzero(ones)] = values[self.zeros[k] :] | values.dtype.type(1 << (self.bits - 1 - k))
            values = back
        return values.astype(np.uint32)


class _Library:
    """The tokenizers library behind a memory of pieces.

    Its model merges each new pre-token; texts are cut as its pre-tokenizer does, at most once per piece.
    """

    def __init__(self, path: str):
        import json
        import re

        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Fetched once: every access makes another object.
        self.model = self.tokenizer.model
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")" if special else "$^()").split
        self.pieces = regex.compile(r"\s*\S+|\s+")
        self.cut = regex.compile(PRE_TOKENS)
        self.letters = byte_letters()
        self.space = self.letters[32]
        self.special = {t: np.array([self.tokenizer.token_to_id(t)], "<u4").tobytes() for t in special}
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give up what was learnt from texts; it is only learnt again."""
        self.memory, self.older = {}, {}

    def _word(self, word: str) -> bytes:
        """One pre-token through the library's own model."""
        core = word[1:] if word[0] == " " else word
        if core.isascii() and core.isalpha():
            letters = word if core is word else self.space + core  # ASCII letters stand for themselves
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(letters)])

    def _learn(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            core = piece[1:] if piece[0] == " " else piece
            if core.isalpha():
                words = [piece]
            elif core[-1:] in (".", ",") and core[:-1].isalpha():
                words = [piece[:-1], piece[-1]]  # letters and the sign behind them are two pre-tokens
            else:
                words = self.cut.findall(piece)
            if len(words) == 1:
                found = self._word(piece)
            else:
                # The same word often comes back with another sign after it.
                found = b"".join([self.memory.get(w) or self.memory.setdefault(w, self._word(w)) for w in words])
        if len(self.memory) >= MEMORY_PIECES:
            self.older, self.memory = self.memory, {}
        self.memory[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        out: list[bytes] = []
        for k, part in enumerate(self.split(text)):
            if k % 2:
                out.append(self.special[part])
                continue
            known, learn = self.memory.get, self._learn
            out += [known(p) or learn(p) for p in cut_pieces(part, self.pieces) if p]
        return b"".join(out)


@cache
def _library(path: str) -> _Library:
    found = _Library(path)
    keep("wavelet", found.forget)
    return found


def _shard(part: int, seq: int, ids: list[bytes], names: list) -> pa.RecordBatch:
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
    matrix = WaveletMatrix.build(np.frombuffer(b"".join(ids), "<u4"))
    known = np.array([x is not None for x in names], np.uint8)
    values = [
        part, seq, matrix.n, len(ids), matrix.bits, np.array([x or 0 for x in names], "<i8").tobytes(), known.tobytes(),
        ends.astype("<i8").tobytes(), matrix.planes.tobytes(), matrix.zeros.astype("<i8").tobytes(), matrix.ranks.astype("<u4").tobytes(),
    ]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 6
    fields = [column.split()[0] for column in SHARD.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=fields)


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> None:
    """Tokenise ``docs`` (doc_id, text) in ascending doc_id order and write the shard files under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("wavelet")
        library = _library(tokenizer or vocabulary_path())
        end = np.array([end_id], "<u4").tobytes()
        part, seq, ids, names, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(library.encode(text.as_py() or "") + end)
                names.append(name.as_py())
                held += len(ids[-1]) // 4
                if held >= shard_tokens:
                    yield _shard(part, seq, ids, names)
                    seq, ids, names, held = seq + 1, [], [], 0
        if ids:
            yield _shard(part, seq, ids, names)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows of one id, or without one, are dealt and ordered by a hash of the text: no id fills a task, and a task run again gives
    # the same shards.
    tie = F.xxhash64("text")
    ordered = ordered.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    with batches_of(docs.sparkSession, ROWS_A_BATCH):
        ordered.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)


def open_shard(row: dict) -> WaveletMatrix:
    """The matrix of one row of a shard file."""
    bits = row["bits"]
    planes = np.frombuffer(row["planes"], np.uint8).reshape(bits, -1)
    ranks = np.frombuffer(row["ranks"], "<u4").reshape(bits, -1)
    return WaveletMatrix(row["n_tokens"], bits, planes, np.frombuffer(row["zeros"], "<i8"), ranks)


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document of the shard files: ``doc_id, start, n_tokens, ids_crc32``, and its ids on demand."""
    shards = spark.read.schema(SHARD).parquet(path)
    # One row per shard, so about a millionth of the ids.
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("shard_start"))
    schema = "doc_id long, part int, seq int, at long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = open_shard(row).all().astype("<u4")
                ends = np.frombuffer(row["doc_ends"], "<i8")
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                own = [ids[a:b].tobytes() for a, b in zip(begins, ends, strict=True)]
                known = np.frombuffer(row["id_known"], np.uint8) == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=known),
                        pa.array(np.full(len(ends), row["part"], np.int32)),
                        pa.array(np.full(len(ends), row["seq"], np.int32)),
                        pa.array(begins),
                        pa.array(ends - begins),
                        pa.array([zlib.crc32(x) for x in own], pa.int64()),
                        *([pa.array(own, pa.binary())] * with_ids),
                    ],
                    names=["doc_id", "part", "seq", "at", "n_tokens", "ids_crc32", *["ids"] * with_ids],
                )

    read = shards.mapInArrow(run, schema).join(starts, ["part", "seq"])
    return read.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """How often each token stands in each shard, by rank alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = open_shard(row)
                found = [matrix.rank(t, matrix.n) for t in tokens]
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([row["part"]] * len(tokens), pa.int32()), "seq": pa.array([row["seq"]] * len(tokens), pa.int32()),
                     "token": pa.array(tokens, pa.int64()), "occurrences": pa.array(found, pa.int64())}
                )

    return spark.read.schema(SHARD).parquet(path).mapInArrow(run, "part int, seq int, token long, occurrences long")


def op3_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids as wavelet matrix shards and read every document back from the files."""
    path = os.path.join(shared_folder(spark), f"wavelet-{uuid.uuid4().hex}")
    write_shards(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
