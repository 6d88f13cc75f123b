"""Byte-level BPE by backtracking: exact merges in linear time, decoding by an offset table.

A text is cut where a word ends and white space begins; no pre-token crosses such a place, so each piece is encoded once
and then looked up. A new piece is cut into pre-tokens, and in each an Aho-Corasick automaton over all tokens gives the
longest token that starts at every byte. The encoder takes the longest token whose pair with the token before it is
compatible (merging the two tokens' bytes gives these two tokens again), tries shorter prefixes else, and steps back
from places it cannot leave. A token sequence in which all neighbours are compatible is the one that merging gives.

Edge cases: a null text is empty and has no ids; a text of any length is one unit of work inside its batch; rows are
never merged, so repeated ids and extra columns stay as they are. The string of the special token gives its id.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shelfline.llm.common import keep, make_room, table, utf8

#: Pieces in each of the two generations that a task remembers; what is forgotten is only encoded again.
MEMORY_PIECES = 200_000

#: Fixed value: how this vocabulary cuts a text before merging.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: b for b, letter in byte_letters().items()}
        raw = lambda token: bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.id_of = {raw(token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.bytes_of = {i: token for token, i in self.id_of.items()}
        self.rank = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[raw(left), raw(right)] = rank
        everything = self.bytes_of | {i: s.encode() for s, i in self.special.items()}
        size = max(everything) + 1
        lengths = np.array([len(everything.get(i, b"")) for i in range(size)], np.int64)
        #: The offset table: token i is ``flat[offset[i]:offset[i + 1]]``.
        self.offset = np.concatenate([[0], np.cumsum(lengths)])
        self.flat = np.frombuffer(b"".join(everything.get(i, b"") for i in range(size)), np.uint8)
        self.length = lengths.tolist()
        self.compatible: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.shorter = [-1] * size
        self.reached = set()
        for token, i in self.id_of.items():
            if self._merged(token) == [token]:  # tokens that no merge yields are never taken
                self.reached.add(i)
                self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, i))
        for i in self.reached:
            token = self.bytes_of[i]
            shorter = (self.id_of.get(token[:k], -1) for k in range(len(token) - 1, 0, -1))
            self.shorter[i] = next((p for p in shorter if p in self.reached), -1)
        self.automaton.make_automaton()
        self.cut = regex.compile(PRE_TOKENS)
        self.pieces = regex.compile(r"\s*\S+|\s+")
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")" if self.special else "$^()").split
        self.number = list(range(size))  # shared, so that remembered ids cost a pointer each
        self.decimal = [str(i) for i in range(size)]
        self.memory: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        """Give up what was learnt from texts; it is only learnt again."""
        self.memory, self.older = {}, {}
        self.compatible.clear()

    def _merged(self, text: bytes) -> list[bytes]:
        """Plain merging, for short strings: used only to fill the pair table."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _pair_ok(self, left: int, right: int) -> bool:
        a, b = self.bytes_of[left], self.bytes_of[right]
        if len(self.compatible) > 2 * MEMORY_PIECES:
            self.compatible.clear()
        ok = self.compatible[left << 32 | right] = self._merged(a + b) == [a, b]
        return ok

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.id_of.get(word, -1)
        if whole in self.reached:
            return [whole]
        size, length, shorter, known = len(word), self.length, self.shorter, self.compatible
        longest = [-1] * (size + 1)
        for end, (back, token) in self.automaton.iter(word.decode("latin-1")):
            longest[end - back] = token  # ends ascend, so the longest of a start comes last
        dead: set[int] = set()
        taken: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < size:
            if token >= 0:
                end = at + length[token]
                if end not in dead:
                    ok = last < 0 or known.get(last << 32 | token)
                    if ok is None:
                        ok = self._pair_ok(last, token)
                    if ok:
                        taken.append(token)
                        at, last, token = end, token, longest[end]
                        continue
                token = shorter[token]
            else:
                dead.add(at)
                token = taken.pop()
                at -= length[token]
                last = taken[-1] if taken else -1
                token = shorter[token]
        return taken

    def _word(self, word: str) -> tuple[int, ...]:
        return tuple(map(self.number.__getitem__, self.merge(word.encode())))

    def _learn(self, piece: str) -> tuple[int, ...]:
        found = self.older.get(piece)
        if found is None:
            core = piece[1:] if piece[0] == " " else piece
            words = [piece] if core.isalpha() else self.cut.findall(piece)
            found = () if len(words) > 1 else self._word(piece)
            for word in words if len(words) > 1 else ():
                # The same word often comes back with another sign after it.
                found += self.memory.get(word) or self.memory.setdefault(word, self._word(word))
        if len(self.memory) >= MEMORY_PIECES:
            self.older, self.memory = self.memory, {}
        self.memory[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        ids: list[int] = []
        for k, part in enumerate(self.split(text)):
            if k % 2:
                ids.append(self.special[part])
                continue
            known, learn = self.memory.get, self._learn
            for piece in cut_pieces(part, self.pieces):
                if piece:
                    ids += known(piece) or learn(piece)
        return ids

    def joined(self, ids: list[int]) -> str:
        """Decimal ids with commas between them."""
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: np.ndarray) -> bytes:
        """All tokens' bytes, gathered through the offset table."""
        starts, lengths = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        ends = np.cumsum(lengths)
        if not len(ends) or not ends[-1]:
            return b""
        where = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
        return self.flat[where].tobytes()


def cut_pieces(text: str, pieces) -> list[str]:
    """Cut before every white space that follows another character; white space before a word goes with it."""
    if "\0" in text or _TWO_SPACES(text):
        return pieces.findall(text)
    return text.replace(" ", "\0 ").split("\0")


#: A space that another white space follows: only there a cut at every space could fall inside a pre-token.
_TWO_SPACES = re.compile(r" \s").search


@cache
def codec(path: str) -> Codec:
    found = Codec(path)
    keep("bpe", found.forget)
    return found


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``bpe_ids`` (little-endian 32-bit ids) and ``bpe_decoded`` (the decoded text) in place of clashing columns."""
    keep = [c for c in docs.columns if c not in ("bpe_ids", "bpe_decoded")]
    schema = docs.select(*keep).schema.add("bpe_ids", "binary").add("bpe_decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("bpe")
        coder = codec(path or vocabulary_path())
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            encoded = [np.array(coder.encode(t or ""), "<u4") for t in texts]
            decoded = [coder.decode(x).decode("utf-8", "replace") for x in encoded]
            ids = [x.tobytes() for x in encoded]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=[*batch.schema.names, "bpe_ids", "bpe_decoded"],
            )

    return docs.select(*keep).mapInArrow(run, schema)


def encoding_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document, from encoding and decoding its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("bpe")
        coder = codec(path or vocabulary_path())
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            data, offsets = utf8(batch.column(1))
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                ids = coder.encode(data[lo:hi].tobytes().decode("utf-8", "replace"))
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(coder.joined(ids).encode()).hexdigest())
                text = coder.decode(np.array(ids, np.int64)).decode("utf-8", "replace")
                of_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole document with the 50k byte-level vocabulary."""
    return encoding_digests(table(spark, sf_dir, "documents"))
