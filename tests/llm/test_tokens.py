from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import bpe, wavelet
from tests.llm.common import awkward, edge_rows

tokenizers = pytest.importorskip("tokenizers")

TEXTS = [
    "", " ", "  ", "a", " a", "a ", "  a  b", "a\n b", "a \nb", " \n\t x y z", "a\n\n  b", "don't I'll 123abc  \n\n foo", "ÀÉ ß  ñ\u00a0x",
    "日本語 テキスト é", "a\x1cb \x85 c", "a\0b", "<|endoftext|>hi <|endoftext|>", "aaaaaaaaaaaaaaaaaaaaaaaa" * 9, "x" * 5000, "\u2003a \u2003b", "!!!*** ###",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.vocabulary_path())


def test_encoder_is_the_library(library):
    own, other = bpe.codec(bpe.vocabulary_path()), wavelet._library(bpe.vocabulary_path())
    for text in TEXTS:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert np.frombuffer(other.encode(text), "<u4").tolist() == ids, text
        assert own.decode(np.array(ids, np.int64)).decode() == library.decode(ids, skip_special_tokens=False)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_PIECES", 3)
    own = bpe.Codec(bpe.vocabulary_path())
    for text in TEXTS * 2:
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_digests_and_round_trip(spark, library):
    docs = awkward(spark, edge_rows()).withColumn("bpe_ids", F.lit(1)).withColumn("n_tokens", F.lit(2))
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encoding_digests(docs).collect())
    want = []
    for i, text in edge_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i is None, i or 0, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(want)
    encoded = bpe.encode_documents(docs).select("text", "bpe_decoded", "n_tokens").collect()
    assert all((r.text or "") == r.bpe_decoded and r.n_tokens == 2 for r in encoded)
    assert bpe.encoding_digests(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 4000])
def test_wavelet_matrix(n):
    ids = np.random.default_rng(n).integers(0, 90, n)
    matrix = wavelet.WaveletMatrix.build(ids.astype(np.uint32))
    assert (matrix.all() == ids).all() and (matrix.access(np.arange(n)) == ids).all()
    for token in (0, 7, 89, 90, 70_000):
        assert (matrix.select(token) == np.flatnonzero(ids == token)).all()
        for at in (0, n // 3, n, n + 5):
            assert matrix.rank(token, at) == (ids[:at] == token).sum()


def test_shards(spark, library, tmp_path):
    rows = [r for r in edge_rows() if r[0] is not None]
    wavelet.write_shards(awkward(spark, rows), str(tmp_path / "a"), shard_tokens=50)
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in wavelet.read_documents(spark, str(tmp_path / "a")).collect())
    start, want = 0, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == want
    counts = wavelet.token_counts(spark, str(tmp_path / "a"), [0, 5]).groupBy("token").agg(F.sum("occurrences").alias("n"))
    assert {r.token: r.n for r in counts.collect()}[0] == sum(library.encode(t or "", add_special_tokens=False).ids.count(0) + 1 for _, t in rows)
    wavelet.write_shards(awkward(spark, edge_rows()), str(tmp_path / "b"))
    first = wavelet.read_documents(spark, str(tmp_path / "b"), with_ids=True).orderBy("start").first()
    assert first.doc_id is None and len(first.ids) == 4 * first.n_tokens
    wavelet.write_shards(awkward(spark, edge_rows()).limit(0), str(tmp_path / "c"))
    assert wavelet.read_documents(spark, str(tmp_path / "c")).count() == 0


def test_words_of_letters_are_the_library_s(library):
    own = wavelet._library(bpe.vocabulary_path())
    own.forget()
    for word in ("a", " a", "Ab", " Zebra", " straße", "naïve", " x1", "!", " .", "\n", "日本"):
        assert np.frombuffer(own._word(word), "<u4").tolist() == library.encode(word, add_special_tokens=False).ids, word
    assert own.space == own.letters[32]


def test_matrix_of_random_ids_comes_back():
    rng = np.random.default_rng(5)
    for n, most in ((1, 1), (513, 2), (5000, 50_000), (3000, 1 << 20)):
        ids = rng.integers(0, most, n).astype(np.uint32)
        matrix = wavelet.WaveletMatrix.build(ids)
        assert matrix.all().tolist() == ids.tolist() == matrix.access(np.arange(n)).tolist()
