"""Texts beyond a block of the operators, which take a way of their own, and scores by a plain convolution."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import bpe, jaccard, quality, rules, suffix
from shelfline.llm.common import BLOCK_BYTES, utf8
from tests.llm.common import awkward, prose
from tests.llm.test_documents import _measured


@pytest.fixture(scope="module")
def long_rows():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghiéß", k=rng.randint(2, 9))) for _ in range(5000)]
    long = " ".join(rng.choices(words, k=400_000))
    assert len(long.encode()) > BLOCK_BYTES
    return [(1, long), (2, "short " + long[1_000_000:1_000_600].strip() + " end"), (3, long), (4, prose(4, 30))]


def test_long_texts_link(spark, long_rows):
    found = {r.doc_id: r.component_id for r in jaccard.near_components(awkward(spark, long_rows)).collect()}
    assert found == {1: 1, 2: 2, 3: 1, 4: 4}


def test_passages_of_long_texts_go(spark, long_rows):
    found = {r.doc_id: r for r in suffix.removal_digests(awkward(spark, long_rows)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    for i in (1, 3):
        assert (found[i].n_removed, found[i].n_spans, found[i].kept_sha256) == (found[i].n_bytes, 1, empty)
    assert found[2].kept_sha256 == hashlib.sha256(b"short end").hexdigest() or found[2].n_removed >= 590
    assert found[4].n_removed == 0


def test_long_texts_encode_and_decode(spark, long_rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())
    library.no_truncation()
    found = {r.doc_id: r for r in bpe.encoding_digests(awkward(spark, long_rows)).collect()}
    for i, text in long_rows:
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_long_texts_are_measured_whole(spark, long_rows):
    got = {r.doc_id: tuple(r[m] for m in rules.MEASURES) for r in rules.judge(awkward(spark, long_rows)).collect()}
    assert got == {i: _measured(t) for i, t in long_rows}


def by_hand(network: quality.Network, text: bytes) -> float:
    """One filter place at a time: the best of each filter per chunk of two halves, mean and best over chunks, one logit."""
    step, half = quality.STEP, quality.HALF
    halves = max(1, -(-(len(text) + step) // half))
    padded = text + bytes(halves * half + step - len(text))
    value = np.full((halves, quality.FILTERS), -np.inf)
    for at in range(0, halves * half, step):
        window = np.concatenate([network.embed[b].astype(float) for b in padded[at : at + 2 * step]])
        own = window[: quality.EMBED * step] @ network.left + window[quality.EMBED * step :] @ network.right
        value[at // half] = np.maximum(value[at // half], own)
    chunks = [np.tanh(np.maximum(value[k], value[k + 1]) if k + 1 < halves else value[k]) for k in range(halves)]
    found = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])
    return float(1 / (1 + np.exp(-(found @ network.out + network.bias[0]))))


def test_quality_scores_against_a_plain_convolution(spark):
    network, rng = quality.Network(3), np.random.default_rng(1)
    network.out[:] = rng.normal(0, 1, network.out.shape)
    network.bias[0] = 0.2
    texts = ["", "a", "é" * 130, prose(1, 40), prose(2, 400), "x" * 251, "y" * 252, "z" * 256]
    got = network.scores(*utf8(pa.array(texts, pa.string())))
    # The last place of a text reads into the next one's zeros or bytes only where its own padding ends.
    assert got == pytest.approx([by_hand(network, t.encode()) for t in texts], abs=1e-5)
    scored = quality.score(awkward(spark, list(enumerate(texts))), network).collect()
    assert [r["score"] for r in sorted(scored, key=lambda r: r.doc_id)] == pytest.approx(list(got))
