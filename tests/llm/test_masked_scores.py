from __future__ import annotations

import numpy as np
import pytest

from shelfline.llm import masked
from tests.llm.common import awkward, edge_rows, prose, words


def by_hand(text: str | None, model: masked.Network, vocabulary: masked.Vocabulary, counts: dict[int, int]) -> float:
    """Every word's probability from its neighbours on both sides, one place at a time, in double precision."""
    from tests.llm.test_documents import _one

    hashes, _ = masked._words(*_one(text or "")) if text else (np.zeros(0, np.uint64), None)
    classes, total = vocabulary.classes(hashes), 0.0
    for at in range(len(classes)):
        hidden = np.zeros(masked.DIM)
        for k, place in enumerate(masked.PLACES):
            near = classes[at + place] if 0 <= at + place < len(classes) else 0
            hidden += model.embed[k][near].astype(float)
        hidden = np.tanh(hidden)
        logits = hidden @ model.cluster.astype(float) + model.cluster_bias
        c, place = divmod(int(classes[at]), masked.INSIDE)
        inside = hidden @ model.inside[c].astype(float) + model.inside_bias[c]
        total += logits[c] - np.logaddexp.reduce(logits) + inside[place] - np.logaddexp.reduce(inside)
        if classes[at] > masked.WORDS:
            total += np.log(counts.get(int(hashes[at].view(np.int64)), 0) + masked.SMOOTH) - vocabulary.log_totals[classes[at] - masked.WORDS - 1]
    return total


def learned(spark, rows):
    """A network that has seen ``rows``, with a vocabulary of three words of their own, so that all others are in hash classes."""
    docs = awkward(spark, rows)
    counts = masked.word_counts(docs)
    vocabulary = masked.vocabulary(counts)
    keep = vocabulary.hashes[np.argsort(vocabulary.by)][:3]
    totals = np.full(masked.SHARED, masked.SMOOTH)
    small = masked.Vocabulary(keep.view(np.int64).tolist(), vocabulary.counts)
    known = {r["word"]: r["n"] for r in vocabulary.counts.collect()}
    for word, n in known.items():
        c = small.classes(np.array([word], np.int64).view(np.uint64))[0] - masked.WORDS - 1
        if c >= 0:
            totals[c] += n + masked.SMOOTH
    small.log_totals = np.log(totals)
    return docs, small, masked.train(docs, small), known


@pytest.mark.parametrize("pack", [1 << 20, 40])
def test_sums_against_one_word_at_a_time(spark, monkeypatch, pack):
    monkeypatch.setattr(masked, "PACK", pack)
    rows = [*edge_rows(), *[(100 + k, prose(k % 5, 30) + " one two three") for k in range(40)]]
    docs, vocabulary, model, counts = learned(spark, rows)
    assert np.abs(model.embed).max() > 0.1
    asked = [*rows[:7], (10, prose(5, 59)), (100, rows[len(edge_rows())][1]), (900, "never seen words"), (901, "one two one two")]
    asked = [(i, t) for i, t in asked if len(words(t)) < 500]
    got = {r.doc_id: r for r in masked.score(awkward(spark, asked).repartition(3), model, vocabulary).collect()}
    for i, text in asked:
        assert got[i].log_likelihood == pytest.approx(by_hand(text, model, vocabulary, counts), rel=1e-4, abs=1e-3)
        assert got[i].n_words == len(words(text))


def test_scores_do_not_depend_on_packs_or_partitions(spark, monkeypatch):
    rows = [*edge_rows(), *[(100 + k, prose(k, 40)) for k in range(50)]]
    docs, vocabulary, model, _ = learned(spark, rows)
    found = []
    for pack, parts in ((1 << 20, 1), (25, 5)):
        monkeypatch.setattr(masked, "PACK", pack)
        scored = masked.score(docs.repartition(parts), model, vocabulary).collect()
        found.append(sorted(((r.doc_id or -1, r.n_words, round(r.log_likelihood, 3)) for r in scored)))
    assert found[0] == found[1]


def test_large_weights_stay_finite(spark):
    model = masked.Network()
    for p in model.parameters():
        p[...] = np.where(p > 0, 300, -300)
    docs = awkward(spark, [(1, "a b c d"), (2, prose(3, 40))])
    rows = masked.score(docs, model, masked.vocabulary(masked.word_counts(docs))).collect()
    assert all(np.isfinite(r.log_likelihood) for r in rows)


def test_step_by_rows_is_a_step_by_clusters():
    rng = np.random.default_rng(3)
    network = masked.Network()
    padded = rng.integers(0, masked.CLASSES, 3000)
    padded[::3] = 7
    at = np.arange(4, 2900)
    for _ in range(3):
        network.train(padded, at[rng.permutation(len(at))])
    order, parts = network._by_cluster(padded[at])
    target = padded[at][order]
    hidden = network._hidden(padded, at[order])
    assert np.array_equal(hidden, np.tanh(sum(network.embed[k][padded[at[order] + p]] for k, p in enumerate(masked.PLACES))))
    own = network._inside_logits(hidden, target, parts)
    for c, lo, hi in parts:
        assert np.array_equal(own[lo:hi], hidden[lo:hi] @ network.inside[c] + network.inside_bias[c])
    # Against all classes at once.
    found = network.log_probabilities(padded, at)[order]
    logits = hidden @ network.cluster + network.cluster_bias
    wide = np.einsum("nd,cdk->nck", hidden, network.inside) + network.inside_bias
    chance = np.log(np.exp(wide) / np.exp(wide).sum(axis=2, keepdims=True)) + (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))[:, :, None]
    assert np.allclose(found, chance.reshape(len(at), -1)[np.arange(len(at)), target], atol=1e-4)
