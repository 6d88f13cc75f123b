"""What a task holds at a time, and what it gives up for the next one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelfline.llm import common, masked, suffix
from tests.llm.common import awkward, prose


def test_a_task_gives_up_powers_of_long_texts():
    data = np.zeros(1 << 19, np.uint8)
    before = common.word_hashes(data, np.array([0]), np.array([len(data)]))
    assert common._POWERS
    common.make_room("another")
    assert not common._POWERS
    assert common.word_hashes(data, np.array([0]), np.array([len(data)])) == before


def test_texts_are_rebuilt_in_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * suffix.REBUILT + 7))], names=["n"])
    pieces = list(suffix._pieces(iter([batch, batch.slice(0, 0)])))
    assert [p.num_rows for p in pieces] == [suffix.REBUILT, suffix.REBUILT, 7, 0]
    assert pa.Table.from_batches(pieces).column("n").to_pylist() == batch.column(0).to_pylist()


def test_texts_behind_the_first_piece_lose_their_repeats(spark):
    passage = prose(999, 100)[: suffix.LENGTH + 20]
    rows = [(k, f"start{k} " + (passage if k in (3, suffix.REBUILT + 5) else "")) for k in range(suffix.REBUILT + 9)]
    kept = {r.doc_id: r.text for r in suffix.remove_repeats(awkward(spark, rows).coalesce(1)).collect()}
    assert all(kept[k].startswith(f"start{k}"[:5]) for k in kept)
    assert passage not in kept[3] and passage not in kept[suffix.REBUILT + 5]
    assert {k for k, t in kept.items() if t != dict(rows)[k]} == {3, suffix.REBUILT + 5}


def test_largest_of_rows_is_the_maximum():
    rng = np.random.default_rng(3)
    for width in (2, 3, 7, masked.INSIDE):
        x = rng.normal(size=(50, width)).astype(np.float32)
        assert np.array_equal(masked._largest(x), x.max(axis=1, keepdims=True))


def test_classes_of_hashes_with_the_same_first_bits():
    rng = np.random.default_rng(4)
    own = np.concatenate([rng.integers(0, 1 << 63, 300), np.arange(40), [-1, -2, (1 << 63) - 1]]).astype(np.int64)
    vocabulary = masked.Vocabulary(own.tolist())
    assert vocabulary.most >= 40
    asked = np.concatenate([own, own + 1000, rng.integers(0, 1 << 63, 500)]).astype(np.int64)
    place = {int(w): k + 1 for k, w in enumerate(own)}
    shared = masked.WORDS + 1 + masked._shared(asked.view(np.uint64))
    assert vocabulary.classes(asked.view(np.uint64)).tolist() == [place.get(int(w), int(c)) for w, c in zip(asked, shared, strict=True)]


def test_stored_passes_are_those_of_masked_places(spark):
    docs = awkward(spark, [(k, prose(k, 30 + k)) for k in range(20)]).coalesce(1)
    vocabulary = masked.vocabulary(masked.word_counts(docs))
    batch = masked._classes(docs, vocabulary).toArrow().combine_chunks().to_batches()[0]
    both = [np.frombuffer(x, "<i2").astype(np.int64) for x in batch.column(0).to_pylist()]
    classes = np.concatenate(both) & ((1 << masked.PASS_BITS) - 1)
    first = np.concatenate([[0], np.cumsum([len(x) for x in both])])
    assert classes.max() < masked.CLASSES
    padded, at = masked._contexts(classes, first)
    for step in range(masked.MASK_EVERY):
        found = np.concatenate([x for _, x in masked._masked_batches(iter([batch]), step)])
        assert sorted(found) == at[masked.masked_places(classes, first, step)].tolist()


def test_packs_count_a_word_once_for_each_document():
    parts = [(np.array([5, 5, 5, 6]), np.array([9, 2, 9, 9], np.uint64)), (np.array([8, 8]), np.array([2, 2], np.uint64))]
    word, runs, rows, times = (np.frombuffer(x, t) for x, t in zip(masked._packed(parts, 5), ("<u8", "<u4", "<u4", "<u4"), strict=True))
    assert (word.tolist(), runs.tolist(), rows.tolist(), times.tolist()) == ([2, 9], [2, 2], [0, 3, 0, 1], [1, 2, 2, 1])
