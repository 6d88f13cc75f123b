from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import decontaminate, graph, jaccard, suffix
from tests.llm.common import awkward, covered, edge_rows, edited, near_classes, prose, shingles

SF_DIR = "/root/testdata/sf0.001"


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9), (7, 7), *[(100, k) for k in range(101, 160)]]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {found[k] for k in range(1, 6)} == {1} and found[8] == found[9] == 8 and 7 not in found
    assert all(found[k] == 100 for k in range(100, 160))
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def _near_rows() -> list[tuple[int | None, str | None]]:
    rows = edge_rows()
    for k in range(60):  # a group of near copies, a chain of slow change, and unrelated texts that share a passage
        rows.append((1000 + k, edited(prose(1, 120), k, 0.015)))
    text = prose(2, 150)
    for k in range(12):
        text = edited(text, 500 + k, 0.02)
        rows.append((2000 + k, text))
    for k in range(40):
        rows.append((3000 + k, prose(3, 30) + " " + prose(4000 + k, 90)))
    for k in range(60):  # light sets
        rows.append((5000 + k, edited(prose(10 + k % 6, 14), k, 0.05)))
        rows.append((6000 + k, " ".join(prose(40 + k % 4, 24).split()[: 16 + k % 9])))
    return rows


def test_jaccard_against_all_pairs(spark):
    rows = _near_rows()
    found = jaccard.near_components(awkward(spark, rows).withColumn("n_shingles", F.lit(1))).collect()
    classes = near_classes([t for _, t in rows])
    least: dict[int, int | None] = {}
    for (i, _), c in zip(rows, classes, strict=True):
        least[c] = i if least.get(c) is None or i is not None and i < least[c] else least[c]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = sorted((key((i, len(shingles(t)), least[c] if shingles(t) else i)) for (i, t), c in zip(rows, classes, strict=True)))
    assert sorted(key((r.doc_id, r.n_shingles, r.component_id)) for r in found) == want
    assert jaccard.near_components(awkward(spark, rows).limit(0)).count() == 0


def test_boundary_follows_cost():
    assert jaccard.boundary(0) < jaccard.boundary(3) < jaccard.boundary(8) <= jaccard.LIGHT_MOST


def _repeat_rows() -> list[tuple[int | None, str | None]]:
    rows = [*edge_rows(), (40, "na" * 700), (41, "=" * 399), (42, "=" * 399)]
    base = prose(1, 400)
    for k in range(15):  # passages of all lengths around the limit, at all kinds of places
        cut = base[100 + k * 37 : 100 + k * 37 + 385 + 4 * k]
        rows.append((100 + k, prose(200 + k, 40 + 9 * k) + cut + prose(300 + k, 20 + k)))
    rows += [(500 + k, edited(base, k, 0.006)) for k in range(12)]
    rows += [(600 + k, base) for k in range(5)]
    once = prose(77, 100)
    rows += [(700, once + " " + once), (701, once[:420]), (702, once[3:402])]
    return rows


def test_suffix_against_all_windows(spark):
    rows = _repeat_rows()
    found = suffix.removal_digests(awkward(spark, rows).withColumn("spans", F.lit(1))).collect()
    want = []
    for (i, t), flags in zip(rows, covered([t for _, t in rows]), strict=True):
        runs = sum(f and not (k and flags[k - 1]) for k, f in enumerate(flags))
        want.append((i or -1, len((t or "").encode()), sum(flags), runs))
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans) for r in found) == sorted(want)
    assert suffix.removal_digests(awkward(spark, rows).limit(0)).count() == 0


def test_suffix_asks_once_before_a_wide_gap(spark):
    # The first cut comes after more bytes than a passage may hold before it: passages there hang on no cut, and occur once.
    shared = "ab" * 110 + "".join(random.Random(3).choices("abcdefgh ", k=175))
    rows = [(k, start + shared) for k, start in enumerate(("d" * 80, "ef" * 40, "ghi" * 27))]
    assert not any(map(any, covered([t for _, t in rows])))
    found = suffix.removal_digests(awkward(spark, rows)).collect()
    assert [(r.doc_id, r.n_removed) for r in sorted(found)] == [(0, 0), (1, 0), (2, 0)]


def test_suffix_spans_are_joined(spark):
    ranges = [(1, 5, 5), (1, 0, 3), (1, 4, 4), (1, 9, 12), (1, 10, 11), (1, 14, 14), (2, 3, 3), (-7, 0, 900), (-7, 2, 2), (-7, 901, 901)]
    found = suffix.joined_spans(spark.createDataFrame(ranges, "rid long, first long, last long")).collect()
    assert {r.rid: [tuple(x) for x in r.spans] for r in found} == {1: [(0, 5), (9, 12), (14, 14)], 2: [(3, 3)], -7: [(0, 901)]}


def test_suffix_asks_in_groups():
    data = np.frombuffer(prose(3, 3000).encode(), np.uint8)
    offsets = np.array([0, len(data) // 3, len(data)])
    cuts = suffix._block_cuts(data, offsets)
    asked = {"at": cuts["at"], "gap": cuts["gap"], "upper": np.full(len(cuts["at"]), suffix.FAR)}
    found = suffix._asked_groups(data, offsets, cuts["doc"], asked)
    # Every passage is asked once, whether it hangs on a cut or not.
    places = suffix._expanded(offsets[found["doc"]] + found["at"], found["n"])
    assert sorted(places) == [k for a, b in zip(offsets, offsets[1:], strict=False) for k in range(a, b - suffix.LENGTH + 1)]
    found["rid"] = found.pop("doc") + 10
    sent = suffix._packed_groups([found], 4)
    assert sum(len(x.as_py()) for f in ("key", "rid", "at", "n", "known") for x in sent.column(f)) < 12 * len(places)
    # Copies in the same task are sent as ranges, without hashes.
    twice = suffix._packed_groups([found, {**found, "rid": found["rid"] + 10}], 4)
    assert sum(len(x.as_py()) for x in twice.column("key")) == 8 * len(set(found["key"].tolist()))


def test_suffix_order(spark):
    strings = {-1: [3, 1, 2, 3, 1, 2, 3], 2: [2, 3, 1], -3: [1], -4: [3, 1, 2, 3, 9], 5: [3, 1, 2, 3, 1, 2, 1, 1]}
    rows = [(s, i, x) for s, xs in strings.items() for i, x in enumerate(xs)]
    found = {(r.s, r.i): r["rank"] for r in suffix.suffix_order(spark.createDataFrame(rows, "s long, i long, x long")).collect()}
    suffixes = {(s, i): xs[i:] for s, xs in strings.items() for i in range(len(xs))}
    assert found == {k: 1 + sum(o < v for o in suffixes.values()) for k, v in suffixes.items()}


def test_decontamination(spark):
    item = prose(1, 40)
    items = [(1, item), (2, "Red Green blue"), (3, None), (4, ""), (None, prose(9, 30)), (5, prose(3, 30)), (5, prose(3, 30)), (6, "solo")]
    bench = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, doc_id string")
    rows = [
        *edge_rows(), (50, prose(60, 3000) + " " + item + " " + prose(61, 3000)), (51, " ".join(item.split()[:33])), (52, " ".join(item.split()[:20])),
        (53, "see red\tgreen BLUE now"), (54, "red blue green"), (55, "".join(c.upper() if c.isascii() else c for c in prose(3, 30))), (56, "SOLO"), (56, "other"), (57, prose(9, 30)),
    ]
    docs = awkward(spark, rows)
    found = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())
    assert found == [(50, 1), (51, 1), (53, 2), (55, 5), (56, 6)]
    kept = [r.doc_id for r in decontaminate.clean(docs, bench).collect()]
    assert sorted(x or -1 for x in kept) == sorted(i or -1 for i, _ in rows if i not in (50, 51, 53, 55, 56))
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    plan = decontaminate._hash_shingles(docs, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stages_keep_one_of_each_group(spark):
    rows = _near_rows()
    docs = awkward(spark, rows).withColumn("_rows", F.lit("clash"))
    kept = corpus_pipeline.jaccard_join(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    classes = near_classes([t for _, t in rows])
    empty = sum(not shingles(t) for _, t in rows)
    groups = {c for (_, t), c in zip(rows, classes, strict=True) if shingles(t)}
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(groups) + empty and 1000 in ids and 2000 in ids
    cleaned = corpus_pipeline.suffix_dedup(spark, awkward(spark, _repeat_rows()), SF_DIR).collect()
    texts = {}
    for (i, t), flags in zip(_repeat_rows(), covered([t for _, t in _repeat_rows()]), strict=True):
        raw = bytes(b for b, f in zip((t or "").encode(), flags, strict=True) if not f)
        if raw or not t:
            texts.setdefault(i or -1, []).append(raw.decode("utf-8", "ignore"))
    got: dict[int, list[str]] = {}
    for r in cleaned:
        got.setdefault(r.doc_id or -1, []).append(r.text or "")
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_pipeline_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            assert after.dtypes == docs.dtypes
        docs = corpus_pipeline.written(after, "test-stage")
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    assert set(docs.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_decontamination_judges_each_row(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("length(text) > 100").first().text
    docs = awkward(spark, [(None, item), (7, item), (7, "a clean text of its own"), (None, "another clean text"), (8, None)])
    kept = corpus_pipeline.benchmark_decontamination(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "another clean text"), (7, "a clean text of its own"), (8, "")]


def test_a_worker_gives_freed_memory_back(monkeypatch):
    from shelfline.llm import common

    asked, forgotten = [], []
    monkeypatch.setattr(common, "_TRIM", asked.append)
    monkeypatch.setattr(common, "_KEPT", {"a": lambda: forgotten.append("a"), "b": lambda: forgotten.append("b")})
    common.make_room("a")
    assert forgotten == ["b"] and asked == [0]


def test_bytes_are_translated_by_a_table():
    from shelfline.llm import common

    data = np.arange(512, dtype=np.int64).astype(np.uint8)[3:]
    assert np.array_equal(common.translated(data, common.LOWER), common.LOWER[data])
    assert common.translated(data, common._SPACE).dtype == bool
    assert np.array_equal(common.translated(data, common._SPACE), common._SPACE[data])
