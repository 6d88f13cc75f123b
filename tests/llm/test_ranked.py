from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import ranked
from tests.llm.common import awkward, edge_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs: list[tuple[int | None, str | None]], items: list[tuple[int | None, str | None]], k: int) -> list[tuple]:
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in counts:
            n = sum(c.values())
            m = 100 - 50 + ((50 * n * n_docs) // total if total else 0)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -score) for r, (score, none, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def corpus(n: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    words = [f"w{x}" for x in range(60)] + ["É", "naïve", "日本"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(n)]
    return [*rows, *[(1000 + i, rows[5][1]) for i in range(30)], *edge_rows(), (None, rows[6][1]), (5000, "W1-w2_w3, W4\x00w5 naïve.É")]


ITEMS = [
    (1, "w1 w2 W3 w3 É"), (2, None), (3, "..."), (4, "zzz unknown"), (4, "w7 w8 naïve"), (None, "w9 日本"),
    (6, " ".join(f"w{x}" for x in range(60)) + " " + " ".join(f"u{x}" for x in range(80)) + " no a b c d"), (7, "w1 w2 W3 w3 É"),
]


@pytest.mark.parametrize(("query_bytes", "most_terms", "rows", "k"), [(8 << 20, 4096, 4096, 50), (200, 4096, 7, 5), (8 << 20, 10, 64, 3)])
def test_ranks_against_all_scores(spark, monkeypatch, query_bytes, most_terms, rows, k):
    monkeypatch.setattr(ranked, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(ranked, "TERMS", most_terms)
    monkeypatch.setattr(ranked, "SLICE", rows)
    docs = corpus(300)
    frame = awkward(spark, docs).withColumn("rank", F.lit("clash")).withColumn("terms", F.lit("clash")).repartition(5)
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, score string")
    got = ranked.ranked_search(frame, items, k)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, ITEMS, k)


def test_very_long_text_and_empty_tables(spark):
    docs = [(1, "common " * 400_000 + "rare"), (2, "rare common"), (3, prose(1, 50))]
    items = spark.createDataFrame([(1, "rare common")], "item_id long, text string")
    frame = awkward(spark, docs)
    assert sorted((tuple(r) for r in ranked.ranked_search(frame, items).collect()), key=str) == brute(docs, [(1, "rare common")], 50)
    assert ranked.ranked_search(frame.limit(0), items).count() == 0
    assert ranked.ranked_search(frame, items.limit(0)).count() == 0


def test_groups_below_the_bound_are_not_scored():
    """Once the best k are far above, a slice's other groups are never scored; the result stays that of scoring all."""
    rng = np.random.default_rng(0)
    present = rng.random((70, 2000)) < 0.1
    parts = np.where(present, rng.integers(1, 1000, present.shape), 0).astype(np.int32)
    parts[:, :5], present[:, :5] = 1000, True
    weight, ids = rng.integers(1, 100, 70), rng.permutation(2000)
    best = ranked.Best(5)
    scored = ranked.search_slice(best, weight, parts, present, ids, np.zeros(2000, bool))
    scores = weight @ parts.astype(np.int64)
    order = np.lexsort((ids, -scores))[:5]
    assert (best.scores.tolist(), best.ids.tolist()) == (scores[order].tolist(), ids[order].tolist())
    assert scored < 200
