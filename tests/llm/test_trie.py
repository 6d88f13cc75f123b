from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shelfline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    """Rebuilt turns of each conversation; rows with equal turns must be equal."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows: list[tuple]) -> list[tuple]:
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def conversations(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["hi", "yes  no\tok", "", None, "é 日本", "hi "]
    rows = []
    for c in [*range(60), *range(-25, -15), 100, 141, 10**12 + 3]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t if rng.random() < 0.9 or t else None, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    rows += [(200 + k, t, "user", f"same {t}") for k in range(0, 60) for t in range(4)]  # copies
    rows += [(300, t, "user", f"w {t % 2}") for t in range(50)]  # a long one, and one that leaves it late
    rows += [(320, t, "user", f"w {t % 2}" if t < 45 else "x y z") for t in range(47)]
    rows += [(500, 1, "user", "twice"), (500, 1, "user", "twice"), (None, 0, "user", "nobody"), (None, None, None, None)]
    rows += [(520, 0, "user", "long " * 300_000)]
    return rows


@pytest.mark.parametrize(("window", "shard", "ids"), [(1 << 18, 1 << 20, 1 << 15), (4, 7, 2)])
def test_nodes_against_nested_prefixes(spark, monkeypatch, window, shard, ids):
    for name, value in (("WINDOW", window), ("SHARD_ROWS", shard), ("IDS", ids)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = conversations(window)
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(6)
    got = sorted(tuple(r) for r in prefix_trie.prefix_trie(frame).collect())
    assert got == brute(rows)
    assert [r for r in got if r[1] == 0][0][3] == len({r[0] for r in rows} - {None})


def test_empty_table_and_one_conversation(spark):
    frame = spark.createDataFrame([(7, None, None, None, None)], SCHEMA)
    assert [tuple(r) for r in prefix_trie.prefix_trie(frame).collect()] == brute([(7, None, None, None)])
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0


def test_node_table_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    one, two = rng.integers(0, 50, 4000).astype(np.uint64), rng.integers(0, 1 << 60, 4000).astype(np.uint64)
    table = prefix_trie.NodeTable(np.concatenate([one, one[:500]]), np.concatenate([two, two[:500]]))
    slots = table.slots(one, two)
    assert table.size == len({*zip(one.tolist(), two.tolist(), strict=True)})
    assert sorted(set(slots.tolist())) == list(range(table.size))
    assert (table.slots(one, two + np.uint64(1)) == -1).sum() >= 3990
    assert prefix_trie.NodeTable(one[:0], two[:0]).slots(one[:3], two[:3]).tolist() == [-1] * 3


def test_one_conversation_over_many_partitions(spark):
    """Its turns are numbered across the partitions that share it."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = spark.range(0, 3000, 1, 8).selectExpr("40L AS conv_id", "id AS turn", "'user' AS role", "cast(id % 7 AS string) AS text")
        ordered = prefix_trie.ordered_turns(frame)
        assert sorted(r.n for r in ordered.select("n").collect()) == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
