"""Small tables with every awkward row, and brute-force versions."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgéß", k=rng.randint(2, 9))) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    return " ".join(w if rng.random() > share else f"x{rng.randint(0, 10**6)}" for w in words)


def awkward(spark, rows: list[tuple[int | None, str | None]]):
    """Documents with nulls in all other columns of some rows."""
    data = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def edge_rows() -> list[tuple[int | None, str | None]]:
    long = prose(99, 6000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two THREE"), (6, "one two three"), (7, long), (8, long), (8, long),
        (None, prose(5, 60)), (None, None), (9, prose(5, 60)), (10, prose(5, 59)), (11, "a b c d e f"), (12, "a b c d e"),
        (13, "z" * 3000), (14, "no no " * 400),
    ]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, lower=True) -> frozenset:
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "") if lower else text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_classes(texts: list[str | None]) -> list[int]:
    """Position of the first text of each text's component."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return [find(x) for x in range(len(texts))]


def covered(texts: list[str | None], length: int = 400) -> list[list[bool]]:
    """Bytes covered by a string of ``length`` bytes that starts at two places at least."""
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        edge = [0] * (len(d) + 1)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        total, flags = 0, []
        for i in range(len(d)):
            total += edge[i]
            flags.append(total > 0)
        out.append(flags)
    return out
