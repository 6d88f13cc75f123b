"""Regular expressions over bytes, compiled to minimal deterministic automata in flat transition arrays.

The syntax is what the rules need: bytes, ``\\x`` escapes, classes with ranges and negation, groups, ``(?i:...)`` for letters in
either case, ``|``, ``?``, ``*``, ``+``, ``{n,}`` and ``{n}``. A pattern becomes a tree, the tree a nondeterministic automaton
(read forwards, or backwards by reversing every sequence), subset construction makes it deterministic, and partition refinement
makes it minimal. Bytes that no rule tells apart share one column.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np

Tree = tuple  # ("set", frozenset) | ("cat", parts) | ("alt", parts) | ("rep", part, least, unbounded)


def parse(pattern: str) -> Tree:
    tokens = re.findall(r"\\x[0-9A-Fa-f]{2}|\\.|\{\d+,?\}|\(\?i:|\[\^?\]?(?:\\x[0-9A-Fa-f]{2}|\\.|[^\]])*\]|.", pattern)
    tree, rest = _alternatives(tokens, False)
    if rest:
        raise ValueError(f"unbalanced pattern {pattern!r}")
    return tree


def _byte(token: str) -> int:
    return int(token[2:], 16) if token.startswith("\\x") else ord(token[-1])


def _folded(members: set[int], fold: bool) -> Tree:
    if fold:
        members = members | {b ^ 32 for b in members if chr(b).isascii() and chr(b).isalpha()}
    return ("set", frozenset(members))


def _members(token: str) -> set[int]:
    inside = re.findall(r"\\x[0-9A-Fa-f]{2}|\\.|.", token[1:-1])
    negated = inside[:1] == ["^"]
    inside, members = inside[negated:], set()
    while inside:
        if len(inside) > 2 and inside[1] == "-":
            members |= set(range(_byte(inside[0]), _byte(inside[2]) + 1))
            inside = inside[3:]
        else:
            members.add(_byte(inside.pop(0)))
    return set(range(256)) - members if negated else members


def _alternatives(tokens: list[str], fold: bool) -> tuple[Tree, list[str]]:
    options: list[list[Tree]] = [[]]
    while tokens and tokens[0] != ")":
        token, tokens = tokens[0], tokens[1:]
        if token == "|":
            options.append([])
        elif token in ("(", "(?i:"):
            inner, tokens = _alternatives(tokens, fold or token != "(")
            if tokens[:1] != [")"]:
                raise ValueError("a group is not closed")
            options[-1].append(inner)
            tokens = tokens[1:]
        elif token in ("?", "*", "+") or re.fullmatch(r"\{\d+,?\}", token):
            last = options[-1].pop()
            if token == "?":
                options[-1].append(("alt", [last, ("cat", [])]))
            elif token.endswith("}") and not token.endswith(",}"):
                options[-1].append(("cat", [last] * int(token[1:-1])))
            else:
                least = {"*": 0, "+": 1}.get(token)
                options[-1].append(("rep", last, int(token[1:-2]) if least is None else least))
        else:
            options[-1].append(_folded(_members(token) if token[0] == "[" and len(token) > 1 else {_byte(token)}, fold))
    parts = [("cat", x) for x in options]
    return (parts[0] if len(parts) == 1 else ("alt", parts)), tokens


class _Nfa:
    """Steps on a set of bytes and empty steps, by numbered state."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.empty.append([])
        return len(self.steps) - 1

    def add(self, tree: Tree, at: int, backwards: bool) -> int:
        """Build ``tree`` behind state ``at``; the state behind it."""
        if tree[0] == "set":
            to = self.state()
            self.steps[at].append((tree[1], to))
            return to
        if tree[0] == "cat":
            for part in reversed(tree[1]) if backwards else tree[1]:
                at = self.add(part, at, backwards)
            return at
        if tree[0] == "alt":
            to = self.state()
            for part in tree[1]:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[self.add(part, begin, backwards)].append(to)
            return to
        for _ in range(tree[2]):
            at = self.add(tree[1], at, backwards)
        loop = self.state()
        self.empty[at].append(loop)
        self.empty[self.add(tree[1], loop, backwards)].append(loop)
        return loop

    def closed(self, states: frozenset[int] | set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for to in self.empty[todo.pop()]:
                if to not in found:
                    found.add(to)
                    todo.append(to)
        return frozenset(found)


class Dfa(NamedTuple):
    """``table[state + column]`` is the next state, times the number of columns; the state 0 starts.

    The last column belongs to no byte and leads to the start. States that accept come last, from ``first_final`` on;
    ``accepts[state // columns]`` has one bit per rule. ``dead`` is the state without a way to accept, or -1.
    """

    columns: int
    table: np.ndarray
    accepts: np.ndarray
    first_final: int
    dead: int


def byte_columns(trees: list[Tree]) -> np.ndarray:
    """The column of each byte: bytes that lie in the same sets share one."""
    sets: list[frozenset] = []
    todo = list(trees)
    while todo:
        tree = todo.pop()
        if tree[0] == "set":
            sets.append(tree[1])
        else:
            todo.extend(tree[1] if tree[0] in ("cat", "alt") else [tree[1]])
    member = np.array([[b in s for s in sets] for b in range(256)], bool).reshape(256, -1)
    return np.unique(member, axis=0, return_inverse=True)[1].reshape(-1).astype(np.uint8)


def compiled(trees: list[Tree], columns: np.ndarray, *, backwards: bool, anywhere: bool) -> Dfa:
    """One automaton for all ``trees``: it tells, after each byte, which of them end there.

    ``anywhere`` lets a match begin behind any byte; else it begins with the first one.
    """
    nfa = _Nfa()
    root = nfa.state()
    finals = []
    for tree in trees:
        begin = nfa.state()
        nfa.empty[root].append(begin)
        finals.append(nfa.add(tree, begin, backwards))
    n = int(columns.max()) + 1
    sample = [int(np.flatnonzero(columns == c)[0]) for c in range(n)]
    start = nfa.closed({root})
    number, order, rows = {start: 0}, [start], []
    for states in order:  # grows while it is walked
        row = []
        for byte in sample:
            to = {t for s in states for members, t in nfa.steps[s] if byte in members}
            after = nfa.closed(to | {root} if anywhere else to)
            if after not in number:
                number[after] = len(order)
                order.append(after)
            row.append(number[after])
        rows.append(row)
    table = np.array(rows, np.int64)
    accepts = np.array([sum(1 << r for r, f in enumerate(finals) if f in states) for states in order], np.int64)
    # Partition refinement: states are alike if they accept alike and lead to alike states on every column.
    alike = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([alike, alike[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == alike.max():
            break
        alike = finer
    one = np.unique(alike, return_index=True)[1]  # a state of each class
    # The start first, accepting classes last.
    rank = np.lexsort((one, accepts[one] != 0, one != 0)) if not accepts[0] else np.argsort(one)
    place = np.empty(len(one), np.int64)
    place[rank] = np.arange(len(one))
    one = one[rank]
    small, accepts = place[alike[table[one]]], accepts[one]
    table = np.column_stack([small, np.full(len(one), place[alike[0]])]) * (n + 1)
    idle = np.flatnonzero((small == np.arange(len(one))[:, None]).all(axis=1) & (accepts == 0))
    first_final = int(np.argmax(accepts != 0)) if accepts.any() else len(one)
    dead = int(idle[0]) * (n + 1) if len(idle) and not anywhere else -1
    return Dfa(n + 1, table.ravel().astype(np.int32), accepts, first_final * (n + 1), dead)
