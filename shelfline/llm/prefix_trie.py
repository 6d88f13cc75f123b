"""The trie of conversation prefixes, counted and summed in flat node tables of bounded shards.

A prefix of a conversation has a digest: the exclusive or of its turns' digests, each mixed with its place. Equal digests are one
node. Shards are whole paths: conversations are dealt by id, so that no common first turn gathers anywhere. In a shard all
distinct digests get the slots of a minimal perfect hash (each lookup compares the digest that is kept in the slot), members are
counted into arrays by slot, and Spark adds up the shards. Then every node's own share is put where its least member's path lies,
and each shard adds its shares up through an array of parent slots, deepest turns first. A shard that holds a node holds all its
prefixes, so the sums over shards are the sums over subtrees.

Paths longer than ``WINDOW`` turns are cut into windows, which are worked off from the deepest; the sum of a cut node enters the
window above. Shards hold at most ``SHARD_ROWS`` rows and one window.

Edge cases: rows without a conv_id belong to no conversation and are left out; a null role or text is an empty one; turns of equal
number stand by a digest of role and text; repeated rows are turns of their own; null turns come first; empty and very long texts
are digested whole, outside Python; an empty table has no nodes; other columns are not read. Nodes are told apart by 128-bit
digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import mixed, table
from shelfline.session import written

#: Turns of one conversation that are worked on together, and rows of a shard besides.
WINDOW = 1 << 18
SHARD_ROWS = 1 << 20
#: Ids of one list that are joined to a text at a time.
IDS = 1 << 15

_WORD = r"[^\x20\x09-\x0D]+"


class NodeTable:
    """Minimal perfect hash over distinct 128-bit digests: ``n`` digests have the slots 0 to ``n - 1``.

    Level by level, digests that meet no other one in a bit array get their bit, the rest goes on to the next level; a slot is the
    rank of the bit. The digest kept in the slot tells whether a looked-up digest is really there.
    """

    def __init__(self, one: np.ndarray, two: np.ndarray) -> None:
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        one, two = one[new], two[new]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.one, self.two = np.empty_like(one), np.empty_like(two)
        self.size, base = len(one), 0
        while len(one):
            at = self._place(one, two, len(self.levels), 2 * len(one) + 1)
            alone = np.bincount(at, minlength=2 * len(one) + 1) == 1
            rank = base + np.cumsum(alone) - alone
            self.levels.append((alone, rank))
            here = alone[at]
            self.one[rank[at[here]]], self.two[rank[at[here]]] = one[here], two[here]
            base += int(here.sum())
            one, two = one[~here], two[~here]

    @staticmethod
    def _place(one: np.ndarray, two: np.ndarray, level: int, width: int) -> np.ndarray:
        return (mixed(one + two * np.uint64(2 * level + 1) + np.uint64(level)) % np.uint64(width)).astype(np.int64)

    def slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 where the table has none."""
        found = np.full(len(one), -1, np.int64)
        left = np.arange(len(one))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(one[left], two[left], level, len(alone))
            found[left[alone[at]]] = rank[at[alone[at]]]
            left = left[~alone[at]]
        at = np.flatnonzero(found >= 0)
        wrong = (self.one[found[at]] != one[at]) | (self.two[found[at]] != two[at])
        found[at[wrong]] = -1
        return found


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _bits(column: Column, first: int) -> Column:
    """Sixteen hexadecimal digits as a signed 64-bit number."""
    return F.conv(F.substring(column, first, 16), 16, -10).cast("long")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, place ``n`` from 0, digest and words of each turn. A long conversation is numbered by several tasks."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text).cast("binary"), 256)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"), digest.alias("digest")
    )
    order = ["conv_id", "turn", "one", "two", "copy"]
    rows = rows.select("conv_id", "turn", "words", _bits(F.col("digest"), 1).alias("one"), _bits(F.col("digest"), 17).alias("two"), F.monotonically_increasing_id().alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, words, one, two = _numbers(batch, "conv_id", "words", "one", "two")
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            n = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv))))
            if conv[0] == last:
                n[: first[1] if len(first) > 1 else len(n)] += seen
            last, seen = conv[-1], int(n[-1]) + 1
            yield _batch(conv_id=conv, part=np.full(len(conv), part, np.int64), seq=n, one=one, two=two, words=words)

    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = written(rows.mapInArrow(run, "conv_id long, part long, seq long, one long, two long, words long"), "trie-turns")
    runs = numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("turns"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a partition can have begun before it: at most one row per partition.
    begun = runs.withColumn("before", F.sum("turns").over(earlier)).where("before IS NOT NULL").select("conv_id", "part", "before")
    n = F.col("seq") + F.coalesce("before", F.lit(0))
    return numbered.join(F.broadcast(begun), ["conv_id", "part"], "left").select("conv_id", n.alias("n"), "one", "two", "words")


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """One row per rebuilt turn, and one of depth 0 per conversation: ``conv_id``, ``depth``, digest, words, whether it is the last."""
    ordered = ordered_turns(turns)
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    heads = ordered.where((F.col("n") < 3) & (F.col("conv_id") % 20 == 0)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("n", "one", "two", "words"))).alias("turns")  # three turns at most
    )
    convs = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")).withColumn("base", F.col("conv_id") - F.col("conv_id") % 20)
    convs = convs.join(heads, "base", "left").withColumn("h", taken.cast("int"))
    convs = convs.withColumn("head", F.when(F.col("turns").isNull() | (F.col("h") == 0), F.array().cast(heads.schema["turns"].dataType)).otherwise(F.slice("turns", 1, F.greatest("h", F.lit(1)))))
    convs = written(convs.select("conv_id", "length", "h", "head", F.size("head").cast("long").alias("taken")), "trie-conversations")
    own = ordered.where(F.col("n") >= taken).join(convs.select("conv_id", "length", "h", "taken"), "conv_id")
    own = own.select("conv_id", (F.col("n") - F.col("h") + 1 + F.col("taken")).alias("depth"), "one", "two", "words", (F.col("n") == F.col("length") - 1).alias("last"))
    short = F.col("length") <= F.col("h")
    head = convs.select("conv_id", short.alias("short"), "taken", F.posexplode("head").alias("at", "turn"))
    head = head.select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), "turn.one", "turn.two", "turn.words", (F.col("short") & (F.col("at") + 1 == F.col("taken"))).alias("last"))
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("one"), zero.alias("two"), zero.alias("words"), (short & (F.col("taken") == 0)).alias("last"))
    return own.unionByName(head).unionByName(roots)


def _window(depth: Column) -> Column:
    return F.floor(F.greatest(depth - 1, F.lit(0)) / F.lit(WINDOW)).cast("long")


def _mixed_turns(depth: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A turn's digest with its place in it; the root has none."""
    place = depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    parts = mixed(one.view(np.uint64) ^ place), mixed(two.view(np.uint64) + place)
    for p in parts:
        p[depth == 0] = 0
    return parts


def _segments(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _carried(rows: DataFrame) -> DataFrame:
    """The digest with which each later window of a long conversation begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, window, depth, one, two = _numbers(batch, "conv_id", "w", "depth", "one", "two")
            if len(conv):
                order = np.lexsort((window, conv))
                conv, window = conv[order], window[order]
                first = _segments(conv, window)
                sums = [np.bitwise_xor.reduceat(x[order], first).view(np.int64) for x in _mixed_turns(depth, one, two)]
                yield _batch(conv_id=conv[first], w=window[first], c1=sums[0], c2=sums[1])

    sums = rows.select("conv_id", "w", "depth", "one", "two").mapInArrow(run, "conv_id long, w long, c1 long, c2 long")
    sums = sums.groupBy("conv_id", "w").agg(F.bit_xor("c1").alias("c1"), F.bit_xor("c2").alias("c2"))
    earlier = Window.partitionBy("conv_id").orderBy("w").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("conv_id", "w", F.bit_xor("c1").over(earlier).alias("c1"), F.bit_xor("c2").over(earlier).alias("c2")).where("w > 0")


def prefixes(paths: DataFrame) -> tuple[DataFrame, int]:
    """Every path row with its window, its own digest (``p1``, ``p2``) and its parent's (``q1``, ``q2``); the last window."""
    rows = paths.withColumn("w", _window(F.col("depth")))
    last = rows.agg(F.max("w")).first()[0]
    zero = F.lit(0).cast("long")
    if last:
        rows = written(rows, "trie-paths")
        rows = rows.join(_carried(rows), ["conv_id", "w"], "left").withColumns({c: F.coalesce(c, zero) for c in ("c1", "c2")})
    else:
        rows = rows.withColumns({"c1": zero, "c2": zero})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # conversation, window, digest so far
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, window, depth, one, two, words, c1, c2 = _numbers(batch, "conv_id", "w", "depth", "one", "two", "words", "c1", "c2")
            first = _segments(conv, window)
            sizes = np.diff(np.append(first, len(conv)))
            ends: list[np.ndarray] = []
            before: list[np.ndarray] = []
            for k, (x, c) in enumerate(zip(_mixed_turns(depth, one, two), (c1.view(np.uint64), c2.view(np.uint64)), strict=True)):
                # Running sums of the whole batch, less what stood there before each path, and what the path began with.
                run_up = np.bitwise_xor.accumulate(x)
                start = np.concatenate([[np.uint64(0)], run_up])[first] ^ c[first]
                if held and held[:2] == (conv[0], window[0]):
                    start[0] = held[2 + k]
                after = run_up ^ np.repeat(start, sizes)
                ends.append(after)
                before.append(after ^ x)
            held = (conv[-1], window[-1], ends[0][-1], ends[1][-1])
            p1, p2, q1, q2 = (x.view(np.int64) for x in (*ends, *before))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (conv, window, depth, p1, p2, q1, q2, words)] + [batch.column("last")],
                names=["conv_id", "w", "depth", "p1", "p2", "q1", "q2", "words", "last"],
            )

    order = ["conv_id", "w", "depth"]
    rows = rows.select(*order, "one", "two", "words", "c1", "c2", "last").repartition("conv_id", "w").sortWithinPartitions(*order)
    schema = "conv_id long, w long, depth long, p1 long, p2 long, q1 long, q2 long, words long, last boolean"
    return written(rows.mapInArrow(run, schema), "trie-prefixes"), int(last or 0)


def shards(batches: Iterator[pa.RecordBatch], limit: int, *keys: str) -> Iterator[pa.RecordBatch]:
    """Batches of about ``limit`` rows that end where a key ends; without keys, anywhere."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        cut = int(_segments(*_numbers(whole, *keys))[-1]) if keys else rows
        if cut:
            yield whole.slice(0, cut)
        held = [whole.slice(cut)] if cut < rows else []
        rows -= cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def count_nodes(rows: DataFrame) -> DataFrame:
    """Every node once: digest, parent's digest, depth, words, ``n_convs`` and least ``conv_id`` of its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, SHARD_ROWS):
            conv, depth, words, p1, p2, q1, q2 = _numbers(shard, "conv_id", "depth", "words", "p1", "p2", "q1", "q2")
            node = NodeTable(p1.view(np.uint64), p2.view(np.uint64))
            slot = node.slots(p1.view(np.uint64), p2.view(np.uint64))
            least = np.full(node.size, np.iinfo(np.int64).max)
            np.minimum.at(least, slot, conv)
            flat = {"p1": p1, "p2": p2, "q1": q1, "q2": q2, "depth": depth, "words": words}
            for name, values in flat.items():
                flat[name] = np.empty(node.size, np.int64)
                flat[name][slot] = values
            yield _batch(**flat, n_convs=np.bincount(slot, minlength=node.size), conv_id=least)

    names = ["p1", "p2", "q1", "q2", "depth", "words"]
    parts = rows.select("conv_id", *names).mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "n_convs", "conv_id"]))
    alike = [F.min(n).alias(n) for n in names[2:]]  # the same in all parts
    return parts.groupBy("p1", "p2").agg(*alike, F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))


def sum_paths(conv: np.ndarray, depth: np.ndarray, digest: list[np.ndarray], parent: list[np.ndarray], shares: list[np.ndarray], top: int) -> tuple[NodeTable, np.ndarray, list[np.ndarray]]:
    """The shard's node table, each node's depth, and its shares summed over its part of the subtree.

    ``top`` is the depth of the nodes above which nothing is added; parents of the first rows below it get slots as well.
    """
    above = (depth == top + 1) if top else np.zeros(len(depth), bool)
    node = NodeTable(*(np.concatenate([d, q[above]]) for d, q in zip(digest, parent, strict=True)))
    slot, up = node.slots(*digest), np.full(node.size, -1, np.int64)
    level = np.full(node.size, top, np.int64)
    level[slot] = depth
    below = depth > top
    up[slot[below]] = node.slots(*(q[below] for q in parent))
    sums = []
    for share in shares:
        total = np.zeros(node.size, np.int64)
        np.add.at(total, slot, share)
        sums.append(total)
    order = np.argsort(-level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    for at in np.split(order, cuts):  # the deepest first
        if len(at) and level[at[0]] > top:
            for total in sums:
                np.add.at(total, up[at], total[at])
    return node, level, sums


def _sums_of_window(rows: DataFrame, shares: DataFrame, window: int) -> DataFrame:
    """Shares of a window's nodes (by conversation and depth) summed up its paths: ``p1``, ``p2``, ``depth``, ``leaves``, ``saved``."""
    zero = F.lit(0).cast("long")
    path = rows.where(F.col("w") == window).select("conv_id", "depth", "p1", "p2", "q1", "q2", zero.alias("leaves"), zero.alias("saved"), F.lit(1).alias("kind"))
    share = shares.select("conv_id", "depth", *[zero.alias(c) for c in ("p1", "p2", "q1", "q2")], "leaves", "saved", F.lit(0).alias("kind"))
    top = window * WINDOW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, SHARD_ROWS, "conv_id"):
            conv, depth, p1, p2, q1, q2, leaves, saved, kind = _numbers(shard, "conv_id", "depth", "p1", "p2", "q1", "q2", "leaves", "saved", "kind")
            at = np.flatnonzero(kind == 1)
            given = np.flatnonzero(kind == 0)
            to = np.searchsorted(at, given)  # shares stand before the row they belong to
            own = []
            for values in (leaves, saved):
                share = np.zeros(len(at), np.int64)
                np.add.at(share, to, values[given])
                own.append(share)
            digest, parent = ([x[at].view(np.uint64) for x in pair] for pair in ((p1, p2), (q1, q2)))
            node, level, sums = sum_paths(conv[at], depth[at], digest, parent, own, top)
            some = np.flatnonzero((sums[0] != 0) | (sums[1] != 0))
            yield _batch(p1=node.one[some].view(np.int64), p2=node.two[some].view(np.int64), depth=level[some], leaves=sums[0][some], saved=sums[1][some])

    order = ["conv_id", "depth", "kind"]
    both = path.unionByName(share).repartition("conv_id").sortWithinPartitions(*order)
    parts = both.mapInArrow(run, "p1 long, p2 long, depth long, leaves long, saved long")
    return parts.groupBy("p1", "p2", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def subtree_sums(rows: DataFrame, nodes: DataFrame, last_window: int) -> DataFrame:
    """``p1``, ``p2`` and, over each node's subtree, ``leaves`` and ``saved`` (``nodes`` has both as the node's own share)."""
    own = nodes.select("conv_id", "depth", "leaves", "saved")
    found, entering = [], None
    for window in range(last_window, -1, -1):
        shares = own.where(_window(F.col("depth")) == window)
        shares = shares if entering is None else shares.unionByName(entering)
        sums = written(_sums_of_window(rows, shares, window), "trie-sums")
        found.append(sums.where(F.col("depth") > window * WINDOW) if window else sums)
        cut = sums.where(F.col("depth") == window * WINDOW).select("p1", "p2", "leaves", "saved")
        entering = nodes.select("p1", "p2", "conv_id", "depth").join(cut, ["p1", "p2"]).select("conv_id", "depth", "leaves", "saved")
    total = found[0]
    for more in found[1:]:
        total = total.unionByName(more)
    return total.select("p1", "p2", "leaves", "saved")


def id_digests(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """SHA-256 of each key's ascending numbers, joined by commas. Many tasks write the pieces; one hash reads a key's pieces in turn."""
    names = [*keys, "piece", "ids"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _numbers(batch, *keys, number)
            first = np.unique(np.concatenate([_segments(*columns[:-1]), np.arange(0, batch.num_rows, IDS)]))
            texts = [",".join(map(str, x.tolist())) for x in np.split(columns[-1], first[1:])]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[first]) for c in columns), pa.array(texts, pa.string())], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            done = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0] == key:
                    held[1].update(b",")
                else:
                    done += held and [(*held[0], held[1].hexdigest())]
                    held = [key, hashlib.sha256()]
                held[1].update(ids.encode())
            if done:
                yield _rows(done)
        if held:
            yield _rows([(*held[0], held[1].hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=[*keys, "sha256"])

    columns = ", ".join(f"{k} long" for k in keys)
    pieces = rows.select(*keys, number).repartitionByRange(*keys, number).sortWithinPartitions(*keys, number).mapInArrow(join, f"{columns}, piece long, ids string")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "piece").mapInArrow(read, f"{columns}, sha256 string")


def prefix_trie(turns: DataFrame, paths: Callable[[DataFrame], DataFrame] = rebuilt_paths) -> DataFrame:
    """One row per node: least member, depth, parent's least member, members, children, leaves and saved words below it, and the
    digest of the conversations that end there."""
    rows, last_window = prefixes(paths(turns))
    nodes = written(count_nodes(rows), "trie-nodes")
    children = nodes.where(F.col("depth") > 0).groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["p1", "p2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")}
    nodes = written(nodes.withColumns(own), "trie-shares")
    sums = subtree_sums(rows, nodes, last_window).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
    ends = id_digests(rows.where("last"), ["p1", "p2"], "conv_id").withColumnRenamed("sha256", "ends_sha256")
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.where(F.col("depth") > 0).join(parents, ["q1", "q2"], "left")
    root = nodes.where(F.col("depth") == 0).withColumn("parent_conv_id", F.lit(None).cast("long"))
    joined = named.unionByName(root).join(sums, ["p1", "p2"], "left").join(ends, ["p1", "p2"], "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", zero).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


ORACLE = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS n,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS length, conv_id - conv_id % 20 AS base,
  xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
    lambda i: [ord(substr(conv_id::VARCHAR, CAST(i AS INTEGER), 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
  FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.n, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.n < c.h
  UNION ALL SELECT c.conv_id, t.n, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.n >= c.h),
p AS (SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
  string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS k
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
a AS (SELECT conv_id, depth, words, k, lag(k, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM p
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c),
m AS (SELECT k, any_value(parent) AS parent, any_value(depth) AS depth, any_value(words) AS words, count(*) AS n_convs, min(conv_id) AS conv_id
  FROM a GROUP BY k),
ch AS (SELECT parent AS k, count(*) AS n_children FROM m WHERE parent IS NOT NULL GROUP BY 1),
v AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN ch USING (k)),
s AS (SELECT a.k, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM v JOIN a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY 1),
e AS (SELECT k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM
  (SELECT conv_id, k, depth, max(depth) OVER (PARTITION BY conv_id) AS most FROM a) WHERE depth = most GROUP BY 1)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM v JOIN s USING (k) LEFT JOIN e USING (k) LEFT JOIN v u ON u.k = v.parent
"""
