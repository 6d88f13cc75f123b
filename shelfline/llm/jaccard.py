"""N-gram Jaccard join by size: subsets of light sets are enumerated, inverted lists are scanned for heavy ones.

A document's set holds the 64-bit hashes of its distinct shingles of five words. Two documents link when their sets'
similarity is at least three quarters. Equal sets are one class from the start; links are sought between classes.

A set of n shingles can only link to a set with which it shares ``ceil(0.75 n)``; in any common order of all shingles the two
share one of the first ``n - ceil(0.75 n) + 1``, and two of one more. The order puts frequent shingles last, so that lists stay
short. Heavy sets are entered in the inverted lists of their first shingles; light sets are entered under every pair of theirs,
which says more than one shingle at the price of more entries. The boundary is where both cost the same, from the mean length
of the shared lists. Sets near the boundary are entered in both ways.

Entries whose key no other class has are dropped first. In every remaining list the set with the fewest rare shingles is the
head, and every set is verified against the few heads that it meets most often; this joins groups of near copies by stars, not by all pairs. Then
entries of different components are compared: those outside a list's largest component with all others of the list. Nothing is capped: a key of
any frequency is joined, and the joins are split where they are skewed.

Edge cases: null and empty texts have no shingles and link with nothing; fewer than five words are one shingle; repeated ids
and rows are rows of their own and equal texts link; a null doc_id never names a component unless all its ids are null; an
empty table gives no rows; extra columns are ignored. Two different sets are taken as one only if their 64-bit sums agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import batches_of, blocks, make_room, mixed, shingle_sets, table, utf8
from shelfline.llm.graph import components
from shelfline.operators.relational import fits_broadcast
from shelfline.session import written

PERCENT = 75
#: Most frequent shingles that the order knows by frequency; others are ordered by hash. It bounds the broadcast.
ORDERED = 400_000
#: Entries that a bucket of the first exchange holds on average.
BUCKET = 100_000
#: Largest boundary between light and heavy sets.
LIGHT_MOST = 64
#: List heads that a set is compared with in the first round; all other pairs wait for the second.
HEADS = 4
#: Pairs of whole sets that are compared at a time.
PAIRS = 128
#: Bytes of text that are worked on at a time, and rows of texts that a task gets from Spark at a time: several arrays of eight
#: bytes for each byte of text are held at once, and a batch is held by Spark and by the task.
TEXT_BYTES, ROWS_A_BATCH = 1 << 18, 1000
#: Entries that a task holds before it sends them on, and shingles that it counts together.
_HOLD, COUNTED = 1 << 18, 1 << 21
#: Sets that a task remembers to have entered; one that comes again later is only entered twice.
_SEEN = 1 << 18


def _i64(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _fingerprints(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A sum over each set, so the same for equal sets."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
    return mixed(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64))


def _sets(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of texts: its rows, all sets, their offsets and fingerprints."""
    make_room("jaccard")
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        for lo, hi, d, o in blocks(data, offsets, TEXT_BYTES):
            value, first = shingle_sets(d, o)
            yield batch.slice(lo, hi - lo), value, first, _fingerprints(value, first)


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, first, ids in _sets(batches, 1):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first)), _i64(ids)], names=["doc_id", "n_shingles", "set_id"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_id long")


def frequencies(docs: DataFrame) -> DataFrame:
    """``token, df``: shingles that several different sets of a task have, summed over all tasks.

    It reads all documents; what no task sees twice counts as rare. It only shapes the common order.
    """

    def counted(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids = np.concatenate([p[2] for p in parts])
        _, once = np.unique(ids, return_index=True)
        new = np.zeros(len(ids), bool)
        new[once] = True
        at = np.cumsum([0, *[len(p[2]) for p in parts]])
        value = np.concatenate([p[0][np.repeat(new[a:b], np.diff(p[1]))] for p, a, b in zip(parts, at[:-1], at[1:], strict=True)])
        parts.clear()
        # In place, and only what is there twice is looked at: the shingles are the most that a task holds.
        value.sort()
        again = np.flatnonzero(value[1:] == value[:-1])
        token, more = np.unique(value[again], return_counts=True)
        return pa.RecordBatch.from_arrays([_i64(token), pa.array(more + 1)], names=["token", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for _, value, first, ids in _sets(batches, 0):
            parts.append((value, first, ids))
            held += len(value)
            if held >= COUNTED:
                yield counted(parts)
                parts, held = [], 0
        if parts:
            yield counted(parts)

    return docs.select("text").mapInArrow(run, "token long, df long").groupBy("token").agg(F.sum("df").alias("df"))


class Order:
    """The common order of shingles: rare ones by hash, then the frequent ones by frequency."""

    def __init__(self, token: np.ndarray, df: np.ndarray):
        by = np.argsort(token)
        self.token, self.df = token[by], df[by]
        self.may = np.zeros(1 << 20, bool)
        self.may[(self.token >> np.uint64(44)).astype(np.int64)] = True

    def frequency(self, value: np.ndarray) -> np.ndarray:
        out = np.zeros(len(value), np.int64)
        at = np.flatnonzero(self.may[(value >> np.uint64(44)).astype(np.int64)])
        if len(at) and len(self.token):
            place = np.minimum(np.searchsorted(self.token, value[at]), len(self.token) - 1)
            hit = self.token[place] == value[at]
            out[at[hit]] = self.df[place[hit]]
        return out


def common_order(counts: DataFrame) -> tuple[Order, float]:
    """The frequent shingles, as many as ``ORDERED`` allows, and the mean length of the other shared lists."""
    levels = counts.groupBy(F.floor(F.log2("df")).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("df").alias("df"))
    kept, least = 0, 63
    rows = sorted(levels.collect(), key=lambda r: -r["level"])  # a row for each power of two
    for row in rows:
        if kept + row["n"] > ORDERED or row["level"] < 3:
            break
        kept, least = kept + row["n"], row["level"]
    rest = [r for r in rows if r["level"] < least]
    scanned = sum(r["df"] for r in rest) / max(1, sum(r["n"] for r in rest)) if rest else 2.0
    chosen = counts.where(F.floor(F.log2("df")) >= least).toArrow()  # at most ORDERED rows
    return Order(chosen["token"].to_numpy().view(np.uint64), chosen["df"].to_numpy()), float(scanned)


def needed(n: np.ndarray) -> np.ndarray:
    """Least number of shared shingles of a set of n with any set it links to."""
    return -(-PERCENT * n // 100)


def boundary(scanned: float) -> int:
    """Largest light size: a pair of n's first shingles costs an entry, a first shingle costs an entry and a scanned list."""
    sizes = np.arange(1, LIGHT_MOST + 1)
    first = sizes - needed(sizes) + 1
    light = (first + 1) * first // 2 <= first * (1 + scanned)
    return int(sizes[light].max()) if light.any() else 0


def _entries(value, first, ids, order: Order, light: int):
    """Keys, set ids, sizes, places and whether the key is known to be frequent, of all sets of a block."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    df = order.frequency(value)
    by = np.lexsort((df, doc))
    value, df = value[by], df[by]
    place = np.arange(len(value)) - first[doc]
    prefix = n - needed(n) + 1
    out = []
    heavy = (place < prefix[doc]) & (n[doc] * 100 >= PERCENT * (light + 1))
    out.append((value[heavy], ids[doc[heavy]], n[doc[heavy]], place[heavy], df[heavy] > 0))
    for size in np.unique(n[(n > 1) & (n <= light)]):
        which = np.flatnonzero(n == size)
        wide = int(size - needed(size) + 2)
        left, right = np.triu_indices(wide, 1)
        at = first[which][:, None]
        a, b = value[at + left], value[at + right]
        key = mixed((a * np.uint64(0x9E3779B97F4A7C15)) ^ mixed(b + np.uint64(1))).ravel()
        known = ((df[at + left] > 0) & (df[at + right] > 0)).ravel()
        out.append((key, np.repeat(ids[which], len(left)), np.full(len(key), size), np.full(len(key), -1), known))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def shared_entries(docs: DataFrame, order: Order, light: int, entries: int) -> DataFrame:
    """``key, set_id, n, place`` of all entries whose key several classes have.

    Entries travel as arrays, one row per task and bucket of keys, and a bucket is filtered at once. Frequent keys need
    no filter; they are dealt by set, so that no bucket grows with a key.
    """
    spread = max(8, -(-entries // BUCKET))
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def packed(parts: list[tuple]) -> pa.RecordBatch:
        key, ids, n, place, known = (np.concatenate(x) for x in zip(*parts, strict=True))
        bucket = np.where(known, spread + (ids % np.uint64(spread)).astype(np.int64), (key >> np.uint64(11)).astype(np.int64) % spread)
        by = np.argsort(bucket, kind="stable")
        rows = [key.astype("<u8"), ids.astype("<u8"), n.astype("<u4"), place.astype("<i4")]
        rows, bucket = [x[by] for x in rows], bucket[by]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
        ends = np.append(cut[1:], len(bucket))[: len(cut)]
        blobs = [pa.array([x[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()) for x in rows]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int64()), *blobs], names=["bucket", "key", "set_id", "n", "place"])

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, seen = [], 0, set()
        for _, value, first, ids in _sets(batches, 0):
            new = np.array([i not in seen and not seen.add(i) for i in ids.tolist()], bool) & (np.diff(first) > 0)
            if len(seen) > _SEEN:
                seen.clear()
            sizes = np.diff(first)
            value = value[np.repeat(new, sizes)]
            parts.append(_entries(value, np.concatenate([[0], np.cumsum(sizes[new])]), ids[new], shared.value, light))
            held += len(parts[-1][0])
            if held >= _HOLD:
                yield packed(parts)
                parts, held = [], 0
        if parts:
            yield packed(parts)

    def several(bucket: pa.Table) -> pa.Table:
        parts = [
            np.frombuffer(b"".join(bucket[c].to_pylist()), t)
            for c, t in (("key", "<u8"), ("set_id", "<u8"), ("n", "<u4"), ("place", "<i4"))
        ]
        by = np.lexsort((parts[1], parts[0]))
        key, ids, n, place = (x[by] for x in parts)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
        key, ids, n, place = key[new], ids[new], n[new], place[new]
        keep = np.ones(len(key), bool)
        if bucket["bucket"][0].as_py() < spread and len(key):
            same = key[1:] == key[:-1]
            keep[:] = False
            keep[1:] |= same
            keep[:-1] |= same
        return pa.table({"key": _i64(key[keep]), "set_id": _i64(ids[keep]), "n": n[keep].astype(np.int64), "place": place[keep].astype(np.int64)})

    sent = docs.select("text").mapInArrow(enter, "bucket long, key binary, set_id binary, n binary, place binary")
    return sent.groupBy("bucket").applyInArrow(several, "key long, set_id long, n long, place long")


def _possible(a: str, b: str):
    """Whether two entries of a list may be the first shingle that two linked sets share: by sizes, and by what follows it.

    All that the sets share stands at or behind the first shared shingle in both of them, so the shorter rest bounds it. Every
    linked pair passes at its first shared shingle; at later ones it need not.
    """
    na, nb, pa_, pb = (F.col(f"{x}.{c}") for c in ("n", "place") for x in (a, b))
    rest = (100 + PERCENT) * F.least(na - pa_, nb - pb) >= PERCENT * (na + nb)
    return (100 * na >= PERCENT * nb) & (100 * nb >= PERCENT * na) & ((pa_ < 0) | (pb < 0) | rest)


def plausible(pairs: DataFrame, lists: DataFrame, light: int) -> DataFrame:
    """Pairs that share enough of their first shingles to link; nothing that links is lost.

    Of two sets, let a's first shingles end before b's do. Then all that a's first shingles have in common with b stands
    among b's first ones, and the rest of a adds ``needed(n) - 1`` at most. Sets without inverted lists pass.
    """
    listed = F.collect_list(F.when(F.col("place") >= 0, F.col("key"))).alias("keys")
    firsts = written(lists.groupBy("set_id").agg(F.max("n").alias("n"), listed), "firsts")
    u = firsts.select(F.col("set_id").alias("u"), F.col("n").alias("nu"), F.col("keys").alias("ku"))
    v = firsts.select(F.col("set_id").alias("v"), F.col("n").alias("nv"), F.col("keys").alias("kv"))
    n, m = F.col("nu"), F.col("nv")
    rest = F.greatest(F.ceil(n * PERCENT / 100), F.ceil(m * PERCENT / 100)) - 1
    overlap = F.ceil((n + m) * PERCENT / (100 + PERCENT))
    unlisted = F.least(n, m) * 100 < PERCENT * (light + 1)
    return pairs.join(u, "u").join(v, "v").where(unlisted | (F.size(F.array_intersect("ku", "kv")) >= overlap - rest)).select("u", "v")


def verified(docs: DataFrame, known: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) of set ids whose sets link, compared as a whole.

    Only documents that stand for a set of a pair are read as a whole: one per set, and those without an id.
    """
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.col("u").alias("set_id")).unionByName(pairs.select(F.col("v").alias("set_id"))).distinct()
    own = known.groupBy("set_id").agg(F.min("doc_id").alias("doc_id")).join(wanted, "set_id", "left_semi")
    ids = written(own.where(F.col("doc_id").isNotNull()).select("doc_id").distinct(), "of-pairs")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = texts.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "doc_id", "left_semi").unionByName(texts.where("doc_id IS NULL"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, value, first, found in _sets(batches, 0):
            raw = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([_i64(found), pa.array(raw, pa.binary())], names=["set_id", "members"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                place = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[place] == a).sum())
                keep.append(100 * both >= PERCENT * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    with batches_of(docs.sparkSession, ROWS_A_BATCH):
        members = written(read.select("text").mapInArrow(sets, "set_id long, members binary").dropDuplicates(["set_id"]), "sets")
    of_v = pairs.join(members.select(F.col("set_id").alias("v"), F.col("members").alias("b")), "v")
    both = of_v.join(members.select(F.col("set_id").alias("u"), F.col("members").alias("a")), "u").select("u", "v", "a", "b")
    # A row holds two whole sets.
    with batches_of(docs.sparkSession, PAIRS):
        return written(both.mapInArrow(compare, "u long, v long"), "verified")


def set_links(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Links (u, v) between set ids that leave no two linked sets in different components."""
    with batches_of(docs.sparkSession, ROWS_A_BATCH):
        order, scanned = common_order(written(frequencies(docs), "frequencies"))
    light = boundary(scanned)
    first = F.col("n_shingles") - F.ceil(F.col("n_shingles") * PERCENT / 100) + 1
    count = F.when(F.col("n_shingles") <= light, first * (first + 1) / 2).otherwise(first)
    entries = known.where("n_shingles > 0").agg(F.coalesce(F.sum(count), F.lit(0)).cast("long").alias("n")).first()["n"]
    with batches_of(docs.sparkSession, ROWS_A_BATCH):
        lists = written(shared_entries(docs, order, light, entries), "lists")

    # First every set against the heads of its lists, of which it takes those that it meets most often. A list's head is the set
    # that has the fewest rare shingles before the key: the copy with the fewest changes of its own.
    centre = lists.groupBy("key").agg(F.min(F.struct("place", "set_id", "n")).alias("c"), F.count(F.lit(1)).alias("k"))
    centre = centre.where("k > 1").select("key", F.col("c.*"))
    star = lists.alias("a").join(centre.alias("b"), "key").where((F.col("a.set_id") != F.col("b.set_id")) & _possible("a", "b"))
    met = star.groupBy(F.col("a.set_id").alias("own"), F.col("b.set_id").alias("head")).agg(F.count(F.lit(1)).alias("k"))
    often = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("k"), "head"))
    heads = met.withColumn("_often", often).where(F.col("_often") <= HEADS)
    pairs = heads.select(F.least("own", "head").alias("u"), F.greatest("own", "head").alias("v")).distinct()
    pairs = written(pairs, "stars")
    links = verified(docs, known, plausible(pairs, lists, light))

    # Then entries outside the largest component of their list against all others of the list.
    joined = components(links).withColumnsRenamed({"node": "set_id"})
    placed = lists.join(joined, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    placed = written(placed, "placed")
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("k", "component")).alias("m"), F.count(F.lit(1)).alias("parts"))
    largest = written(largest.where("parts > 1").select("key", F.col("m.component").alias("largest")), "largest")
    rest = placed.join(largest, "key")
    outside = rest.where(F.col("component") != F.col("largest"))
    other = outside.alias("a").join(rest.alias("b"), "key").where(
        (F.col("a.component") != F.col("b.component"))
        & ((F.col("a.set_id") < F.col("b.set_id")) | (F.col("b.component") == F.col("b.largest")))
        & _possible("a", "b")
    )
    more = other.select(F.least("a.set_id", "b.set_id").alias("u"), F.greatest("a.set_id", "b.set_id").alias("v")).distinct()
    more = more.join(pairs, ["u", "v"], "left_anti")
    return links.unionByName(verified(docs, known, plausible(more, lists, light)))


def near_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    with batches_of(docs.sparkSession, ROWS_A_BATCH):
        known = written(classes(docs), "classes")
    found = components(set_links(docs, known)).withColumnsRenamed({"node": "set_id"})
    own = known.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    own = written(own.join(found, "set_id", "left").withColumn("component", F.coalesce("component", "set_id")), "set-components")
    named = own.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = own.join(named, "component").select("set_id", "component_id")
    linked = known.where("n_shingles > 0").join(by_set, "set_id").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(known.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies over all documents."""
    return near_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id)
"""
