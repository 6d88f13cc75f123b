"""Repeated passages by a distributed suffix order: difference-cover sorting over content-defined blocks.

Every text is cut at places that its own bytes choose: a place is a cut if the hash of its next 16 bytes is the least among
those of 32 places on either side. Two equal passages of ``LENGTH`` bytes have the same cuts inside, so that it is enough to
order the suffixes that begin at cuts, over the alphabet of the blocks between them (with the 16 bytes that end each).

1. Cuts whose next 128 bytes occur once are set aside; no passage of ``LENGTH`` bytes that occurs twice begins before one.
2. The suffixes of what remains are ordered by the difference-cover method of period three: triples at places 1 and 2 of each
   three are sorted and named, the names are ordered by recursion, and suffixes at place 0 are merged by what precedes the
   names. Three levels tell 27 blocks apart, which is longer than any passage that matters, as cuts lie 33 bytes apart at least.
3. Neighbours in this order are compared: an interval of suffixes with a long common prefix is where passages repeat. If two
   suffixes of an interval also agree on the bytes around them, all passages that hang on their cut are repeated.
4. Near the ends of repeated regions, and where a passage has no cut, passages are compared one by one by a hash of all their
   bytes, one for each distinct surrounding.

Hot passages: what a task sees several times is known to be repeated and sent once, so no key grows with its copies. All
exchanges are split by key hashes; sorted steps use range partitions, and running numbers need one row per partition.

Edge cases: null texts are empty; texts shorter than ``LENGTH`` keep all bytes; repeated rows and ids are rows of their own, and
equal texts repeat each other; null ids are carried; an empty table gives no rows; clashing extra columns are replaced.
Passages of equal 64-bit hashes are taken as equal.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import batches_of, blocks, make_room, mixed, table, utf8, word_hashes
from shelfline.operators.relational import fits_broadcast
from shelfline.session import discard, written

LENGTH = 400
#: Bytes whose hash makes a cut, and places on either side in which it is the least.
GRAM, RADIUS = 16, 32
#: A suffix matters if this many of its bytes occur twice; passages without a cut in their first bytes are compared directly.
SHORT = 128
REACH = LENGTH - SHORT
#: Passages that hang on a cut begin ``RADIUS`` to ``REACH`` bytes before it; those that begin earlier have no cut and are asked
#: as such, and must not be asked a second time through a wide gap.
WIDEST = REACH - RADIUS + 1
#: Blocks whose names travel with a suffix for the comparison of neighbours.
AHEAD = LENGTH // (RADIUS + 1) + 2
#: A bound of common bytes that is beyond all that matters.
FAR = LENGTH + SHORT
LEVELS = 3
#: Neighbours of an interval share so many bytes of whole blocks; larger gaps between cuts than usual are handled apart.
LINK, USUAL_GAP = 64, 110
#: Cuts or passages that a task holds before it sends them on.
_HOLD = 1 << 18
#: Rows whose texts are rebuilt at a time: each is held as a text and as bytes.
REBUILT = 256
#: Bytes of text that are worked on at a time, and rows that a task gets from Spark at a time: arrays of eight bytes for each byte
#: of text are held several at once.
TEXT_BYTES, ROWS_A_BATCH = 1 << 18, 1000
_BUCKET = 100_000


def released(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more, and let Spark drop the shuffles that made them."""
    for df in tables:
        discard(df)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def cuts_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut places of a block and the text of each."""
    none = np.zeros(0, np.int64)
    if len(data) < GRAM + 2 * RADIUS + 1:
        return none, none
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    at = np.arange(len(data) - GRAM + 1)
    h = word_hashes(data, at, at + GRAM)
    h[doc[: len(h)] != doc[GRAM - 1 :]] = np.iinfo(np.uint64).max
    least, width = h.copy(), 1
    while width < RADIUS:
        least[:-width] = np.minimum(least[:-width], least[width:])
        width *= 2
    inner = slice(RADIUS, len(h) - RADIUS)
    n = len(h) - 2 * RADIUS
    found = np.flatnonzero((h[inner] < least[:n]) & (h[inner] < least[RADIUS + 1 : RADIUS + 1 + n])) + RADIUS
    return found, doc[found].astype(np.int64)


def _block_cuts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Of every cut with ``SHORT`` bytes after it: text, place, gap before it (``WIDEST`` at most), size and three hashes.

    The size of a text's last block is negative: no cut follows it.
    """
    at, doc = cuts_of(data, offsets)
    begin, end = offsets[:-1][doc], offsets[1:][doc]
    before = np.concatenate([[-1], at[:-1]]) if len(at) else at
    first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(at) else np.zeros(0, bool)
    gap = np.where(first, at - begin, at - before)
    after = np.concatenate([at[1:], [0]]) if len(at) else at
    last = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(at) else np.zeros(0, bool)
    block_end = np.where(last, end, np.minimum(after + GRAM, end))
    keep = at + SHORT <= end
    at, doc, begin, end, gap, after, last, block_end = (x[keep] for x in (at, doc, begin, end, gap, after, last, block_end))
    # The bytes that all passages hanging on this cut are made of; cut short at the text's ends.
    lo = np.maximum(begin, at - (RADIUS + np.minimum(gap, WIDEST)) + 1)
    hi = np.minimum(end, at + LENGTH - RADIUS)
    around = mixed(word_hashes(data, lo, hi) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return {
        "doc": doc, "at": at - begin, "gap": np.minimum(gap, WIDEST), "size": np.where(last, at - block_end, block_end - at),
        "key": word_hashes(data, at, at + SHORT), "block": word_hashes(data, at, block_end) | np.uint64(1), "around": around,
    }


def _once(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an entry is the first of its key, and whether the key has several entries."""
    _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    head = np.zeros(len(key), bool)
    head[first] = True
    return head, count[inverse] > 1


_FIELDS = (("key", "<u8"), ("rid", "<i8"), ("at", "<i4"), ("gap", "<u2"), ("size", "<i4"), ("block", "<u8"), ("around", "<u8"))


def _dealt(columns: dict[str, np.ndarray], fields, known: np.ndarray, spread: int, head: np.ndarray) -> pa.RecordBatch:
    """One row per bucket: entries to be filtered by key, and known ones dealt by row id."""
    key = columns["key"]
    bucket = np.where(head, (mixed(key) % np.uint64(spread)).astype(np.int64), spread + np.abs(columns["rid"] % spread))
    columns = {**columns, "known": known}
    by = np.argsort(bucket, kind="stable")
    bucket = bucket[by]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(bucket)).astype(np.int64)[: len(cut)]
    blobs = []
    for name, kind in (*fields, ("known", "u1")):
        values = columns[name][by].astype(kind)
        blobs.append(pa.array([values[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays([_i64(bucket[cut]), *blobs], names=["bucket", *[f for f, _ in fields], "known"])


def _unpacked(bucket: pa.Table, fields) -> dict[str, np.ndarray]:
    return {f: np.frombuffer(b"".join(bucket[f].to_pylist()), t) for f, t in (*fields, ("known", "u1"))}


def _several(columns: dict[str, np.ndarray], filtered: bool) -> np.ndarray:
    if not filtered:
        return np.ones(len(columns["key"]), bool)
    _, inverse, count = np.unique(columns["key"], return_inverse=True, return_counts=True)
    known = np.bincount(inverse, weights=columns["known"], minlength=len(count)) > 0
    return (count > 1)[inverse] | known[inverse]


def repeated_cuts(staged: DataFrame, spread: int) -> DataFrame:
    """Cuts whose next ``SHORT`` bytes occur at several places."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("suffix")
        parts, held = [], 0

        def packed() -> pa.RecordBatch:
            columns = {f: np.concatenate([p[f] for p in parts]) for f, _ in _FIELDS}
            head, known = _once(columns["key"])
            return _dealt(columns, _FIELDS, known, spread, head)

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            rid = batch.column(0).to_numpy()
            for lo, _, d, o in blocks(data, offsets, TEXT_BYTES):
                found = _block_cuts(d, o)
                found["rid"] = rid[lo + found.pop("doc")]
                parts.append(found)
                held += len(found["at"])
                if held >= _HOLD:
                    yield packed()
                    parts, held = [], 0
        if parts:
            yield packed()

    names = [f for f, _ in _FIELDS if f != "key"]

    def several(bucket: pa.Table) -> pa.Table:
        columns = _unpacked(bucket, _FIELDS)
        keep = _several(columns, bucket["bucket"][0].as_py() < spread)
        return pa.table({f: pa.array(columns[f][keep].view(np.int64) if f in ("block", "around") else columns[f][keep].astype(np.int64)) for f in names})

    sent = staged.select("rid", "text").mapInArrow(enter, "bucket long, " + ", ".join(f"{f} binary" for f, _ in _FIELDS) + ", known binary")
    return sent.groupBy("bucket").applyInArrow(several, ", ".join(f"{f} long" for f in names))


def running(groups: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """``groups`` (distinct keys) with ``before_<count>``: the sum of each count over all smaller keys."""
    groups = groups.select(*keys, *counts)
    schema = groups.schema.add("_part", "long")
    for c in counts:
        schema = schema.add(f"_own_{c}", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), dict.fromkeys(counts, 0)
        for batch in batches:
            own = []
            for c in counts:
                values = batch.column(c).to_numpy()
                sums = np.cumsum(values)
                own.append(pa.array(total[c] + sums - values))
                total[c] += int(sums[-1]) if len(sums) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part)), *own], names=schema.names)

    local = written(groups.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), "running")
    sums = local.groupBy("_part").agg(*[F.sum(c).alias(c) for c in counts])
    # One row per partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_base_{c}") for c in counts])
    joined = local.join(F.broadcast(base), "_part")
    return joined.select(*keys, *[(F.col(f"_base_{c}") + F.col(f"_own_{c}")).alias(f"before_{c}") for c in counts])


def suffix_order(strings: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``s, i, rank`` for strings given as ``s, i, x`` (x above 0): one more than the number of smaller suffixes.

    Suffixes that agree on ``3 ** levels`` symbols have the same rank.
    """
    of = Window.partitionBy("s").orderBy("i")
    ahead = lambda c, k: F.coalesce(F.lead(c, k).over(of), F.lit(0)).alias(f"{c}{k}")
    triples = written(strings.select("s", "i", "x", ahead("x", 1), ahead("x", 2)), "triples")
    place = F.col("i") % 3
    sample = triples.where(place != 0)
    triple = ["x", "x1", "x2"]
    counted = sample.groupBy(*triple).agg(F.count(F.lit(1)).alias("n"))
    names = running(counted, triple, ["n"]).withColumn("rank", F.col("before_n") + 1).drop("before_n")
    named = written(sample.join(names, triple).select("s", "i", "rank"), "names")
    released(names)
    over = [triples, named]
    if levels > 1 and not named.groupBy("rank").count().where("count > 1").isEmpty():
        lower = named.select((F.col("s") * 2 + place - 1).alias("s"), F.floor(F.col("i") / 3).alias("i"), F.col("rank").alias("x"))
        ranked = suffix_order(lower, levels - 1)
        over.append(ranked)
        side = F.pmod(F.col("s"), F.lit(2))
        named = ranked.select(F.shiftright("s", 1).alias("s"), (F.col("i") * 3 + 1 + side).alias("i"), "rank")
    joined = triples.join(named, ["s", "i"], "left").withColumn("r", F.coalesce("rank", F.lit(0))).drop("rank", "x2")
    joined = written(joined.select("s", "i", "x", "x1", "r", ahead("r", 1), ahead("r", 2)), "merged")
    released(*over)
    zero = F.sum((place == 0).cast("long")).alias("zero")
    other = F.sum((place != 0).cast("long")).alias("other")
    by_one, by_two = ["x", "r1"], ["x", "x1", "r2"]
    one = running(joined.where(place != 2).groupBy(*by_one).agg(zero, other), by_one, ["zero", "other"])
    two = running(joined.where(place != 1).groupBy(*by_two).agg(zero, other), by_two, ["zero", "other"])
    two = two.withColumnsRenamed({"before_zero": "zero_two", "before_other": "other_two"})
    first = joined.where(place == 0).join(one, by_one).join(two, by_two)
    first = first.select("s", "i", (1 + F.col("before_zero") + F.col("before_other") + F.col("other_two")).alias("rank"))
    second = joined.where(place == 1).join(one, by_one).select("s", "i", (F.col("r") + F.col("before_zero")).alias("rank"))
    third = joined.where(place == 2).join(two, by_two).select("s", "i", (F.col("r") + F.col("zero_two")).alias("rank"))
    ranks = written(first.unionByName(second).unionByName(third), "ranks")
    released(joined, one, two)
    return ranks


def _strings(cuts: DataFrame) -> DataFrame:
    """Cuts that follow each other directly form a string: its name ``s`` and the place ``i`` in it."""
    of = Window.partitionBy("rid").orderBy("at")
    follows = F.when(F.col("size") > 0, F.col("at") + F.col("size") - GRAM)
    new = F.coalesce((F.lag(follows).over(of) != F.col("at")).cast("int"), F.lit(1))
    marked = cuts.withColumn("_run", F.sum(new).over(of.rowsBetween(Window.unboundedPreceding, 0)))
    in_run = Window.partitionBy("rid", "_run").orderBy("at")
    # Equal names of two runs would only mix their order; names leave room for the recursion to double them.
    name = F.shiftright(F.xxhash64("rid", "_run"), 8)
    return marked.select("*", name.alias("s"), (F.row_number().over(in_run) - 1).cast("long").alias("i")).drop("_run")


def intervals(cuts: DataFrame) -> DataFrame:
    """Each cut with ``upper`` (a bound of the bytes that it shares with another suffix) and its interval ``part, seq``.

    Equal strings are ordered once, under the least of their names.
    """
    strings = written(_strings(cuts), "strings")
    whole = strings.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("block", "i")).alias("one"), F.bit_xor(F.xxhash64("i", "block")).alias("two"))
    equal = whole.groupBy("n", "one", "two").agg(F.min("s").alias("rep"), F.count(F.lit(1)).alias("strings"))
    stands = written(whole.join(equal, ["n", "one", "two"]).select("s", "rep", "strings"), "equal-strings")
    reps = stands.where("s = rep").select("s", "strings")
    once = written(strings.join(reps, "s").select("s", "i", "block", "size", "strings"), "distinct-strings")

    # Symbols above 0, which stands for the end of a string and is the least.
    ranks = suffix_order(once.select("s", "i", F.col("block").bitwiseAND(F.lit((1 << 63) - 1)).alias("x")))
    in_string = Window.partitionBy("s").orderBy("i").rowsBetween(0, AHEAD - 1)
    # Nine bits of size, as no bound beyond LENGTH is needed, and 22 of the block's name.
    packed = (F.pmod("block", F.lit(1 << 22)) * 512 + F.least(F.abs("size") - GRAM, F.lit(511))).cast("int")
    carried = once.join(ranks, ["s", "i"]).select("rank", "s", "i", "strings", F.collect_list(packed).over(in_string).alias("names"))
    ordered = carried.repartitionByRange("rank").sortWithinPartitions("rank", "s", "i")
    schema = "s long, i long, upper long, part long, seq long, trusted long"

    def whole(a: list, b: list) -> tuple[int, int]:
        """Blocks that two suffixes share, and their bytes."""
        total = k = 0
        for x, y in zip(a, b, strict=False):
            if x != y:
                break
            total, k = total + (x & 511), k + 1
        return k, total

    def bound(own: list, k: int, total: int) -> int:
        """Bytes that a suffix can share with any other if no other shares more than k blocks with it.

        A block that ends where the other goes on differs from it in the bytes that made its cut. Where one of two strings
        ends, its next cut is one whose next SHORT bytes occur once.
        """
        return total + max((own[k] & 511) + RADIUS + GRAM if k < len(own) else 0, SHORT)

    def trusted(own: list) -> int:
        """Whether all suffixes that share what a passage needs also share the LINK bytes of whole blocks of an interval."""
        total = 0
        for x in own:
            if total + (x & 511) + SHORT > LENGTH - RADIUS - USUAL_GAP:
                break
            total += x & 511
        return int(total >= LINK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, last_rank, last_names = TaskContext.get().partitionId(), 0, None, None
        held: dict[str, list] | None = None
        for batch in batches:
            rank, names = batch.column("rank").to_pylist(), batch.column("names").to_pylist()
            copies = batch.column("strings").to_pylist()
            rows = {c: batch.column(c).to_pylist() for c in ("s", "i")} | {"upper": [], "part": [part] * len(rank), "seq": [], "trusted": []}
            for k in range(len(rank)):
                own = names[k]
                upper = FAR if copies[k] > 1 else bound(own, 0, 0)
                if last_rank is not None:
                    before = rows if k else held
                    if rank[k] == last_rank:
                        before["upper"][-1] = upper = FAR
                    else:
                        n, total = whole(last_names, own)
                        before["upper"][-1] = max(before["upper"][-1], bound(last_names, n, total))
                        upper = max(upper, bound(own, n, total))
                        seq += total < LINK
                last_rank, last_names = rank[k], own
                rows["upper"].append(upper)
                rows["seq"].append(seq)
                rows["trusted"].append(trusted(own))
            if held is not None:
                yield pa.RecordBatch.from_pydict(held, schema=kinds)
            held = rows if rank else held
        if held is not None:
            yield pa.RecordBatch.from_pydict(held, schema=kinds)

    kinds = pa.schema([(f.split()[0], pa.int64()) for f in schema.split(", ")])
    found = written(ordered.mapInArrow(run, schema), "order").withColumnRenamed("s", "rep")
    released(once, ranks)
    placed = strings.select("s", "i", "rid", "at", "gap", "around").join(stands.select("s", "rep"), "s").join(found, ["rep", "i"])
    placed = written(placed.select("rid", "at", "gap", "around", "upper", "part", "seq", "trusted"), "intervals")
    released(strings, stands, found)
    return placed


def tasks_of(found: DataFrame) -> DataFrame:
    """What to do for each cut: all passages that hang on a ``sure`` cut are repeated, as another cut has the same bytes around
    it; a cut to ``check`` compares its passages one by one, as its interval holds other surroundings.

    Of several cuts with one surrounding the first one compares for all. A suffix at the edge of a range partition is not
    compared with the one beyond it, so the intervals at edges compare all they hold.
    """
    same = found.groupBy("around").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "at")).alias("head"))
    ends = found.groupBy("part").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    group = found.groupBy("part", "seq").agg((F.min("around") != F.max("around")).alias("several"))
    # One row per partition.
    group = group.join(F.broadcast(ends), "part").withColumn("edge", (F.col("seq") == F.col("low")) | (F.col("seq") == F.col("high")))
    joined = found.join(group.select("part", "seq", (F.col("several") | F.col("edge")).alias("several"), "edge"), ["part", "seq"]).join(same, "around")
    head = (F.col("head.rid") == F.col("rid")) & (F.col("head.at") == F.col("at"))
    far = F.lit(FAR)
    # Where blocks or gaps are unusually long, what could match may lie in another interval.
    loose = (F.col("trusted") == 0) | (F.col("gap") > USUAL_GAP)
    return joined.select(
        "rid", "at", "gap", (F.col("copies") > 1).alias("sure"), F.when(F.col("edge") | (F.col("copies") > 1), far).otherwise(F.col("upper")).alias("upper"),
        ((F.col("several") | loose) & ((F.col("copies") == 1) | head)).alias("check"),
    )


#: Passages that hang on one cut are compared in groups of so many neighbours, dealt by the bytes that all of a group hold.
GROUP = 16
_ASKED = (("key", "<u8"), ("rid", "<i8"), ("at", "<i4"), ("n", "<u2"))


def _expanded(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of ``n`` numbers for each entry."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _runs(rid: np.ndarray, at: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First entry and length of each run of neighbouring places of one row; ``apart`` entries differ from the one before."""
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (at[1:] != at[:-1] + 1) | apart[1:]
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(rid)))


def _asked_groups(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, asked: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Groups of neighbouring passages to be compared: text, first place, passages, hash that deals them; and the passages' hashes."""
    wanted = np.zeros(len(data) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    np.add.at(wanted, offsets[long], 1)
    np.add.at(wanted, offsets[long + 1] - LENGTH + 1, -1)
    # Passages without a cut where it would count: each is a group of its own.
    cut, of = cuts_of(data, offsets)
    inside = cut + SHORT <= offsets[1:][of]
    cut, of = cut[inside], of[inside]
    covered = np.zeros(len(data) + 1, np.int32)
    np.add.at(covered, np.maximum(cut - REACH, offsets[:-1][of]), 1)
    np.add.at(covered, np.maximum(cut - RADIUS + 1, offsets[:-1][of]), -1)
    blank = np.flatnonzero((np.cumsum(wanted)[:-1] > 0) & (np.cumsum(covered)[:-1] == 0))
    # The first bytes that hang on each cut that was asked, as far as the shared bytes can make a passage.
    begin, end, at = offsets[:-1][doc], offsets[1:][doc], offsets[:-1][doc] + asked["at"]
    first = np.maximum(begin, at - RADIUS - np.minimum(asked["gap"], WIDEST) + 1)
    last = np.minimum(np.minimum(at - RADIUS, at + asked["upper"] - LENGTH), end - LENGTH)
    some = last >= first
    at, first, last = at[some], first[some], last[some]
    low, high = (at - RADIUS - last) // GROUP, (at - RADIUS - first) // GROUP
    group, count = _expanded(low, high - low + 1), high - low + 1
    at, first, last = (np.repeat(x, count) for x in (at, first, last))
    nearest = at - RADIUS - GROUP * group
    deal = word_hashes(data, nearest, nearest - GROUP + 1 + LENGTH)
    first, last = np.maximum(first, nearest - GROUP + 1), np.minimum(last, nearest)
    start = np.concatenate([blank, first])
    n = np.concatenate([np.ones(len(blank), np.int64), last - first + 1])
    places = _expanded(start, n)
    key = word_hashes(data, places, places + LENGTH)
    of = np.searchsorted(offsets, start, side="right") - 1
    return {"doc": of, "at": start - offsets[of], "n": n, "deal": np.concatenate([key[: len(blank)], deal]), "key": key}


def _packed_groups(parts: list[dict[str, np.ndarray]], spread: int) -> pa.RecordBatch:
    """One row per bucket: passages to be filtered, in runs, and behind them runs that are known to be repeated, without hashes."""
    columns = {f: np.concatenate([p[f] for p in parts]) for f in ("rid", "at", "n", "deal", "key")}
    head, known = _once(columns["key"])
    n = columns["n"]
    rid, at = np.repeat(columns["rid"], n), _expanded(columns["at"], n)
    apart = np.zeros(len(at), bool)
    apart[np.cumsum(n)[:-1]] = True
    apart[1:] |= head[1:] != head[:-1]
    first, size = _runs(rid, at, apart)
    del apart
    mine = head[first]
    deal = np.repeat(columns["deal"], n)[first]
    rid, at = rid[first], at[first]
    bucket = np.where(mine, (mixed(deal) % np.uint64(spread)).astype(np.int64), spread + np.abs(rid % spread))
    by = np.argsort(bucket, kind="stable")
    bucket, rid, at, size, mine, first = (x[by] for x in (bucket, rid, at, size, mine, first))
    hashed = np.where(mine, size, 0)
    places = _expanded(first[mine], size[mine])
    key, known = columns["key"][places], known[places]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(bucket)).astype(np.int64)[: len(cut)]
    total = np.concatenate([[0], np.cumsum(hashed)])
    blob = lambda values, kind, lo, hi: pa.array([values[a:b].astype(kind).tobytes() for a, b in zip(lo, hi, strict=True)], pa.binary())
    blobs = [blob(key, "<u8", total[cut], total[ends]), blob(rid, "<i8", cut, ends), blob(at, "<i4", cut, ends), blob(size, "<u2", cut, ends)]
    flags = pa.array([np.packbits(known[a:b]).tobytes() for a, b in zip(total[cut], total[ends], strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([_i64(bucket[cut]), *blobs, flags], names=["bucket", *[f for f, _ in _ASKED], "known"])


def repeated_starts(staged: DataFrame, lists: DataFrame, spread: int) -> DataFrame:
    """``rid, first, last``: first bytes of passages that are repeated, among those that ``lists`` asks to compare one by one."""
    texts = staged.select("rid", "text").join(F.broadcast(lists) if _fits(lists) else lists, "rid", "left")

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("suffix")
        parts, held = [], 0
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            rid, lists = batch.column(0).to_numpy(), batch.column(2)
            inner = lists.flatten()
            doc = lists.value_parent_indices().to_numpy()
            asked = {f: inner.field(f).to_numpy().astype(np.int64) for f in ("at", "gap", "upper")}
            for lo, hi, d, o in blocks(data, offsets, TEXT_BYTES):
                a, b = np.searchsorted(doc, [lo, hi])
                found = _asked_groups(d, o, doc[a:b] - lo, {f: x[a:b] for f, x in asked.items()})
                found["rid"] = rid[lo + found.pop("doc")]
                parts.append(found)
                held += len(found["key"])
                if held >= _HOLD:
                    yield _packed_groups(parts, spread)
                    parts, held = [], 0
        if parts:
            yield _packed_groups(parts, spread)

    def several(bucket: pa.Table) -> pa.Table:
        columns = {f: np.frombuffer(b"".join(bucket[f].to_pylist()), t) for f, t in _ASKED}
        rid, at, n = columns["rid"], columns["at"].astype(np.int64), columns["n"].astype(np.int64)
        if bucket["bucket"][0].as_py() < spread:
            flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k) // 8) for x, k in zip(bucket["known"].to_pylist(), bucket["key"].to_pylist(), strict=True)]
            keep = _several({"key": columns["key"], "known": np.concatenate(flags)}, True)
            rid, at = np.repeat(rid, n)[keep], _expanded(at, n)[keep]
            by = np.lexsort((at, rid))
            rid, at = rid[by], at[by]
            first, n = _runs(rid, at, np.zeros(len(rid), bool))
            rid, at = rid[first], at[first]
        return pa.table({"rid": rid, "first": at, "last": at + n - 1})

    sent = texts.mapInArrow(enter, "bucket long, key binary, rid binary, at binary, n binary, known binary")
    return sent.groupBy("bucket").applyInArrow(several, "rid long, first long, last long")


def joined_spans(ranges: DataFrame) -> DataFrame:
    """``rid, spans``: the ranges ``first, last`` of each row, those that touch or overlap as one."""
    found = ranges.groupBy("rid").agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            row, inner = spans.value_parent_indices().to_numpy(), spans.flatten()
            first, last = (inner.field(f).to_numpy() for f in ("first", "last"))
            by = np.lexsort((first, row))
            row, first, last = row[by], first[by], last[by]
            # Places of all rows on one line, each row far behind the one before, so that a running maximum ends with its row.
            far = row * (int(last.max(initial=0)) + 2)
            reach = np.maximum.accumulate(last + far) if len(last) else last
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (first[1:] + far[1:] > reach[:-1] + 1)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(row))[: len(begin)] - 1
            offsets = np.searchsorted(row[begin], np.arange(batch.num_rows + 1))
            structs = pa.StructArray.from_arrays([pa.array(first[begin]), pa.array(reach[end] - far[end])], names=["first", "last"])
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)], names=["rid", "spans"])

    return found.mapInArrow(run, "rid long, spans array<struct<first:long,last:long>>")


def _fits(lists: DataFrame) -> bool:
    """Whether lists of structs may be broadcast, measured as text."""
    return fits_broadcast(lists.select("rid", F.to_json(F.struct(*[c for c in lists.columns if c != "rid"])).alias("j")))


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a row id ``rid`` and ``spans``: the first bytes of repeated passages, as ranges.

    ``docs`` is read several times, so it should be a stored table. A hash of id and text names a row; if rows repeat, so
    that this is no name, the table is stored again with numbered rows.
    """
    keep = [c for c in docs.columns if c not in ("rid", "spans")]
    id_ = [c for c in ("doc_id",) if c in keep]
    staged = docs.select(*keep).withColumn("rid", F.xxhash64(*id_, text_col))
    if not staged.groupBy("rid").count().where("count > 1").isEmpty():
        staged = written(docs.select(*keep).withColumn("rid", F.monotonically_increasing_id()), "staged")
    slim = staged.select("rid", F.col(text_col).alias("text"))
    size = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    spread = max(8, int(size // 60 // _BUCKET) + 1)
    with batches_of(docs.sparkSession, ROWS_A_BATCH):
        cuts = written(repeated_cuts(slim, spread), "cuts")
    placed = intervals(cuts)
    todo = written(tasks_of(placed), "tasks")
    released(cuts, placed)
    # Where a cut is sure, all passages that hang on it and end inside the text are repeated.
    first = F.greatest(F.lit(0), F.col("at") - RADIUS - F.least(F.col("gap"), F.lit(WIDEST)) + 1)
    sure = todo.where("sure").select("rid", first.alias("first"), (F.col("at") - RADIUS).alias("last")).where("last >= first")
    lists = todo.where("check").groupBy("rid").agg(F.collect_list(F.struct("at", "gap", "upper")).alias("asked"))
    lists = written(lists, "asked")
    ranges = repeated_starts(slim, lists, spread).unionByName(sure)
    with batches_of(docs.sparkSession, ROWS_A_BATCH):
        spans = written(joined_spans(ranges), "spans")
    released(todo, lists)
    return staged.join(F.broadcast(spans) if _fits(spans) else spans, "rid", "left")


def _cover(size: int, spans: list | None) -> np.ndarray:
    """Which bytes of a text are covered by a repeated passage."""
    edge = np.zeros(size + 1, np.int64)
    for x in spans or ():
        last = min(x["last"], size - LENGTH)
        if last >= x["first"]:
            edge[x["first"]] += 1
            edge[last + LENGTH] -= 1
    return np.cumsum(edge)[:-1] > 0


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # An empty batch stays, as it has the columns.
        for lo in range(0, max(batch.num_rows, 1), REBUILT):
            yield batch.slice(lo, REBUILT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the covered bytes of ``text`` removed; what is left of a cut character goes too."""
    found, columns = with_spans(docs), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("suffix")
        for batch in _pieces(batches):
            texts = batch.column("text").to_pylist()
            for k, spans in enumerate(batch.column("spans")):
                if spans.is_valid and texts[k]:
                    raw = np.frombuffer(texts[k].encode(), np.uint8)
                    texts[k] = raw[~_cover(len(raw), spans.as_py())].tobytes().decode("utf-8", "ignore")
            rows = {c: batch.column(c) for c in columns} | {"text": pa.array(texts, pa.string())}
            if "n_chars" in rows:
                rows["n_chars"] = pa.array([None if t is None else len(t) for t in texts], rows["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(rows.values()), names=list(rows))

    return found.select(*docs.columns, "spans").mapInArrow(run, docs.schema)


def removal_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("suffix")
        for batch in _pieces(batches):
            data, offsets = utf8(batch.column(1))
            sizes, removed, runs, digests = np.diff(offsets), [], [], []
            for k, spans in enumerate(batch.column(2)):
                own = data[offsets[k] : offsets[k + 1]]
                gone = _cover(len(own), spans.as_py())
                removed.append(int(gone.sum()))
                runs.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                digests.append(hashlib.sha256(own[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    found = with_spans(docs.select("doc_id", "text")).select("doc_id", "text", "spans")
    return found.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove passages of 400 bytes that occur anywhere else from all documents."""
    return removal_digests(table(spark, sf_dir, "documents"))
