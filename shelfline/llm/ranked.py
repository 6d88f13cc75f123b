"""Ranked lexical search by presence masks.

Every text is read once and turned into counts of the terms that some item asks for; the counts are stored. Weights follow from
the number of documents with each term. A task then takes the stored documents in slices: each term of an item gives one bitmap
over the slice, the bitmaps together give each document's mask of matched terms, and documents with equal masks form a group. A
group's score cannot pass the sum of its terms' best parts in the slice. Groups are scored by descending bound until the bound
falls below the k-th best score so far, which the task carries from slice to slice. The best k of all tasks are merged in two
steps, so that no task meets more than a bounded share of them.

Edge cases: null and empty texts have no terms and are in no count; items without terms get no rows; each row of items is ranked
by itself, also one with a repeated or null id; each row of documents has a rank of its own, also copies and repeated ids; equal
scores stand by ascending doc_id, a missing one last; texts of any length are read whole; empty tables give no rows; other
columns of either table are not read. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.common import LOWER, blocks, table, utf8, word_hashes, word_spans
from shelfline.session import written

#: Bytes that are in no term: all of ASCII but letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

#: Documents of a slice, and terms of a group of items: a dense table of both is held in a task.
SLICE = 4096
TERMS = 4096
#: Bytes of the items' term hashes that are sent to all tasks at a time; more items are searched in several passes.
QUERY_BYTES = 8 << 20
#: Groups of tasks whose best rows are merged before all others.
MERGES = 64


def term_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased term, and the first term of each text (one entry more than texts)."""
    lowered = LOWER[data]
    starts, ends, first = word_spans(lowered, offsets, BETWEEN)
    return word_hashes(lowered, starts, ends), first


def item_terms(items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """``row``, ``item_id`` and the distinct term hashes of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            lists: list[np.ndarray] = []
            for _, _, d, o in blocks(data, offsets):
                hashes, first = term_rows(d, o)
                lists += [np.unique(hashes[first[i] : first[i + 1]]).view(np.int64) for i in range(len(o) - 1)]
            cuts = np.cumsum([0, *map(len, lists)])
            terms = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms], names=["row", "item_id", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).cast("long").alias("item_id"), "text")
    return rows.mapInArrow(run, "row long, item_id long, terms array<bigint>")


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id``, number of terms, and the numbers and counts of those in the ascending ``vocabulary``, of every whole text."""
    likely = np.zeros(1 << 16, bool)
    likely[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def counted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        hashes, first = term_rows(data, offsets)
        at = np.flatnonzero(likely[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        found = np.searchsorted(vocabulary, hashes[at])
        real = vocabulary[np.minimum(found, len(vocabulary) - 1)] == hashes[at]
        doc = np.searchsorted(first, at[real], side="right") - 1
        key, times = np.unique(doc * len(vocabulary) + found[real], return_counts=True)
        per_doc = np.bincount(key // len(vocabulary), minlength=len(offsets) - 1)
        return np.diff(first), per_doc, key % len(vocabulary), times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            parts = [counted(d, o) for _, _, d, o in blocks(data, offsets)]
            if not parts:
                continue
            lengths, per_doc, terms, times = (np.concatenate([p[k] for p in parts]) for k in range(4))
            cuts = pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (terms, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths), *lists], names=["doc_id", "n", "terms", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


class Corpus(NamedTuple):
    """Documents with a term, all their terms, and documents per term of the vocabulary."""

    documents: int
    terms: int
    df: np.ndarray


def corpus_counts(counts: DataFrame, size: int) -> Corpus:
    """Sums over all documents: one row per term and task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            n = batch.column("n").to_numpy(zero_copy_only=False)
            total[size] += np.count_nonzero(n)
            total[size + 1] += n.sum()
            total[:size] += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "docs"])

    sums = counts.select("n", "terms").mapInArrow(run, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    df = np.zeros(size + 2, np.int64)
    for row in sums.collect():  # one row per term of the vocabulary
        df[row.term] = row.docs
    return Corpus(int(df[size]), int(df[size + 1]), df[:size])


def weights(corpus: Corpus) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * d + 1))) for d in corpus.df.tolist()], np.int64)


class Best:
    """The k best documents of an item so far: by score, then id, missing ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A score below this one cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        enters = scores >= self.least
        s, i, m = (np.concatenate([a, b[enters]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.missing, missing)))
        order = np.lexsort((i, m, -s))[: self.k]
        self.scores, self.ids, self.missing = s[order], i[order], m[order]


def masks_of(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks of matched terms (a row of flags each) from one bitmap per term, and the mask of each document."""
    k, docs = present.shape
    words = -(-k // 64)
    packed = np.zeros((docs, words * 8), np.uint8)
    packed[:, : -(-k // 8)] = np.packbits(present, axis=0).T
    packed = packed.view(np.uint64)
    if words == 1:
        distinct, which = np.unique(packed[:, 0], return_inverse=True)
        distinct = distinct[:, None]
    else:
        distinct, which = np.unique(packed, axis=0, return_inverse=True)
    return np.unpackbits(np.ascontiguousarray(distinct).view(np.uint8), axis=1)[:, :k].astype(bool), which.reshape(-1)


def search_slice(best: Best, weight: np.ndarray, parts: np.ndarray, present: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> int:
    """Score the groups of one slice for one item, the most promising first; the number of documents scored."""
    masks, which = masks_of(present)
    bounds = masks @ (weight * parts.max(axis=1, initial=0).astype(np.int64))
    order = np.argsort(-bounds, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    docs = np.argsort(rank[which], kind="stable")
    ends = np.cumsum(np.bincount(rank[which], minlength=len(order)))
    bounds, lo, step, at = bounds[order], 0, 16, 0
    while lo < len(order) and bounds[lo] >= best.least:
        # Masks of this step whose bound may still enter.
        hi = min(lo + step, int(np.searchsorted(-bounds, -best.least, side="right")))
        chosen = docs[at : ends[hi - 1]]
        scores = weight @ parts[:, chosen].astype(np.int64)
        best.add(scores, ids[chosen], missing[chosen])
        lo, at, step = hi, ends[hi - 1], step * 2
    return int(at)


def _item_groups(queries: list[np.ndarray]) -> Iterator[tuple[range, np.ndarray]]:
    """Items in order, as many at a time as have at most ``TERMS`` different terms (one at least), and their terms."""
    lo, held = 0, np.zeros(0, np.int64)
    for i, terms in enumerate(queries):
        both = np.union1d(held, terms)
        if len(both) > TERMS and i > lo:
            yield range(lo, i), held
            lo, both = i, np.unique(terms)
        held = both
    if lo < len(queries):
        yield range(lo, len(queries)), held


def best_of_tasks(counts: DataFrame, queries: list[np.ndarray], names: list[tuple[int, int | None]], corpus: Corpus, k: int) -> DataFrame:
    """The k best documents of each task for each item: ``row``, ``item_id``, ``doc_id``, ``score``, ``part``."""
    weight = weights(corpus)
    schema = "row long, item_id long, doc_id long, score long, part int"
    groups = list(_item_groups(queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for whole in batches:
            width = max([1, *(len(held) for _, held in groups)])
            rows = max(64, min(SLICE, (SLICE * TERMS) // width))
            for lo in range(0, whole.num_rows, rows):
                batch = whole.slice(lo, rows)
                ids, missing = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                n = batch.column("n").to_numpy(zero_copy_only=False)
                m = 50 + (50 * n * corpus.documents) // max(corpus.terms, 1)
                terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
                times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("terms").offsets.to_numpy()))
                part = (1_000_000_000 * times) // (1000 * times + 20 * m[doc])
                place = np.full(len(weight), -1, np.int64)
                for items, held in groups:
                    place[:] = -1
                    place[held] = np.arange(len(held))
                    own = place[terms] >= 0
                    parts = np.zeros((len(held), batch.num_rows), np.int32)
                    parts[place[terms[own]], doc[own]] = part[own]
                    present = np.zeros(parts.shape, bool)
                    present[place[terms[own]], doc[own]] = True
                    for i in items:
                        at = place[queries[i]]
                        some = np.flatnonzero(present[at].any(axis=0))
                        if len(some):
                            of = np.ix_(at, some)
                            search_slice(best[i], weight[queries[i]], parts[of], present[of], ids[some], missing[some])
        part_id = TaskContext.get().partitionId()
        for i, b in enumerate(best):
            if len(b.scores):
                size = len(b.scores)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[i][0]] * size, pa.int64()),
                        pa.array([names[i][1]] * size, pa.int64()),
                        pa.array(b.ids, pa.int64(), mask=b.missing),
                        pa.array(b.scores),
                        pa.array([part_id] * size, pa.int32()),
                    ],
                    names=["row", "item_id", "doc_id", "score", "part"],
                )

    return counts.mapInArrow(run, schema)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the k documents of highest score above 0 for each row of ``items``."""
    spark = docs.sparkSession
    asked = written(item_terms(items), "query-terms")
    held = asked.agg(F.sum(F.size("terms").cast("long"))).first()[0] or 0
    passes = max(1, -(-2 * 8 * held // QUERY_BYTES))
    found = None
    for number in range(passes):
        rows = asked.where((F.size("terms") > 0) & (F.pmod(F.xxhash64("row"), F.lit(passes)) == number)).collect()
        if not rows:
            continue
        hashes = [np.array(r.terms, np.int64).view(np.uint64) for r in rows]
        vocabulary = np.unique(np.concatenate(hashes))
        counts = written(term_counts(docs, vocabulary), "term-counts")
        corpus = corpus_counts(counts, len(vocabulary))
        queries = [np.searchsorted(vocabulary, h) for h in hashes]
        best = best_of_tasks(counts, queries, [(r.row, r.item_id) for r in rows], corpus, k)
        found = best if found is None else found.union(best)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("row", F.pmod("part", F.lit(MERGES))).orderBy(*order)
    merged = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY 1),
c AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM f, c GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nd) // l))))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (doc_id), c GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""
