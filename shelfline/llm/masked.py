"""Masked pseudo-likelihood: a bidirectional window network predicts every word from the words on both sides.

The words of all documents are counted; the most frequent ones are classes of their own, all others share hash classes, where
a word's probability inside its class follows its count (``SMOOTH`` is added to all counts, and one share is for unseen words).
The count table grows with the corpus and is joined to the documents' words by shuffle. The
network adds one embedding per place (two words before, two after) and class, takes the tanh, and predicts the masked word
in two steps: its cluster, then the class inside the cluster. In each of ``MASK_EVERY`` passes, every task trains a copy on the
words of its documents that the pass masks (each word is masked in exactly one pass). The copies are averaged by ``FAN_IN`` at a
time, so that no task or driver gathers them all, and the next pass starts from the average. A document's score is the sum of the conditional log-probabilities of all its words.

Edge cases: null and empty texts have no words and score 0; a text of one word is predicted from edges alone; repeated rows
are scored alike; with an empty table nothing is trained and nothing returned; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import LOWER, blocks, mixed, table, translated, utf8, word_hashes, word_spans
from shelfline.session import discard, written

#: Clusters, classes in each, and classes at the end that words outside the vocabulary share by hash.
CLUSTERS, INSIDE, SHARED = 48, 48, 384
CLASSES = CLUSTERS * INSIDE
WORDS = CLASSES - SHARED - 1
PLACES = (-2, -1, 1, 2)
DIM = 24
#: Words are masked in so many passes, every word of every document in one of them.
MASK_EVERY = 6
#: Added to every word's count inside its hash class, and the count of all unseen words.
SMOOTH = 0.5
BATCH = 4096
RATE = 0.15
FAN_IN = 64
#: Entries of words in hash classes that a pack holds.
PACK = 1 << 20
_HOLD = 1 << 21
#: Bytes of text that are worked on at a time, so that arrays of eight bytes for each stay in a processor's cache; and bytes of
#: classes whose masked words are spread over batches together.
TEXT_BYTES, SPREAD_BYTES = 1 << 18, 2 << 20
#: The pass that masks a word stands above its class, in the same two bytes.
PASS_BITS = 12


def _largest(x: np.ndarray) -> np.ndarray:
    """The maximum of each row as a column; several times as fast as ``max`` of short rows."""
    half = x.shape[1] // 2
    best = np.maximum(x[:, :half], x[:, half : 2 * half])
    if 2 * half < x.shape[1]:
        best = np.hstack([best, x[:, 2 * half :]])
    return np.ascontiguousarray(best.T).max(axis=0)[:, None]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lowered = translated(data, LOWER)
    starts, ends, first = word_spans(lowered, offsets)
    return word_hashes(lowered, starts, ends), first


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (a hash) and its count over all documents; a task sends each word once per few million words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def counted() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for _, _, d, o in blocks(data, offsets, TEXT_BYTES):
                parts.append(_words(d, o)[0])
                held += len(parts[-1])
                if held >= _HOLD:
                    yield counted()
                    parts, held = [], 0
        if parts:
            yield counted()

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _shared(words: np.ndarray) -> np.ndarray:
    """The hash class of each word, from 0."""
    return (mixed(words) % np.uint64(SHARED)).astype(np.int64)


class Vocabulary:
    """Class of a word hash: 0 is the edge of a text, then words by frequency, then hash classes.

    ``counts`` is the whole table of ``word, n``; ``log_totals`` has the logarithm of the smoothed count of each hash class.
    """

    BITS = 16

    def __init__(self, words: list[int], counts: DataFrame | None = None, log_totals: np.ndarray | None = None):
        self.counts = counts
        self.log_totals = np.full(SHARED, np.log(SMOOTH)) if log_totals is None else log_totals
        hashes = np.array(words, np.int64).view(np.uint64)
        self.by = np.argsort(hashes)
        self.hashes = hashes[self.by]
        # Where the hashes with some first bits begin: few share them, so that a word meets its own at once or soon.
        self.begin = np.searchsorted(self.hashes >> np.uint64(64 - self.BITS), np.arange(1 << self.BITS, dtype=np.uint64)).astype(np.int16)
        self.most = int(np.bincount((self.hashes >> np.uint64(64 - self.BITS)).astype(np.int64)).max(initial=0))

    def classes(self, words: np.ndarray) -> np.ndarray:
        out = WORDS + 1 + _shared(words)
        if len(self.hashes) and len(words):
            place = self.begin[(words >> np.uint64(64 - self.BITS)).view(np.int64)].astype(np.int64)
            for _ in range(self.most):
                hit = np.flatnonzero(self.hashes.take(place, mode="clip") == words)
                out[hit] = self.by.take(place.take(hit), mode="clip") + 1
                place += 1
        return out

    def __getstate__(self) -> dict:
        return {**self.__dict__, "counts": None}


def vocabulary(counts: DataFrame) -> Vocabulary:
    counts = written(counts, "word-counts")
    top = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()]  # at most WORDS rows
    words = Vocabulary(top, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words.classes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) - WORDS - 1
            own = found >= 0
            n = np.bincount(found[own], batch.column(1).to_numpy(zero_copy_only=False)[own], SHARED).astype(np.float64)
            distinct = np.bincount(found[own], minlength=SHARED)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHARED)), pa.array(n), pa.array(distinct, pa.int64())], names=["class", "n", "words"])

    totals = np.full(SHARED, SMOOTH)
    # At most SHARED rows.
    for r in counts.mapInArrow(run, "class long, n double, words long").groupBy("class").agg(F.sum("n"), F.sum("words")).collect():
        totals[r[0]] += r[1] + SMOOTH * r[2]
    words.log_totals = np.log(totals)
    return words


def _contexts(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words of a block with edges between texts, and the place of each word."""
    n = np.diff(first)
    wide = max(abs(p) for p in PLACES)
    at = np.arange(len(classes)) + wide * (1 + np.repeat(np.arange(len(n)), n))
    padded = np.zeros(len(classes) + wide * (len(n) + 1), np.int64)
    padded[at] = classes
    return padded, at


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.1, (len(PLACES), CLASSES, DIM)).astype(np.float32)
        self.cluster = rng.normal(0, 0.1, (DIM, CLUSTERS)).astype(np.float32)
        self.cluster_bias = np.zeros(CLUSTERS, np.float32)
        self.inside = rng.normal(0, 0.1, (CLUSTERS, DIM, INSIDE)).astype(np.float32)
        self.inside_bias = np.zeros((CLUSTERS, INSIDE), np.float32)
        self.squares = [np.full(p.shape, 1e-3, np.float32) for p in self.parameters()]

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.cluster, self.cluster_bias, self.inside, self.inside_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for p in self.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def state(self) -> bytes:
        """Parameters, and the sums of squares that set their rates."""
        return np.concatenate([self.flat(), *[q.ravel() for q in self.squares]]).tobytes()

    def resume(self, state: bytes) -> Network:
        both = np.frombuffer(state, np.float32)
        self.load(both)
        at = len(both) // 2
        for q in self.squares:
            q[...] = both[at : at + q.size].reshape(q.shape)
            at += q.size
        return self

    def _hidden(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        # Whole rows are copied by ``take``, which is several times as fast as an index.
        total = self.embed[0].take(padded[at + PLACES[0]], axis=0)
        for k in range(1, len(PLACES)):
            total += self.embed[k].take(padded[at + PLACES[k]], axis=0)
        return np.tanh(total, out=total)

    def _by_cluster(self, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        # Two bytes, which are sorted by their digits.
        cluster = target.astype(np.int16) // np.int16(INSIDE)
        order = np.argsort(cluster, kind="stable")
        edges = np.searchsorted(cluster[order], np.arange(CLUSTERS + 1))
        return order, [(c, int(edges[c]), int(edges[c + 1])) for c in range(CLUSTERS) if edges[c] < edges[c + 1]]

    def _inside_logits(self, hidden: np.ndarray, target: np.ndarray, parts: list[tuple[int, int, int]]) -> np.ndarray:
        """Of each word, a value for each class of its cluster; all steps that go by rows are then done at once."""
        own = np.empty((len(hidden), INSIDE), np.float32)
        for c, lo, hi in parts:
            np.matmul(hidden[lo:hi], self.inside[c], out=own[lo:hi])
        own += self.inside_bias.take(target // INSIDE, axis=0)
        return own

    def log_probabilities(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each word, given the words on both sides."""
        target = padded[at]
        order, parts = self._by_cluster(target)
        at, target = at[order], target[order]
        hidden = self._hidden(padded, at)
        logits = hidden @ self.cluster + self.cluster_bias
        own = self._inside_logits(hidden, target, parts)
        # Less the largest, so that no exponential grows beyond its type.
        own -= _largest(own)
        cluster, every = target // INSIDE, np.arange(len(at))
        found = own[every, target - cluster * INSIDE] + logits[every, cluster]
        found -= np.log(np.exp(own, out=own).sum(axis=1))
        most = _largest(logits)
        logits -= most
        found -= np.log(np.exp(logits, out=logits).sum(axis=1)) + most[:, 0]
        out = np.empty_like(found)
        out[order] = found
        return out

    def train(self, padded: np.ndarray, at: np.ndarray) -> None:
        """One step of Adagrad on a batch of masked words."""
        target = padded[at]
        order, parts = self._by_cluster(target)
        at, target = at[order], target[order]
        hidden = self._hidden(padded, at)
        logits = hidden @ self.cluster + self.cluster_bias
        logits -= _largest(logits)
        chance = np.exp(logits, out=logits)
        chance /= chance.sum(axis=1, keepdims=True)
        chance[np.arange(len(at)), target // INSIDE] -= 1
        chance /= len(at)
        of_hidden = chance @ self.cluster.T
        of_inside, of_bias = np.zeros_like(self.inside), np.zeros_like(self.inside_bias)
        own = self._inside_logits(hidden, target, parts)
        own -= _largest(own)
        np.exp(own, out=own)
        own /= own.sum(axis=1, keepdims=True)
        own[np.arange(len(at)), target % INSIDE] -= 1
        own /= len(at)
        of_own = np.empty_like(of_hidden)
        for c, lo, hi in parts:
            np.matmul(hidden[lo:hi].T, own[lo:hi], out=of_inside[c])
            of_bias[c] = own[lo:hi].sum(axis=0)
            np.matmul(own[lo:hi], self.inside[c].T, out=of_own[lo:hi])
        of_hidden += of_own
        of_sum = of_hidden * (1 - hidden**2)
        gradients = [None, hidden.T @ chance, chance.sum(axis=0), of_inside, of_bias]
        for p, g, s in zip(self.parameters()[1:], gradients[1:], self.squares[1:], strict=True):
            s += g * g
            p -= RATE * g / np.sqrt(s)
        for k, place in enumerate(PLACES):
            word = padded[at + place]
            by = np.argsort(word.astype(np.int16), kind="stable")
            word = word[by]
            cut = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            rows = word[cut]
            g = np.add.reduceat(of_sum.take(by, axis=0), cut, axis=0)
            s = self.squares[0][k].take(rows, axis=0)
            s += g * g
            self.squares[0][k][rows] = s
            self.embed[k][rows] = self.embed[k].take(rows, axis=0) - RATE * g / np.sqrt(s)


def _classes(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """The classes of all words of each document and the passes that mask them, two bytes each, so that no pass looks for them again."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for _, _, d, o in blocks(data, offsets, TEXT_BYTES):
                hashes, first = _words(d, o)
                classes = shared.value.classes(hashes)
                raw = (classes + (_pass_of(classes, first) << PASS_BITS)).astype("<i2").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw[2 * x : 2 * y] for x, y in zip(first[:-1], first[1:], strict=True)], pa.binary())], names=["classes"])

    return docs.select("text").mapInArrow(run, "classes binary")


def _pass_of(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The pass that masks each word: by the word and its place in its text."""
    place = np.arange(len(classes)) - np.repeat(first[:-1], np.diff(first))
    key = mixed(classes.astype(np.uint64) + place.astype(np.uint64) * np.uint64(CLASSES))
    return (key % np.uint64(MASK_EVERY)).astype(np.int64)


def masked_places(classes: np.ndarray, first: np.ndarray, step: int) -> np.ndarray:
    """The words that pass ``step`` masks: each word in exactly one pass."""
    return np.flatnonzero(_pass_of(classes, first) == step)


def _masked_batches(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = utf8(batch.column(0).cast(pa.large_binary()))
        for _, _, d, o in blocks(data, offsets, SPREAD_BYTES):
            both, first = np.frombuffer(d.tobytes(), "<i2"), o // 2
            padded, at = _contexts(both & np.int16((1 << PASS_BITS) - 1), first)
            chosen = np.flatnonzero(both >> PASS_BITS == step)
            # Spread, so that a batch holds words of many texts.
            chosen = chosen[np.argsort(mixed(chosen.astype(np.uint64)))]
            for lo in range(0, len(chosen), BATCH):
                yield padded, at[chosen[lo : lo + BATCH]]


def train(docs: DataFrame, words: Vocabulary, seed: int = 11) -> Network:
    """``MASK_EVERY`` passes over all documents: tasks train copies, which are averaged by their masked words after each pass."""
    classes = written(_classes(docs, words), "classes")
    network = Network(seed)
    for step in range(MASK_EVERY):
        state = _pass(classes, network.state(), step)
        if state is not None:
            network.resume(state)
    discard(classes)
    return network


def _pass(classes: DataFrame, start: bytes, step: int) -> bytes | None:
    """The averaged network after one pass from ``start``."""
    shared = classes.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, seen = Network().resume(shared.value), 0
        for padded, at in _masked_batches(batches, step):
            network.train(padded, at)
            seen += len(at)
        if seen:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([float(seen)]), pa.array([network.state()], pa.binary())],
                names=["part", "weight", "flat"],
            )

    def averaged(group: pa.Table) -> pa.Table:
        weight = group["weight"].to_numpy()
        total = None
        for w, raw in zip(weight, group["flat"], strict=True):
            own = np.frombuffer(raw.as_buffer(), np.float32) * np.float32(w / weight.sum())
            total = own if total is None else total + own
        return pa.table({"part": [group["part"][0].as_py() // FAN_IN], "weight": [float(weight.sum())], "flat": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, weight double, flat binary"
    copies = written(classes.mapInArrow(run, schema), "copies")
    while copies.count() > 1:
        before, copies = copies, written(copies.groupBy(F.expr(f"part div {FAN_IN}")).applyInArrow(averaged, schema), "copies")
        discard(before)
    last = copies.first()
    discard(copies)
    shared.unpersist()
    return None if last is None else bytes(last["flat"])


def _packed(parts: list[tuple[np.ndarray, np.ndarray]], base: int) -> list[bytes]:
    """Distinct words ascending, how many entries each has, and the entries' documents and times in this order."""
    rows, word = (np.concatenate(x) for x in zip(*parts, strict=True))
    # Rows ascend, so that equal words of one document come to stand together.
    order = np.argsort(word, kind="stable")
    rows, word = rows[order], word[order]
    other = np.concatenate([[True], word[1:] != word[:-1]])
    cut = np.flatnonzero(other | np.concatenate([[True], rows[1:] != rows[:-1]]))
    times = np.diff(np.append(cut, len(word)))
    rows, word, other = rows[cut], word[cut], np.flatnonzero(other[cut])
    runs = np.diff(np.append(other, len(word)))
    blobs = (word[other].astype("<u8"), runs.astype("<u4"), (rows - base).astype("<u4"), times.astype("<u4"))
    return [x.tobytes() for x in blobs]


def score(docs: DataFrame, network: Network, words: Vocabulary) -> DataFrame:
    """``doc_id, n_words, log_likelihood, mean_log_likelihood`` of every document.

    The words in hash classes are looked up in the counts of the corpus by pack: a task packs those of many documents, each
    distinct word of a pack is joined once, and the pack adds the found values up for its documents. A word of any frequency is
    in a pack once, so no join grows with the documents that have it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((network.flat(), words))
    blobs = ["words", "runs", "rows", "times"]
    names = ["row", "doc_id", "n_words", "found", *blobs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each document, and one for each pack, named by a row of its own."""
        flat, own_words = shared.value
        model = Network().load(flat)
        row = TaskContext.get().partitionId() << 33
        base, parts, held, of_ids = row, [], 0, None

        def pack() -> pa.RecordBatch:
            values = [pa.array([base]), pa.nulls(1, of_ids), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64())]
            return pa.RecordBatch.from_arrays([*values, *[pa.array([x], pa.binary()) for x in _packed(parts, base)]], names=names)

        for batch in batches:
            of_ids = batch.column(0).type
            data, offsets = utf8(batch.column(1))
            for lo, hi, d, o in blocks(data, offsets, TEXT_BYTES):
                hashes, first = _words(d, o)
                classes = own_words.classes(hashes)
                padded, at = _contexts(classes, first)
                found = np.zeros(len(at) + 1, np.float64)
                for k in range(0, len(at), 4 * BATCH):
                    found[k + 1 : min(k + 4 * BATCH, len(at)) + 1] = model.log_probabilities(padded, at[k : k + 4 * BATCH])
                rare = np.flatnonzero(classes > WORDS)
                found[rare + 1] -= own_words.log_totals[classes[rare] - WORDS - 1]
                total = np.cumsum(found)
                n = np.diff(first)
                sums = total[first[1:]] - total[first[:-1]]
                rows = row + np.arange(hi - lo)
                none = [pa.nulls(hi - lo, pa.binary())] * len(blobs)
                yield pa.RecordBatch.from_arrays([pa.array(rows), batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(sums), *none], names=names)
                if len(rare):
                    parts.append((np.repeat(rows, n)[rare], hashes[rare]))
                    held += len(rare)
                row += hi - lo
                if held >= PACK:
                    yield pack()
                    base, parts, held = row, [], 0
        if parts:
            yield pack()

    schema = f"row long, doc_id {kind}, n_words long, found double, " + ", ".join(f"{b} binary" for b in blobs)
    parts = written(docs.select("doc_id", "text").mapInArrow(run, schema), "scored-words")
    packs = parts.where(F.col("words").isNotNull())

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(raw.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), row)), pa.array(own)], names=["row", "word"])

    rare = packs.select("row", "words").mapInArrow(spelled, "row long, word long")
    if words.counts is not None:
        rare = rare.join(words.counts, "word", "left")
    else:
        rare = rare.withColumn("n", F.lit(None).cast("long"))
    # In whole steps of 2^-32, so that the sum does not depend on the order of its parts. A word never seen has the share of
    # all unseen words.
    log = F.round(F.log(F.coalesce(F.col("n"), F.lit(0)) + F.lit(SMOOTH)) * 2.0**32).cast("long")

    def added(pack: pa.Table, found: pa.Table) -> pa.Table:
        word, log = found["word"].to_numpy().view(np.uint64), found["log"].to_numpy()
        log = log[np.argsort(word)]
        base, runs, rows, times = pack["row"][0].as_py(), *(np.frombuffer(pack[b][0].as_buffer(), "<u4") for b in blobs[1:])
        value = np.repeat(log, runs) * times.astype(np.int64)
        order = np.argsort(rows, kind="stable")
        rows, value = rows[order], value[order]
        cut = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        return pa.table({"row": base + rows[cut].astype(np.int64), "inside": np.add.reduceat(value, cut) / 2.0**32})

    found = rare.select("row", "word", log.alias("log")).groupBy("row")
    inside = packs.select("row", *blobs[1:]).groupBy("row").cogroup(found).applyInArrow(added, "row long, inside double")
    whole = parts.where(F.col("words").isNull()).select("row", "doc_id", "n_words", "found").join(inside, "row", "left")
    whole = whole.withColumn("log_likelihood", F.col("found") + F.coalesce("inside", F.lit(0.0)))
    return whole.select("doc_id", "n_words", "log_likelihood", (F.col("log_likelihood") / F.greatest("n_words", F.lit(1))).alias("mean_log_likelihood"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on all documents and score every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = vocabulary(word_counts(docs))
    return score(docs, train(docs, words), words)
