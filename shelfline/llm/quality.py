"""Quality classifier: a byte-level convolutional network in numpy that reads every byte of a text.

Bytes are embedded, filters of eight bytes slide over them in steps of four, and each filter's maximum is taken in
overlapping chunks of 512 bytes (one begins every 256) from the first byte to the last. The mean over the chunks and the
maximum over the chunks of every filter are combined into one probability.

The network is fitted on the driver on the whole texts of at most ``TRAIN_DOCS`` labelled documents, chosen by a hash of their id.
A step of the fit works on blocks of about ``FIT_BYTES`` and adds up their gradients. Scores use whole texts too.

Edge cases: null and empty texts are scored like an empty text (one chunk of padding); without labels of both classes every
score is the share of good labels (1 if there are none); conflicting labels of one id count as the lower; repeated rows are
scored alike; extra columns are carried along, clashing names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import blocks, make_room, table, utf8

TRAIN_DOCS = 3000
FIT_BYTES = 1 << 18
#: A score from here on is a prediction of 1.
THRESHOLD = 0.3

STEP, HALF = 4, 256
EMBED, FILTERS, EPOCHS, BATCH = 8, 24, 8, 48
#: Steps of a fit at least, however few labels there are.
LEAST_STEPS = 400


def _layout(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each padded text (a multiple of a half chunk, with room for a last filter), and the total."""
    halves = (np.diff(offsets) + STEP + HALF - 1) // HALF
    starts = np.concatenate([[0], np.cumsum(halves)])
    return starts[:-1], starts


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, edge = _layout(offsets)
    out = np.zeros(edge[-1] * HALF + STEP, np.uint8)
    out[np.repeat(starts * HALF - offsets[:-1], np.diff(offsets)) + np.arange(len(data))] = data
    return out, edge


class Network:
    """Parameters, scores and the gradient."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        width = EMBED * STEP
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        self.left = rng.normal(0, width**-0.5, (width, FILTERS)).astype(np.float32)
        self.right = rng.normal(0, width**-0.5, (width, FILTERS)).astype(np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)
        self.bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.left, self.right, self.out, self.bias]

    def features(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, tuple]:
        bytes_, edge = _padded(data, offsets)
        groups = self.embed[bytes_].reshape(-1, EMBED * STEP)
        value = groups[:-1] @ self.left
        value += groups[1:] @ self.right
        # At a text's last place the left part reads padding, and the right part would read the next text.
        value[edge[1:] * (HALF // STEP) - 1] = 0
        halves = value.reshape(edge[-1], HALF // STEP, FILTERS).max(axis=1)
        # A chunk is a half and the next half of the same text; a text of one half is one chunk.
        chunk = halves.copy()
        last = edge[1:] - 1
        inner = np.ones(len(halves), bool)
        inner[last] = False
        at = np.flatnonzero(inner)
        chunk[at] = np.maximum(halves[at], halves[at + 1])
        chunk = np.tanh(chunk)
        n = np.diff(edge).astype(np.float32)[:, None]
        mean = np.add.reduceat(chunk, edge[:-1], axis=0) / n
        top = np.maximum.reduceat(chunk, edge[:-1], axis=0)
        return np.hstack([mean, top]), (bytes_, edge, groups, value, halves, chunk, inner, top)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found, _ = self.features(data, offsets)
        return 1 / (1 + np.exp(-np.clip(found @ self.out + self.bias, -30, 30).astype(np.float64)))

    def gradient(self, data: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        found, (bytes_, edge, groups, value, halves, chunk, inner, top) = self.features(data, offsets)
        score = 1 / (1 + np.exp(-np.clip(found @ self.out + self.bias, -30, 30)))
        error = ((score - label) / len(label)).astype(np.float32)
        of_found = error[:, None] * self.out
        n = np.diff(edge)
        doc = np.repeat(np.arange(len(n)), n)
        is_top = chunk == top[doc]
        share = is_top / np.maximum(np.add.reduceat(is_top, edge[:-1], axis=0, dtype=np.float32), 1)[doc]
        of_chunk = of_found[doc, :FILTERS] / n[doc, None] + of_found[doc, FILTERS:] * share
        of_chunk *= 1 - chunk**2
        of_half = np.zeros_like(halves)
        at = np.flatnonzero(inner)
        first = halves[at] >= halves[at + 1]
        of_half[at] += of_chunk[at] * first
        of_half[at + 1] += of_chunk[at] * ~first
        of_half[~inner] += of_chunk[~inner]
        cube = value.reshape(len(halves), HALF // STEP, FILTERS)
        best = cube.argmax(axis=1) + (np.arange(len(halves)) * (HALF // STEP))[:, None]
        # Only the best place of each filter in each half gets a gradient.
        inside = np.ones(len(value), bool)
        inside[edge[1:] * (HALF // STEP) - 1] = False
        of_left, of_right = np.empty_like(self.left), np.empty_like(self.right)
        of_embed = np.zeros_like(self.embed)
        flat = np.zeros((256, EMBED), np.float32)
        for f in range(FILTERS):
            where, weight = best[:, f], of_half[:, f] * inside[best[:, f]]
            of_left[:, f] = weight @ groups[where]
            of_right[:, f] = weight @ groups[where + 1]
            for side, matrix in ((0, self.left), (1, self.right)):
                spread = (weight[:, None] * matrix[:, f]).reshape(-1, EMBED)
                which = bytes_[((where + side)[:, None] * STEP + np.arange(STEP)).ravel()]
                for e in range(EMBED):
                    flat[:, e] += np.bincount(which, weights=spread[:, e], minlength=256)
        of_embed += flat
        of_embed[0] = 0
        return [of_embed, of_left, of_right, found.T @ error, np.array([error.sum()], np.float32)]


    def gradient_in_blocks(self, data: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """The same gradient, from blocks of bounded bytes (a longer text is a block of its own)."""
        total = [np.zeros_like(p) for p in self.parameters()]
        for lo, hi, d, o in blocks(data, offsets, FIT_BYTES):
            for t, g in zip(total, self.gradient(d, o, label[lo:hi]), strict=True):
                t += g * np.float32((hi - lo) / len(label))
        return total


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> Network | float:
    """A fitted network, or the share of good labels where there is nothing to tell apart."""
    if not len(labels) or labels.min() == labels.max():
        return float(labels.mean()) if len(labels) else 1.0
    network, rng = Network(seed), np.random.default_rng(seed)
    network.bias[0] = np.log(labels.mean() / (1 - labels.mean()))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    in_epoch = -(-len(labels) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // in_epoch))
    step, total = 0, epochs * in_epoch
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), BATCH):
            chosen = order[lo : lo + BATCH]
            data, offsets = utf8(pa.array([texts[i] for i in chosen], pa.string()))
            gradient = network.gradient_in_blocks(data, offsets, labels[chosen])
            rate = 0.02 * (1 - step / total) + 1e-4
            step += 1
            for p, g, (m, v) in zip(network.parameters(), gradient, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Whole texts of a bounded sample of labelled documents outside the held-out fold, the same in every run."""
    own = labels.where(F.col("quality").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    own = own.groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    # The sample has TRAIN_DOCS rows at most, so it may be broadcast; repeated ids give one text.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "_quality").agg(F.min("_text").alias("_text")).collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    return [r["_text"] for r in rows], np.array([r["_quality"] for r in rows], np.float32)


def score(docs: DataFrame, model: Network | float, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text as column ``name``."""
    keep = [c for c in docs.columns if c != name]
    schema = docs.select(*keep).schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("quality")
        for batch in batches:
            found = np.full(batch.num_rows, model if isinstance(model, float) else 0.0)
            if not isinstance(model, float):
                data, offsets = utf8(batch.column("text"))
                for lo, hi, d, o in blocks(data, offsets, 1 << 18):
                    found[lo:hi] = model.scores(d, o)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*keep, name])

    return docs.select(*keep).mapInArrow(run, schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the labels outside the held-out fold and score every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(*training_sample(docs, table(spark, sf_dir, "labels")))
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
