"""ML-1 on packed rows: boosted trees whose inputs are cut into bins once, and read from then on as one or two bytes each.

Statistics and choices are those of Spark's trees. What differs is what a tree costs: rows are not sampled, cut into bins and cached
anew for every tree, but lie in a stored table of packs, one matrix of bins for some thousand rows. A pass over it forecasts the rows
by the trees so far, and adds up counts and sums per node, input and bin. Such a pass per level is all that a tree needs, and a task
holds one batch of packs and its sums, however many rows there are.

Up to rounding, the trees are those of Spark where thresholds come from all rows. Of more rows than Spark takes thresholds from, one
sample serves a fit, drawn otherwise than Spark's, so that thresholds differ from those of Spark. Of inputs that part the rows alike,
rounding decides which is taken.
"""

from __future__ import annotations

import functools
import math
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.plans import boosting
from shelfline.plans.boosting import CHECK, LABEL, best_iteration, ensemble
from shelfline.session import discard, written

# Tasks get what they run of this module by value: a worker needs neither this package nor what it imports.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that thresholds are taken from, if there are more: as many as the square of the bins, but this many at least (as in Spark).
_LEAST_SAMPLE = 10_000
#: Bytes of sampled inputs that the driver holds at once, and of sums that one pass adds up.
_SAMPLE_BYTES, _GROUP_BYTES = 1 << 26, 1 << 26
#: Cells that tell the bin of most values without a search.
_CELLS = 4096
#: A child whose labels differ by no more than this is not split again (as in Spark).
_PURE = 2.0**-52

_PACKS = "n int, bins binary, label binary, total binary, same binary"


@dataclass
class Node:
    """A node of a tree that grows; ``slot`` is its place in the pass that looks for its split."""

    level: int
    stats: tuple[float, float, float] | None = None
    gain: float = 0.0
    valid: bool = True
    feature: int = -1
    #: Whether a bin of the feature goes left, and the threshold or categories that say the same of its values.
    goes_left: np.ndarray | None = None
    split: Any = None
    left: Node | None = None
    right: Node | None = None
    slot: int | None = None
    #: Sums by input, bin and statistic, while its split is looked for; the other child and the sums of both, if those give its sums.
    sums: dict[int, np.ndarray] | None = None
    other: Node | None = None
    parent_sums: dict[int, np.ndarray] | None = None

    def forecast(self) -> float:
        count, total, _ = self.stats
        return total / count if count else 0.0


class Packs:
    """Stored packs of training and of check rows, the thresholds of each input (None: its bins are categories), its number of bins,
    and the first input that has the same bin in every training row."""

    def __init__(self, training: DataFrame, checking: DataFrame, thresholds: list[np.ndarray | None], n_bins: list[int], same: list[int]):
        self.training, self.checking, self.thresholds, self.n_bins, self.same = training, checking, thresholds, n_bins, same
        # Planned once for all passes. Two tasks a core: each adds up sums of its own.
        tasks = 2 * training.sparkSession.sparkContext.defaultParallelism
        self.training_rows, self.checking_rows = training.coalesce(tasks).rdd, checking.coalesce(tasks).rdd
        #: Sums of the first root, which all fits share.
        self.first: dict[int, np.ndarray] | None = None

    def with_tables(self, training: DataFrame, checking: DataFrame) -> Packs:
        return Packs(training, checking, self.thresholds, self.n_bins, self.same)


def growable(params: dict[str, Any]) -> bool:
    """Whether trees with these parameters read all rows alike, so that packs serve them."""
    known = {"seed", "validationTol", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "featureSubsetStrategy", "subsamplingRate"}
    subset = params.get("featureSubsetStrategy", "all")
    return set(params) <= known and float(params.get("subsamplingRate", 1.0)) == 1.0 and (subset in ("all", "auto") or _per_node(subset, 100) is not None)


def _per_node(subset: str, n: int) -> int | None:
    """Inputs that a node may split on."""
    if subset in ("all", "auto"):
        return n
    try:
        return min(int(subset), n) if int(subset) > 0 else None
    except ValueError:
        pass
    try:
        return math.ceil(float(subset) * n) if 0 < float(subset) <= 1 else None
    except ValueError:
        return None


# --- Bins -----------------------------------------------------------------------------------------------------------


def thresholds_of(values: np.ndarray, n_bins: int) -> np.ndarray:
    """Borders between the bins of one input: between all its values, or the ones closest to equal shares of the rows."""
    found, counts = np.unique(values, return_counts=True)
    borders = (found[:-1] + found[1:]) / 2.0
    if len(borders) <= n_bins - 1:
        return borders
    stride = len(values) / n_bins
    chosen, seen, target = [], int(counts[0]), stride
    for i in range(1, len(found)):
        before, seen = seen, seen + int(counts[i])
        if abs(before - target) < abs(seen - target):
            chosen.append(borders[i - 1])
            target += stride
    return np.array(chosen)


def _grid(cut: np.ndarray) -> tuple | None:
    """Cells of equal width over the borders, and the bins that each can hold: one for nearly all of them."""
    if len(cut) < 8 or not np.isfinite(cut).all() or not np.isfinite(scale := _CELLS / (cut[-1] - cut[0])):
        return None
    cells = _cells(cut, cut[0], scale)
    return cut[0], scale, np.searchsorted(cells, np.arange(_CELLS + 3), side="left"), np.searchsorted(cells, np.arange(_CELLS + 3), side="right")


def _cells(values: np.ndarray, low: float, scale: float) -> np.ndarray:
    """The cell of each value: a lower value never has a higher one."""
    return np.clip((values - low) * scale, -1, _CELLS + 1).astype(np.int32) + 1


def bins_of(values: np.ndarray, cut: np.ndarray, grid: tuple | None) -> np.ndarray:
    """How many borders lie below each value. A border is compared with the values of its own cell alone."""
    if grid is None:
        return np.searchsorted(cut, values, side="left")
    low, scale, least, most = grid
    cells = _cells(values, low, scale)
    out = least[cells]
    open_ = np.flatnonzero(out != most[cells])
    out[open_] = np.searchsorted(cut, values[open_], side="left")
    return out


def pack(both: DataFrame, prepared: Callable[[DataFrame], DataFrame], inputs: Sequence[str], categories: dict[str, int], max_bins: int, seed: int) -> Packs:
    """Rows of ``both`` sides as stored packs. ``prepared`` turns them to inputs (as numbers) and label; ``categories``: how many an
    input has. Rows for thresholds are sampled before they are prepared."""
    train = both.where(~F.col(CHECK))
    n_rows = train.count()
    most = max(max_bins * max_bins, _LEAST_SAMPLE)
    if n_rows > most:
        train = train.sample(withReplacement=False, fraction=most / n_rows, seed=seed)
    numbers = [c for c in inputs if c not in categories]
    step = max(1, _SAMPLE_BYTES // (8 * min(max(n_rows, 1), most)))
    cuts: dict[str, np.ndarray] = {}
    for at in range(0, len(numbers), step):
        some = numbers[at : at + step]
        sample = prepared(train).select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(some)]).toArrow()
        for c, values in zip(some, sample.columns, strict=True):
            cuts[c] = thresholds_of(values.to_numpy(), max(1, min(max_bins, n_rows)))
    thresholds = [cuts.get(c) for c in inputs]
    n_bins = [categories[c] if t is None else len(t) + 1 for c, t in zip(inputs, thresholds, strict=True)]
    grids = [None if t is None else _grid(t) for t in thresholds]
    kind = np.uint8 if max(n_bins, default=1) <= 256 else np.uint16 if max(n_bins) <= 65536 else np.uint32

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = np.empty((len(thresholds), batch.num_rows), kind)
            for i, (cut, grid) in enumerate(zip(thresholds, grids, strict=True)):
                values = batch.column(i).to_numpy(zero_copy_only=False)
                if not np.isfinite(values).all():
                    raise ValueError(f"input {inputs[i]!r} of a model holds NaN or an infinite value")
                bins[i] = values if cut is None else bins_of(values, cut, grid)
            label = batch.column(len(thresholds)).to_numpy(zero_copy_only=False)
            if np.isnan(label).any():
                raise ValueError("a label of a model is NaN")
            # Inputs that are the same in this pack: flags of gaps often are, as windows of one width miss the same rows.
            seen: dict[bytes, int] = {}
            same = [seen.setdefault(b.tobytes(), i) for i, b in enumerate(bins)]
            yield _batch(bins, label, np.zeros(len(label)), np.array(same, np.int32))

    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(inputs)]
    training, checking = (written(prepared(both.where(side)).select(*named, LABEL).mapInArrow(packed, _PACKS), "fold-packs") for side in (~F.col(CHECK), F.col(CHECK)))
    # The first input that is the same in every pack. As many different lists as there are patterns of equal inputs.
    patterns = [np.frombuffer(r["same"], np.int32) for r in training.select("same").distinct().toLocalIterator()]
    first: dict[tuple, int] = {}
    same = [first.setdefault(tuple(p[i] for p in patterns), i) for i in range(len(inputs))]
    return Packs(training, checking, thresholds, n_bins, same)


def _batch(bins: np.ndarray, label: np.ndarray, total: np.ndarray, same: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([len(label)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (bins, label, total, same)]]
    return pa.RecordBatch.from_arrays(columns, names=["n", "bins", "label", "total", "same"])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("n")[i].as_py(), *[batch.column(c)[i].as_buffer() for c in ("bins", "label", "total", "same")]


def _unpacked(rows: Iterable[tuple], n_inputs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bins by input and row, labels, forecasts so far and equal inputs of each pack."""
    for n, bins, label, total, same in rows:
        held = np.frombuffer(bins, np.uint8)
        kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}.get(held.size // (n * n_inputs or 1), np.uint8)
        yield held.view(kind).reshape(n_inputs, n), np.frombuffer(label), np.frombuffer(total), np.frombuffer(same, np.int32)


# --- Forecasts and sums ---------------------------------------------------------------------------------------------


def _spread(node: Node, bins: np.ndarray, rows: np.ndarray | None, out: np.ndarray, value) -> None:
    """``value`` of the leaf that each row ends in."""
    if node.left is None:
        out[slice(None) if rows is None else rows] = value(node)
        return
    column = bins[node.feature]
    left = node.goes_left[column if rows is None else column[rows]]
    for child, side in ((node.left, left), (node.right, ~left)):
        below = np.flatnonzero(side)
        _spread(child, bins, below if rows is None else rows[below], out, value)


def _totals(trees: Sequence[tuple[Node, float]], bins: np.ndarray, total: np.ndarray) -> list[np.ndarray]:
    """The running forecast after each tree."""
    after, step = [], np.empty(len(total))
    for root, weight in trees:
        _spread(root, bins, None, step, Node.forecast)
        total = total + weight * step
        after.append(total)
    return after


def _sums(packs: Packs, done: Sequence[tuple[Node, float]], first: bool, root: Node, n_slots: int) -> dict[int, np.ndarray]:
    """Per input: count, sum and sum of squares of what the next tree is fitted to, by node with a slot and by bin."""
    n_bins, n_inputs, width = packs.n_bins, len(packs.n_bins), max(packs.n_bins)
    features = sorted(set(packs.same))

    def counted(task: int, rows: Iterable[tuple]) -> Iterator[tuple[int, tuple[int, np.ndarray]]]:
        found = {f: np.zeros((3, n_slots, n_bins[f])) for f in features}
        some = False
        for bins, label, total, _ in _unpacked(rows, n_inputs):
            some = True
            after = _totals(done, bins, total)
            # Twice the residual, and a full first step, as in Spark's squared loss.
            target = label if first else 2 * (label - (after[-1] if after else total))
            at = np.empty(len(label), np.int64)
            _spread(root, bins, None, at, lambda node: -1 if node.slot is None else node.slot)
            asked = None
            if (at < 0).any():
                asked = np.flatnonzero(at >= 0)
                at, target = at[asked], target[asked]
            squared = target * target
            at *= width
            size = n_slots * width
            for f in features:
                code = at + (bins[f] if asked is None else bins[f][asked])
                for k, weights in enumerate((None, target, squared)):
                    found[f][k] += np.bincount(code, weights, size).reshape(-1, width)[:, : n_bins[f]]
        if some:
            yield from ((f, (task, sums)) for f, sums in found.items())

    parts = packs.training_rows.mapPartitionsWithIndex(counted)
    if 24 * sum(n_bins[f] for f in features) * n_slots * packs.training_rows.getNumPartitions() > _GROUP_BYTES:
        # Of many tasks' sums the driver sees the totals alone.
        parts = parts.groupByKey(min(len(features), packs.training_rows.getNumPartitions())).mapValues(lambda found: (0, _added(found)))
    found: dict[int, list[tuple[int, np.ndarray]]] = {}
    for f, sums in parts.collect():
        found.setdefault(f, []).append(sums)
    return {f: _added(sums) for f, sums in found.items()}


def _added(sums: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
    """Their sum, added up in the order of the tasks, whichever ended first."""
    return functools.reduce(np.add, (part for _, part in sorted(sums, key=lambda x: x[0])))


# --- Trees ----------------------------------------------------------------------------------------------------------


def _impurity(count, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - total * total / count) / count)


def _choose(node: Node, features: Sequence[int], packs: Packs, min_rows: int, min_gain: float) -> None:
    """The split with the highest gain, of equal ones the first. It becomes the node's own."""
    impurity = None if node.stats is None else float(_impurity(*map(np.float64, node.stats)))
    best = -math.inf
    for f in features:
        count, total, squares = node.sums[packs.same[f]]
        if len(count) < 2:
            continue
        order = None
        if packs.thresholds[f] is None:
            with np.errstate(divide="ignore", invalid="ignore"):
                order = np.argsort(np.where(count != 0, total / count, np.finfo(float).max), kind="stable")
            count, total, squares = count[order], total[order], squares[order]
        left = np.cumsum([count, total, squares], axis=1)
        whole, left = left[:, -1:], left[:, :-1]
        right = whole - left
        if impurity is None:
            node.stats = tuple(map(float, left[:, 0] + right[:, 0]))
            impurity = float(_impurity(*map(np.float64, node.stats)))
        n = left[0] + right[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = impurity - left[0] / n * _impurity(*left) - right[0] / n * _impurity(*right)
        gain[(left[0] < min_rows) | (right[0] < min_rows) | (gain < min_gain)] = -np.finfo(float).max
        at = int(np.argmax(gain))
        if gain[at] > best:
            best = float(gain[at])
            node.feature = f
            if order is None:
                node.goes_left = np.arange(packs.n_bins[f]) <= at
                node.split = float(packs.thresholds[f][at])
            else:
                node.goes_left = np.zeros(packs.n_bins[f], bool)
                node.goes_left[order[: at + 1]] = True
                node.split = [float(c) for c in order[: at + 1]]
            children = [tuple(map(float, side[:, at])) for side in (left, right)]
    node.gain, node.valid = best, best > -np.finfo(float).max
    if best > 0:
        node.left, node.right = (Node(node.level + 1, stats) for stats in children)


class _Subsets:
    """Inputs that each node may split on, drawn as Spark's trees draw them."""

    def __init__(self, spark: SparkSession, seed: int, n: int, per_node: int):
        self.jvm, self.n, self.per_node = spark._jvm, n, per_node
        self.random = self.jvm.java.util.Random(seed)

    def draw(self) -> list[int]:
        chosen = list(range(self.per_node))
        if self.per_node < self.n:
            xor = self.jvm.org.apache.spark.util.random.XORShiftRandom(self.random.nextLong())
            for item in range(self.per_node, self.n):
                place = int(xor.nextDouble() * (item + 1))
                if place < self.per_node:
                    chosen[place] = item
        return chosen


def _grown(packs: Packs, done: Sequence[tuple[Node, float]], first: bool, params: dict[str, Any], seed: int) -> Node:
    """One tree, fitted to what the trees before it leave."""
    n = len(packs.n_bins)
    depth, min_rows, min_gain = int(params.get("maxDepth", 5)), int(params.get("minInstancesPerNode", 1)), float(params.get("minInfoGain", 0.0))
    subsets = _Subsets(packs.training.sparkSession, seed, n, _per_node(params.get("featureSubsetStrategy", "all"), n))
    most = max(2, _GROUP_BYTES // (24 * sum(packs.n_bins)))
    root = Node(0)
    waiting = [root]
    while waiting:
        group, waiting = waiting[:most], waiting[most:]
        drawn = [subsets.draw() for _ in group]
        _add_up(packs, done, first, root, group)
        for node, some in zip(group, drawn, strict=True):
            if depth:
                _choose(node, some, packs, min_rows, min_gain)
            if node.stats is None:  # a root that no input can split
                node.stats = tuple(map(float, next(iter(node.sums.values())).sum(axis=1)))
            if node.left is not None and node.level + 1 < depth:
                children = [c for c in (node.left, node.right) if abs(float(_impurity(*map(np.float64, c.stats)))) >= _PURE]
                for child in children:
                    waiting.insert(0, child)
                if len(children) == 2:
                    fewer = min(children, key=lambda c: c.stats[0])
                    fewer.parent_sums, fewer.other = node.sums, children[children[0] is fewer]
            node.sums = None
    return root


def _less(both: np.ndarray, one: np.ndarray) -> np.ndarray:
    rest = both - one
    # Bins without rows sum to nothing: rounding must not tell apart borders between which no row lies.
    rest[:, rest[0] == 0] = 0.0
    return rest


def _add_up(packs: Packs, done: Sequence[tuple[Node, float]], first: bool, root: Node, group: Sequence[Node]) -> None:
    """Sums for all nodes of the group. Of two children only the rows of the smaller one are read: the other's are what is left."""
    if first and group[0] is root and packs.first is not None:
        root.sums = packs.first
        return
    rest = {id(node.other) for node in group if node.other is not None}
    asked = [node for node in group if node.sums is None and id(node) not in rest]
    for slot, node in enumerate(asked):
        node.slot = slot
    sums = _sums(packs, done, first, root, len(asked)) if asked else {}
    if asked and not sums:
        raise ValueError("there are no training rows")
    for slot, node in enumerate(asked):
        node.slot, node.sums = None, {f: x[:, slot, :] for f, x in sums.items()}
        if node.other is not None:
            node.other.sums = {f: _less(node.parent_sums[f], x) for f, x in node.sums.items()}
            node.parent_sums = node.other = None
    if first and group[0] is root:
        packs.first = root.sums


def _tree(spark: SparkSession, root: Node, packs: Packs) -> DecisionTreeRegressionModel:
    """The tree as a model of Spark's. Two leaves of one forecast become one, as in Spark."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    parts = jvm.org.apache.spark.ml.tree

    def array(values: Sequence[float]):
        out = gateway.new_array(jvm.double, len(values))
        for i, x in enumerate(values):
            out[i] = float(x)
        return out

    def made(node: Node):
        stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(array(node.stats), int(node.stats[0]))
        impurity = float(_impurity(*map(np.float64, node.stats)))
        if node.left is None:
            return parts.LeafNode(node.forecast(), impurity if node.valid else -1.0, stats), node.forecast()
        (left, a), (right, b) = made(node.left), made(node.right)
        if a is not None and a == b:
            return parts.LeafNode(a, impurity, stats), a
        if isinstance(node.split, float):
            split = parts.ContinuousSplit(node.feature, node.split)
        else:
            split = parts.CategoricalSplit(node.feature, array(node.split), packs.n_bins[node.feature])
        return parts.InternalNode(node.forecast(), impurity, node.gain, left, right, split, stats), None

    java = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(f"packed_{uuid.uuid4().hex[:12]}", made(root)[0], len(packs.n_bins))
    return DecisionTreeRegressionModel(java)


def _errors(packs: Packs, trees: Sequence[tuple[Node, float]]) -> list[float]:
    """Mean squared error on the check rows after each tree; nothing without such rows."""
    n_inputs = len(packs.n_bins)

    def measured(task: int, rows: Iterable[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        own = [
            np.array([len(label), *[((label - after) ** 2).sum() for after in _totals(trees, bins, total)]])
            for bins, label, total, _ in _unpacked(rows, n_inputs)
        ]
        if own:
            yield task, sum(own)

    found = packs.checking_rows.mapPartitionsWithIndex(measured).collect()
    if not found:
        return []
    n, *squared = _added(found)
    return [float(x / n) for x in squared]


def _moved_on(packs: Packs, trees: Sequence[tuple[Node, float]]) -> Packs:
    """The packs with the running forecast after these trees, stored."""
    n_inputs = len(packs.n_bins)

    def moved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, label, total, same in _unpacked(_rows(batches), n_inputs):
            yield _batch(bins, label, _totals(trees, bins, total)[-1], same)

    return packs.with_tables(*[written(table.mapInArrow(moved, _PACKS), "boost") for table in (packs.training, packs.checking)])


def _drop(packs: Packs) -> None:
    discard(packs.training)
    discard(packs.checking)


def grow(packs: Packs, params: dict[str, Any], most: int, rate: float, patience: int) -> tuple[GBTRegressionModel, list[float]]:
    """What ``boosting.grow`` gives, from packs."""
    seed, block = int(params.get("seed", 42)), boosting.BLOCK
    state, spark = packs, packs.training.sparkSession
    trees: list[Node] = []
    errors: list[float] = []
    while len(trees) < most:
        done: list[tuple[Node, float]] = []
        for number in range(len(trees), min(most, len(trees) + block)):
            done.append((_grown(state, done, number == 0, params, seed + number), 1.0 if number == 0 else rate))
        trees += [root for root, _ in done]
        errors += _errors(state, done)
        if errors and best_iteration(errors, patience) + patience <= len(trees):
            break
        if len(trees) < most:
            before, state = state, _moved_on(state, done)
            if before is not packs:
                _drop(before)
    if state is not packs:
        _drop(state)
    kept = best_iteration(errors, patience) if errors else len(trees)
    return ensemble(spark, [_tree(spark, root, packs) for root in trees[:kept]], [1.0] + [rate] * (kept - 1)), errors
