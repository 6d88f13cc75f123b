"""ML-3, ML-4 and ML-6: a parameter sweep over prepared folds, trials side by side, with median pruning.

Trials run as Spark jobs of several threads. Every score is stored as soon as it is known, one file per trial and fold, so that a
sweep that is started again only computes what is missing. Whether a trial is pruned depends on the scores of the trials numbered
before it alone, never on which of them ended first: trials that run ahead are cancelled by their job tag once they are decided.
"""

from __future__ import annotations

import math
import os
import random
import statistics
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import Model, Sweep
from shelfline.operators.folds import Fold
from shelfline.operators.metrics import METRICS, evaluate_metrics
from shelfline.plans.learners import BoostedTrees, Learner
from shelfline.session import shared_folder, written
from shelfline.sources.sinks import FoldCache

# The search spaces by learner (range, and whether it is drawn on a logarithmic scale).
SEARCH_SPACE = {
    "feature_fraction": (0.40, 1.00, False),
    "min_data_in_leaf": (20, 200, False),
    "min_info_gain": (1e-8, 10.0, True),
}
SEARCH_SPACES = {
    "gbt": SEARCH_SPACE,
    "lightgbm": SEARCH_SPACE,
    "xgboost": {"colsample_bytree": (0.40, 1.00, False), "min_info_gain": (1e-8, 10.0, True), "min_child_weight": (1.0, 20.0, True)},
    "seasonal": {"smoothing": (1.0, 1e4, True)},
}
WHOLE_NUMBERS = {"min_data_in_leaf"}

# Fixed value: complete trials before pruning may start.
STARTUP_TRIALS = 5

COMPLETE, PRUNED = "COMPLETE", "PRUNED"


def suggest_params(draw: random.Random, space: str = "gbt") -> dict[str, Any]:
    """ML-4: one point of a learner's search space."""
    point: dict[str, Any] = {}
    for name, (low, high, logarithmic) in SEARCH_SPACES[space].items():
        if name in WHOLE_NUMBERS:
            point[name] = draw.randint(int(low), int(high))
        elif logarithmic:
            point[name] = math.exp(draw.uniform(math.log(low), math.log(high)))
        else:
            point[name] = draw.uniform(low, high)
    return point


def should_prune(scores: Sequence[float], finished: Sequence[Sequence[float]]) -> bool:
    """ML-6: whether a trial's best score so far is worse than the median of the finished trials at this step."""
    step = len(scores)
    peers = [other[step - 1] for other in finished if len(other) >= step]
    if len(finished) < STARTUP_TRIALS or not peers:
        return False
    return min(scores) > statistics.median(peers)


def trial_states(scores: DataFrame) -> DataFrame:
    """ML-6 from a table of scores (``trial``, ``fold``, ``score``): ``number``, ``state`` and mean ``value`` of each trial.

    All scores of a sweep, one number per trial and fold, become one row, over which the trials are judged in order.
    """
    per_trial = scores.groupBy("trial").agg(F.transform(F.sort_array(F.collect_list(F.struct("fold", "score"))), lambda x: x["score"]).alias("s"))
    row = per_trial.agg(F.sort_array(F.collect_list(F.struct("trial", "s"))).alias("trials"))

    def median(values: Column) -> Column:
        ordered, n = F.array_sort(values), F.size(values)
        return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2

    def judged(state: Column, trial: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(trial["s"]))
        worse = F.exists(steps, lambda k: F.array_min(F.slice(trial["s"], F.lit(1), k)) > median(F.transform(state["done"], lambda d: F.get(d, k - 1))))
        prune = (F.size(state["done"]) >= STARTUP_TRIALS) & worse
        mean = F.aggregate(trial["s"], F.lit(0.0), lambda total, x: total + x) / F.size(trial["s"])
        own = F.struct(
            trial["trial"].cast("int").alias("number"), F.when(prune, PRUNED).otherwise(COMPLETE).alias("state"), F.when(~prune, mean).alias("value")
        )
        return F.struct(
            F.when(prune, state["done"]).otherwise(F.concat(state["done"], F.array(trial["s"]))).alias("done"),
            F.concat(state["out"], F.array(own)).alias("out"),
        )

    none = F.struct(
        F.array().cast("array<array<double>>").alias("done"), F.array().cast("array<struct<number:int,state:string,value:double>>").alias("out")
    )
    return row.select(F.inline(F.aggregate("trials", none, judged)["out"]))


class ScoreTable:
    """Scores of a sweep: one folder per trial and fold, written whole or not at all, so that writing again changes nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, trial: int, fold: int, score: float) -> None:
        row = self.spark.createDataFrame([(score,)], "score double").coalesce(1)
        row.write.mode("overwrite").parquet(os.path.join(self.path, f"trial={trial}", f"fold={fold}"))

    def read(self) -> DataFrame:
        try:
            table = self.spark.read.option("basePath", self.path).schema("score double, trial int, fold int").parquet(os.path.join(self.path, "trial=*"))
        except AnalysisException:  # nothing is stored yet
            return self.spark.createDataFrame([], "trial int, fold int, score double")
        return table.select("trial", "fold", "score")

    def known(self) -> dict[tuple[int, int], float]:
        """One number per trial and fold."""
        return {(r["trial"], r["fold"]): r["score"] for r in self.read().collect()}


@dataclass(frozen=True)
class SweepResult:
    best_model_params: dict[str, Any]
    best_tuned_only: dict[str, Any]
    cv_mean: float
    cv_by_fold: DataFrame
    trials: DataFrame
    scores: DataFrame


class _Trials:
    """Scores as they come in, and the verdict on each trial as soon as all earlier ones are decided."""

    def __init__(self, n_trials: int, folds: Sequence[int], prune: bool):
        self.folds, self.prune = list(folds), prune
        self.scores: list[dict[int, float]] = [{} for _ in range(n_trials)]
        self.states: list[str | None] = [None] * n_trials
        self.finished: list[list[float]] = []

    def add(self, trial: int, fold: int, score: float) -> None:
        self.scores[trial][fold] = score

    def decide(self) -> list[int]:
        """Trials that were pruned by what is known now."""
        pruned = []
        for number, state in enumerate(self.states):
            if state is not None:
                continue
            seen: list[float] = []
            for fold in self.folds:
                if fold not in self.scores[number]:
                    return pruned
                seen.append(self.scores[number][fold])
                if self.prune and should_prune(seen, self.finished):
                    self.states[number] = PRUNED
                    pruned.append(number)
                    break
            else:
                self.states[number] = COMPLETE
                self.finished.append(seen)
        return pruned


def run_sweep(
    spark: SparkSession,
    folds: Sequence[Fold],
    build_fold: Callable[[Fold], tuple[DataFrame, DataFrame]],
    base: Model | Learner,
    sweep: Sweep,
    cache: FoldCache | None = None,
    target_col: str = "unit_sales",
    store: str | None = None,
) -> SweepResult:
    """ML-3: draw parameters, score every fold, and keep the parameters with the lowest mean score.

    A fold is built and prepared once and read by all trials. ``sweep.parallel`` fits run at a time; each fit and each score is a
    group of Spark jobs with the trial's tag, and the driver holds one number per trial and fold. ``store`` names the folder of
    the scores; a sweep that finds scores there goes on from them.
    """
    metric = sweep.metric.upper()
    if metric not in METRICS:
        raise ValueError(f"unsupported metric: {sweep.metric}")
    if sweep.pruner not in ("median", "none"):
        raise ValueError("pruner must be 'median' or 'none'")
    used = list(folds)[: sweep.windows_limit] if sweep.windows_limit else list(folds)
    if not used or sweep.n_trials < 1:
        raise ValueError("a sweep needs at least one fold and one trial")
    learner = BoostedTrees(base) if isinstance(base, Model) else base
    draw = random.Random(sweep.seed)
    points = [suggest_params(draw, learner.space) for _ in range(sweep.n_trials)]
    table = ScoreTable(spark, store or os.path.join(shared_folder(spark), f"sweep-{uuid.uuid4().hex}"))
    trials = _Trials(sweep.n_trials, [f.fold for f in used], sweep.pruner == "median")
    for (trial, fold), score in table.known().items():
        if trial < sweep.n_trials:
            trials.add(trial, fold, score)
    trials.decide()

    prepared: dict[int, tuple[Any, DataFrame]] = {}
    if None in trials.states:
        for f in used:
            train, val = cache.load_or_build(f, build_fold) if cache else build_fold(f)
            val = written(val, "sweep-val")
            prepared[f.fold] = (learner.prepare(train, val, target_col), val)
    run, over = uuid.uuid4().hex[:12], threading.Event()
    context = spark.sparkContext

    def tag(trial: int) -> str:
        return f"sweep-{run}-{trial}"

    def score(trial: int, fold: int) -> float:
        if over.is_set() or trials.states[trial] is not None:
            raise InterruptedError(f"trial {trial} is decided")
        context.addJobTag(tag(trial))
        try:
            inputs, val = prepared[fold]
            fitted = learner.tuned(points[trial]).fit(inputs)
            row = evaluate_metrics(fitted.predict(val), target_col, "prediction", [metric]).first()
            return math.inf if row is None or row[metric] is None else float(row[metric])
        finally:
            context.removeJobTag(tag(trial))

    with ThreadPoolExecutor(max_workers=max(1, sweep.parallel)) as pool:
        asked: dict[Future, tuple[int, int]] = {}
        for number in range(sweep.n_trials):
            for f in used:
                if trials.states[number] is None and f.fold not in trials.scores[number]:
                    asked[pool.submit(score, number, f.fold)] = (number, f.fold)
        try:
            for future in as_completed(asked):
                number, fold = asked[future]
                if future.cancelled():
                    continue
                if future.exception() is not None:
                    if trials.states[number] == PRUNED:
                        continue  # it was cancelled
                    raise future.exception()
                trials.add(number, fold, future.result())
                table.add(number, fold, future.result())
                for pruned in trials.decide():
                    context.cancelJobsWithTag(tag(pruned))
                    for other, (owner, _) in asked.items():
                        if owner == pruned:
                            other.cancel()
        finally:
            over.set()
            for future in asked:
                future.cancel()

    values = {n: statistics.fmean(trials.scores[n][f.fold] for f in used) for n, state in enumerate(trials.states) if state == COMPLETE}
    best = min(values, key=lambda n: (values[n], n))
    history = spark.createDataFrame(
        [(n, state, values.get(n), {k: float(v) for k, v in points[n].items()}) for n, state in enumerate(trials.states)],
        "number int, state string, value double, params map<string,double>",
    )
    by_fold = spark.createDataFrame(
        [(f.fold, f.val_start, f.val_end, trials.scores[best][f.fold]) for f in used],
        "fold int, val_start date, val_end date, score double",
    )
    return SweepResult({**learner.params, **points[best]}, points[best], values[best], by_fold, history, table.read())
