"""ML-1: a boosted ensemble that grows tree by tree and is never fitted again.

Every tree is fitted to the residuals that the trees before it leave. The running forecast of each row stands in a stored
table that is written anew after a block of trees, so that no plan grows with the ensemble, a lost executor costs no more than
a block, and stopping early keeps the trees that are there. The trees and weights are those that one fit of Spark's boosted trees
would give, and they become such a model, so that saving, loading and importances are Spark's own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import discard, written

#: Trees between two writes of the running forecast.
BLOCK = 16

FEATURES, LABEL, CHECK = "_features", "_y", "_is_val"
_SUM = "_sum"


def best_iteration(errors: Sequence[float], patience: int) -> int:
    """Number of trees with the lowest error before the first run of ``patience`` trees that brings nothing better."""
    best = 0
    for k, error in enumerate(errors):
        if error < errors[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def grow(rows: DataFrame, params: dict[str, Any], most: int, rate: float, patience: int) -> tuple[GBTRegressionModel, list[float]]:
    """The ensemble with the lowest error on the check rows, and the error after each tree that was grown.

    ``rows``, a stored table, holds features, label and whether a row is for checking. Without check rows all ``most`` trees are
    kept. After the last block nothing is stored: only the check rows' forecasts are still read.
    """
    seed = int(params.get("seed", 42))
    settings = {k: v for k, v in params.items() if k not in ("seed", "validationTol")}
    state, own = rows.select(FEATURES, LABEL, CHECK, F.lit(0.0).alias(_SUM)), False
    checkable = not state.where(CHECK).isEmpty()
    trees: list[DecisionTreeRegressionModel] = []
    errors: list[float] = []
    while len(trees) < most:
        grown, sums = state, []
        for number in range(len(trees), min(most, len(trees) + BLOCK)):
            # Twice the residual, and a full first step, as in Spark's squared loss.
            target = F.col(LABEL) if number == 0 else 2 * (F.col(LABEL) - F.col(sums[-1] if sums else _SUM))
            learner = RandomForestRegressor(
                featuresCol=FEATURES, labelCol="_target", numTrees=1, bootstrap=False, seed=seed + number, **settings
            )
            tree = learner.fit(grown.where(~F.col(CHECK)).select(FEATURES, target.alias("_target"))).trees[0]
            step, total = f"_step{number}", f"_sum{number}"
            tree.setFeaturesCol(FEATURES).setPredictionCol(step)
            weight = 1.0 if number == 0 else rate
            grown = tree.transform(grown).withColumn(total, F.col(sums[-1] if sums else _SUM) + F.lit(weight) * F.col(step))
            sums.append(total)
            trees.append(tree)
        before, last = state, len(trees) >= most
        state = grown.select(FEATURES, LABEL, CHECK, *sums)
        if not last:
            state = written(state, "boost")
        if checkable:
            squared = [F.avg((F.col(LABEL) - F.col(s)) ** 2) for s in sums]
            errors += list(state.where(CHECK).agg(*squared).first())
        if own:
            discard(before)
        state, own = state.select(FEATURES, LABEL, CHECK, F.col(sums[-1]).alias(_SUM)), not last
        if checkable and best_iteration(errors, patience) + patience <= len(trees):
            break
    if own:
        discard(state)
    kept = best_iteration(errors, patience) if checkable else len(trees)
    return ensemble(rows.sparkSession, trees[:kept], [1.0] + [rate] * (kept - 1)), errors


def ensemble(spark: SparkSession, trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float]) -> GBTRegressionModel:
    """Trees and their weights as a model of Spark's boosted trees."""
    gateway, regression = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    members = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        members[i], shares[i] = tree._java_obj, float(weight)
    model = GBTRegressionModel(regression.GBTRegressionModel(f"boosted_{uuid.uuid4().hex[:12]}", members, shares))
    return model.setFeaturesCol(FEATURES).setPredictionCol("prediction")
