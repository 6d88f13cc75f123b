"""AGG-7 and AGG-8: forecast scores and their summary over folds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: keeps the weighted error defined when all true values are 0.
EPSILON = 1e-8

METRICS = ("RMSE", "WMAPE")


def _finite(column: Column) -> Column:
    return column.isNotNull() & ~F.isnan(column) & (F.abs(column) != F.lit(math.inf))


def evaluate_metrics(
    predictions: DataFrame,
    y_true: str = "y",
    y_pred: str = "yhat",
    metrics: Sequence[str] = METRICS,
    by: Sequence[str] = (),
) -> DataFrame:
    """AGG-7: the known metrics among ``metrics`` over finite pairs, one column each, per group of ``by``."""
    y, p = F.col(y_true).try_cast("double"), F.col(y_pred).try_cast("double")
    error = F.abs(F.col("_y") - F.col("_p"))
    scores = {
        "RMSE": F.sqrt(F.avg(error * error)),
        "WMAPE": F.sum(error) / (F.sum(F.abs("_y")) + EPSILON),
    }
    wanted = list(dict.fromkeys(m.upper() for m in metrics if m.upper() in scores))
    pairs = predictions.select(*by, y.alias("_y"), p.alias("_p")).where(_finite(F.col("_y")) & _finite(F.col("_p")))
    if not wanted:
        return pairs.select(*by).distinct()
    return pairs.groupBy(*by).agg(*[scores[m].alias(m) for m in wanted])


def to_long(scores: DataFrame, by: Sequence[str] = ("fold",), metrics: Sequence[str] = METRICS) -> DataFrame:
    """Wide scores as rows ``metric, score``."""
    present = [m for m in metrics if m in scores.columns]
    return scores.unpivot(list(by), present, "metric", "score")


def aggregate_fold_scores(fold_scores: DataFrame) -> DataFrame:
    """AGG-8: mean and population standard deviation per metric over finite scores of a ``metric, score`` table."""
    return (
        fold_scores.where(_finite(F.col("score")))
        .groupBy("metric")
        .agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))
    )
