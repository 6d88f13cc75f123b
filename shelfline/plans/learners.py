"""UDF-1: what the fold loop and the sweep need of a model, and two models that offer it.

A learner prepares a fold once (``prepare``), is fitted to what that gave any number of times (``fit``), and can be had again with
other parameters (``tuned``). Whatever offers these, ``space`` and ``params`` can be run over folds and swept.
"""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.config import Model
from shelfline.operators.seasonality import seasonal_totals
from shelfline.plans.model import check_framework, feature_importance, fit_trees, merge_params, predict, tree_inputs
from shelfline.schemas import as_date
from shelfline.session import written


class Fitted(Protocol):
    """A fitted model."""

    def predict(self, rows: DataFrame) -> DataFrame:
        """The rows with a ``prediction`` column."""

    def importance(self) -> list[tuple[str, float]]: ...

    def save(self, path: str) -> None: ...


class Learner(Protocol):
    """A way to fit models."""

    params: dict[str, Any]
    #: Name of the search space that a sweep draws from.
    space: str

    def prepare(self, train: DataFrame, val: DataFrame, target_col: str) -> Any: ...

    def fit(self, prepared: Any) -> Fitted: ...

    def tuned(self, params: dict[str, Any]) -> Learner: ...


@dataclass(frozen=True)
class FittedTrees:
    model: PipelineModel

    def predict(self, rows: DataFrame) -> DataFrame:
        return predict(self.model, rows)

    def importance(self) -> list[tuple[str, float]]:
        return feature_importance(self.model)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


class BoostedTrees:
    """The boosted trees of ``model.py``; a fold's assembled rows are stored once for all fits."""

    def __init__(self, model: Model):
        check_framework(model)
        self.model = model
        self.params = model.params
        self.space = str(model.framework).lower()

    def prepare(self, train: DataFrame, val: DataFrame, target_col: str):
        return tree_inputs(train, val, target_col)

    def fit(self, prepared) -> FittedTrees:
        return FittedTrees(fit_trees(prepared, self.model))

    def tuned(self, params: dict[str, Any]) -> BoostedTrees:
        return BoostedTrees(dataclasses.replace(self.model, params=merge_params(self.model.params, params)))


@dataclass(frozen=True)
class FittedSeason:
    """A forecast per ISO week and one for weeks that training has not seen."""

    weeks: DataFrame
    overall: float | None

    def predict(self, rows: DataFrame) -> DataFrame:
        week = F.weekofyear(as_date(rows)["date"])
        # At most 53 rows.
        joined = as_date(rows).withColumn("_week", week).join(F.broadcast(self.weeks), F.col("_week") == F.col("_of_week"), "left")
        return joined.select(*rows.columns, F.coalesce("_forecast", F.lit(self.overall).cast("double")).alias("prediction"))

    def importance(self) -> list[tuple[str, float]]:
        return [("week_of_year", 1.0)]

    def save(self, path: str) -> None:
        self.weeks.withColumn("overall", F.lit(self.overall).cast("double")).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> FittedSeason:
        table = spark.read.parquet(os.path.join(path))
        first = table.first()
        return FittedSeason(table.drop("overall"), first["overall"] if first else None)


@dataclass(frozen=True)
class SeasonalNaive:
    """Forecasts a row by the mean target of its ISO week in training, drawn towards the overall mean by ``smoothing`` rows."""

    params: dict[str, Any] = field(default_factory=lambda: {"smoothing": 0.0})
    space: str = "seasonal"

    def prepare(self, train: DataFrame, val: DataFrame, target_col: str) -> DataFrame:
        """Sum and count per week: the only pass over the training rows."""
        totals = seasonal_totals(train.drop("year", "week_of_year", "month_of_year"), target_col=target_col)
        weeks = totals.groupBy(F.col("week_of_year").alias("_of_week")).agg(F.sum("_total").alias("_total"), F.sum("_known").alias("_known"))
        return written(weeks, "week-totals")

    def fit(self, prepared: DataFrame) -> FittedSeason:
        smoothing = float(self.params.get("smoothing", 0.0))
        overall = prepared.agg(F.try_divide(F.sum("_total"), F.sum("_known"))).first()[0]
        share = F.lit(smoothing) * F.lit(overall).cast("double")
        forecast = F.try_divide(F.coalesce("_total", F.lit(0.0)) + F.coalesce(share, F.lit(0.0)), F.col("_known") + F.lit(smoothing))
        return FittedSeason(prepared.select("_of_week", forecast.alias("_forecast")), overall)

    def tuned(self, params: dict[str, Any]) -> SeasonalNaive:
        return dataclasses.replace(self, params=merge_params(self.params, params))
