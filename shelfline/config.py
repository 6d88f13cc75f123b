"""Settings of a backtest as frozen values."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Columns:
    target: str = "unit_sales"
    group_cols: tuple[str, ...] = ("store_nbr", "item_nbr")


@dataclass(frozen=True)
class CrossValidation:
    stride_days: int = 14
    min_train_days: int = 365
    val_days: int = 14
    n_windows: int = 3
    max_lag: int = 84
    max_window: int = 14


@dataclass(frozen=True)
class Features:
    """What ``make_features`` builds; the defaults are its full set."""

    lags: tuple[int, ...] = (7, 14, 28)
    rollag: tuple[int, ...] = (1,)
    explag: tuple[int, ...] = (1,)
    windows: tuple[int, ...] = (7, 14, 28)
    rolling_stats: tuple[str, ...] = ("mean", "std", "max", "min", "sum")
    exp_stats: tuple[str, ...] = ("mean", "std", "max", "min", "sum")
    #: Days of history before a slice that its windows may read; 0 computes every slice from its own rows alone.
    context_days: int = 0


#: A small set for first comparisons.
LIGHT_FEATURES = Features(lags=(7, 14), windows=(7,), rolling_stats=("mean",), exp_stats=())


@dataclass(frozen=True)
class Model:
    """Boosted trees. The framework name is kept for configurations written for other learners."""

    framework: str = "gbt"
    params: dict[str, Any] = field(
        default_factory=lambda: {
            "n_estimators": 1000,
            "learning_rate": 0.05,
            "max_depth": 5,
            "subsample": 0.8,
            "colsample_bytree": 0.8,
            "random_state": 42,
        }
    )


@dataclass(frozen=True)
class Sweep:
    enabled: bool = False
    n_trials: int = 3
    #: Score only the first folds; None for all.
    windows_limit: int | None = None
    pruner: str = "median"
    metric: str = "RMSE"
    seed: int = 42
    apply_best: bool = False
    #: Fits that run side by side.
    parallel: int = 4


@dataclass(frozen=True)
class BacktestConfig:
    #: Input tables by name: train, oil, stores, items, holidays_events; or a list of files, a folder, a file.
    paths: Any = None
    #: Folder for feature tables, models and run records.
    output_dir: str | None = None
    #: "daily" when a series has at most one row per day, "check" to count first.
    rows_per_group: str = "check"
    #: Store the prepared table in this many buckets per series key, so that no fold shuffles it again.
    series_buckets: int | None = None
    save_fold0: bool = True
    cols: Columns = field(default_factory=Columns)
    cv: CrossValidation = field(default_factory=CrossValidation)
    features: Features = field(default_factory=Features)
    model: Model = field(default_factory=Model)
    sweep: Sweep = field(default_factory=Sweep)

    def as_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), sort_keys=True, default=str)

    def with_model_params(self, params: dict[str, Any]) -> BacktestConfig:
        """ML-7: the configuration of the next run, with tuned model parameters."""
        merged = {**self.model.params, **params}
        return dataclasses.replace(self, model=dataclasses.replace(self.model, params=merged))


def fingerprint(*parts: Any) -> str:
    """Short hash of settings, for names of cached tables."""
    text = json.dumps(
        [dataclasses.asdict(p) if dataclasses.is_dataclass(p) else p for p in parts], sort_keys=True, default=str
    )
    return hashlib.sha256(text.encode()).hexdigest()[:16]
