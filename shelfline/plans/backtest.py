"""CV-3 and FLOW-3: from raw tables to scored folds, models, run records and the optional sweep."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import BacktestConfig
from shelfline.operators import holidays as hol
from shelfline.operators.enrich import create_extend_train, join_oil, join_promos
from shelfline.operators.fill import fill_oil_pchip, fill_time_series_full_range
from shelfline.operators.folds import Fold, build_rolling_windows, collect_folds, embargo_days, feasibility
from shelfline.operators.metrics import METRICS, aggregate_fold_scores, evaluate_metrics, to_long
from shelfline.operators.profile import check_features
from shelfline.operators.promotions import process_promotions
from shelfline.operators.slicing import unique_dates
from shelfline.plans.fold_features import FoldFeatures
from shelfline.plans.learners import BoostedTrees, Learner
from shelfline.plans.sweep import SweepResult, run_sweep
from shelfline.session import shared_folder
from shelfline.sources.sinks import RunRecords, importance_table, is_complete, save_features
from shelfline.sources.tables import load_tables


def prepare(tables: dict[str, DataFrame], cfg: BacktestConfig) -> DataFrame:
    """Sales with item, store, promotion, holiday and gap-free price columns.

    The price that is joined is the interpolated one. Promotions are a column of the sales table, so they need no
    join with a copy of it. A ``promos`` table of its own is joined without its sales, so that the target cannot slip
    in under another name.
    """
    train = tables["train"]
    train = create_extend_train(train, tables["items"], tables["stores"])
    if tables.get("promos") is not None:
        train = join_promos(train, tables["promos"].drop(cfg.cols.target))
    train = process_promotions(train, "nan")
    train = hol.merge_train(train, hol.preprocess(tables["holidays_events"]), tables["stores"])
    oil = fill_time_series_full_range(fill_oil_pchip(tables["oil"]))
    return join_oil(train, oil, oil_col="dcoilwtico_complete")


def store_prepared(prepared: DataFrame, path: str, cfg: BacktestConfig, run_id: str) -> DataFrame:
    """Write the prepared table and read it back, sorted by date so that date slices skip row groups.

    With ``series_buckets`` it becomes a table bucketed by series: the windows of every fold then start without a
    shuffle of the facts.
    """
    spark = prepared.sparkSession
    keys = [c for c in cfg.cols.group_cols if c in prepared.columns]
    if not cfg.series_buckets or not keys:
        prepared.sortWithinPartitions("date").write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    name = f"shelfline_prepared_{run_id}"
    (
        prepared.repartition(cfg.series_buckets, *keys)
        .write.bucketBy(cfg.series_buckets, *keys)
        .sortBy("date")
        .option("path", path)
        .saveAsTable(name)
    )
    return spark.table(name)


def make_folds(prepared: DataFrame, cfg: BacktestConfig) -> DataFrame:
    cv = cfg.cv
    return build_rolling_windows(
        unique_dates(prepared),
        cv.n_windows,
        cv.val_days,
        cv.stride_days,
        embargo_days(cv.max_lag, cv.max_window),
        cv.min_train_days,
    )


@dataclass(frozen=True)
class BacktestResult:
    run_id: str
    folds: list[Fold]
    feasibility: DataFrame
    fold_scores: DataFrame
    cv_summary: DataFrame
    importance: DataFrame
    profile: DataFrame | None
    sweep: SweepResult | None
    next_config: BacktestConfig


def run_backtest(
    spark: SparkSession,
    cfg: BacktestConfig,
    tables: dict[str, DataFrame] | None = None,
    learner: Learner | None = None,
    run_id: str | None = None,
) -> BacktestResult:
    """FLOW-3. ``tables`` may bring the inputs; otherwise they are loaded from ``cfg.paths``. ``learner`` is by default the
    boosted trees of ``cfg.model``.

    The prepared table and the windowed features are written once and read back: the date slices of all folds prune
    the first, all folds and sweep trials share the second, and lost executors cost no more than the step at hand. With the
    ``run_id`` of a run that broke off (and its ``output_dir``), stored tables are read again and scored folds are not repeated.
    """
    learner = learner or BoostedTrees(cfg.model)
    run_id = run_id or uuid.uuid4().hex[:12]
    out = cfg.output_dir or os.path.join(shared_folder(spark), f"backtest-{run_id}")
    # Only dimensions have repeated keys to choose from; the facts carry no helper column.
    tables = tables or load_tables(spark, cfg.paths, keep_row_order=("items", "stores", "oil", "promos", "holidays_events"))
    records = RunRecords(spark, os.path.join(out, "records"), run_id)
    records.config(cfg.as_json())

    where = os.path.join(out, "prepared", run_id)
    if not cfg.series_buckets and is_complete(spark, where):
        prepared = spark.read.parquet(where)
    else:
        prepared = store_prepared(prepare(tables, cfg), where, cfg, run_id)

    cv = cfg.cv
    possible = feasibility(
        unique_dates(prepared), cv.val_days, embargo_days(cv.max_lag, cv.max_window), cv.min_train_days
    )
    folds = collect_folds(make_folds(prepared, cfg))
    features = FoldFeatures(
        spark, os.path.join(out, "folds", run_id), prepared, folds, cfg.features, cfg.cols, cfg.rows_per_group
    )

    profile = None
    for fold in folds:
        scored = records.has("fold_scores", fold.fold)
        if scored and fold.fold:
            continue
        train, val = features.build(fold)
        if fold.fold == 0:
            profile = check_features(train, cfg.cols.target)
            if scored:
                continue
            records.catalogue(train)
            if cfg.save_fold0:
                save_features(train, os.path.join(out, "features", run_id, "train"))
                save_features(val, os.path.join(out, "features", run_id, "val"))
        score_fold(spark, fold, train, val, learner, cfg.cols.target, records, os.path.join(out, "models", run_id, f"fold{fold.fold}"))

    fold_scores = records.parts("fold_scores", "fold int, " + ", ".join(f"{m} double" for m in METRICS))
    summary = aggregate_fold_scores(to_long(fold_scores))
    records.cv_summary(summary)
    importance = records.parts("importance", "fold int, feature string, importance double").orderBy("fold", F.desc("importance"), "feature")

    result, next_config = None, cfg
    if cfg.sweep.enabled and folds:
        sweep_scores = os.path.join(out, "sweep", run_id)
        result = run_sweep(spark, folds, features.build, learner, cfg.sweep, target_col=cfg.cols.target, store=sweep_scores)
        records.sweep(result.trials, result.cv_by_fold, result.best_model_params)
        if cfg.sweep.apply_best:
            next_config = cfg.with_model_params(result.best_model_params)
    return BacktestResult(run_id, folds, possible, fold_scores, summary, importance, profile, result, next_config)


def score_fold(
    spark: SparkSession, fold: Fold, train: DataFrame, val: DataFrame, learner: Learner, target_col: str, records: RunRecords, model_path: str
) -> None:
    """CV-3, one turn of the loop: fit on the training side, score the validation side, store model, importances and scores.

    The scores come last: a fold that has them is done.
    """
    fitted = learner.fit(learner.prepare(train, val, target_col))
    fitted.save(model_path)
    row = evaluate_metrics(fitted.predict(val), target_col, "prediction").first()
    records.importance(importance_table(spark, [(fold.fold, name, weight) for name, weight in fitted.importance()]), fold.fold)
    scores = [(fold.fold, *[row[m] if row else None for m in METRICS])]
    records.fold_scores(spark.createDataFrame(scores, "fold int, " + ", ".join(f"{m} double" for m in METRICS)), fold.fold)
