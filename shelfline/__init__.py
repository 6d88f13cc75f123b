"""Retail demand features and backtests on Spark: every operator takes and returns DataFrames."""

from types import ModuleType

from shelfline.config import BacktestConfig, Columns, CrossValidation, Features, Model, Sweep
from shelfline.functions.calendar import (
    add_is_weekend,
    add_month_of_year,
    add_week_of_year,
    extract_date_features,
)
from shelfline.functions.promo import promo_flag
from shelfline.operators.enrich import create_extend_train, join_oil, join_oil_promos, join_promos
from shelfline.operators.fill import (
    check_missing_dates_full_range,
    fill_oil_pchip,
    fill_time_series_full_range,
    oil_review,
)
from shelfline.operators.folds import (
    build_rolling_windows,
    collect_folds,
    embargo_days,
    feasibility,
    rows_of_folds,
)
from shelfline.operators.holidays import add_business, add_features, clean, drop_consumed, merge_train, preprocess
from shelfline.operators.metrics import aggregate_fold_scores, evaluate_metrics, to_long
from shelfline.operators.profile import check_features, feature_catalogue
from shelfline.operators.promotions import (
    add_days_since_last_promo,
    add_days_until_next_promo,
    add_promo_next_7days_flag,
    add_promo_streak,
    process_promotions,
    promo_features_all,
)
from shelfline.operators.relational import keep_one, resolve_group_cols
from shelfline.operators.seasonality import (
    add_regular_coeff_m,
    add_regular_coeff_w,
    add_seasonal_idx_m,
    add_seasonal_idx_w,
    create_seasonality_features,
)
from shelfline.operators.series import first_rows, make_expanding, make_lag, make_rolling
from shelfline.operators.slicing import (
    date_bounds,
    drop_target_cols,
    max_date,
    min_date,
    plain_slice,
    slice_by_date,
    unique_dates,
)
from shelfline.plans.backtest import prepare, run_backtest
from shelfline.plans.features import make_features, slice_features
from shelfline.plans.fold_features import FoldFeatures
from shelfline.plans.model import feature_importance, predict, train_model
from shelfline.plans.sweep import run_sweep
from shelfline.session import build_session
from shelfline.sources.sinks import FoldCache, RunRecords, load_model, save_features, save_model
from shelfline.sources.tables import load_tables

__all__ = [n for n, x in list(globals().items()) if n[0] != "_" and n != "ModuleType" and not isinstance(x, ModuleType)]
