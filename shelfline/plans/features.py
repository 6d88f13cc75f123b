"""FLOW-1: the feature table of a slice as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.config import Features
from shelfline.functions.calendar import extract_date_features
from shelfline.functions.promo import promo_flag
from shelfline.operators.promotions import PROMO_FLAG, promo_feature_list
from shelfline.operators.relational import resolve_group_cols
from shelfline.operators.seasonality import SEASONAL_FEATURES, create_seasonality_features, seasonal_totals
from shelfline.operators.series import (
    BoundedFeature,
    RunningFeature,
    add_series_features,
    expanding_feature,
    lag_feature,
    rolling_feature,
)
from shelfline.operators.slicing import slice_by_date
from shelfline.schemas import as_date, require_columns

Feature = BoundedFeature | RunningFeature
STATS = ("mean", "std", "max", "min", "sum")


def make_features(
    df: DataFrame,
    target_col: str = "unit_sales",
    lags: Sequence[int] = (7, 14, 28),
    rollag: Sequence[int] = (1,),
    explag: Sequence[int] = (1,),
    group_cols: Sequence[str] | None = None,
    windows: Sequence[int] = (7, 14, 28),
    rolling_stats: Sequence[str] = STATS,
    exp_stats: Sequence[str] = STATS,
    *,
    promo_window: int = 7,
    tiebreak: Sequence[str] = (),
    rows_per_group: str = "check",
    visible_from: date | None = None,
) -> DataFrame:
    """Calendar, seasonality, promotion, lag, rolling and expanding features of every row.

    The windows of all series features share one shuffle of the fact table by series. The seasonal means take one
    aggregate pass over date and target, and come back by broadcast. With ``visible_from``, earlier rows only feed the
    windows: they leave before calendar and seasonal features are measured.
    """
    groups = resolve_group_cols(df, group_cols)
    features = [
        *promo_feature_list("date", promo_window),
        *target_feature_list(target_col, lags, rollag, explag, windows, rolling_stats, exp_stats),
    ]
    wide = windowed(df, features, groups, target_col, tiebreak, rows_per_group)
    rows = as_date(df)
    if visible_from is not None:
        start = F.lit(visible_from)
        wide, rows = wide.where(F.col("date") >= start), rows.where(F.col("date") >= start)
    return dressed(wide, seasonal_totals(rows, target_col=target_col), df.columns, [f.name for f in features])


def target_feature_list(target_col, lags, rollag, explag, windows, rolling_stats, exp_stats) -> list[Feature]:
    return [
        *[lag_feature(target_col, k) for k in lags],
        *[rolling_feature(target_col, v, w, s) for s in rolling_stats for v in rollag for w in windows],
        *[expanding_feature(target_col, v, s) for s in exp_stats for v in explag],
    ]


def windowed(
    df: DataFrame,
    features: Sequence[Feature],
    groups: Sequence[str],
    target_col: str,
    tiebreak: Sequence[str] = (),
    rows_per_group: str = "check",
) -> DataFrame:
    """The rows with all series features: the only step that shuffles them."""
    require_columns(df, ["date", target_col, "onpromotion"], "make_features")
    flag = {PROMO_FLAG: promo_flag(df, "onpromotion")}
    return add_series_features(
        df, features, groups, tiebreak=tiebreak, rows_per_group=rows_per_group, scratch=flag
    )


def dressed(wide: DataFrame, totals: DataFrame, base: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Windowed rows with calendar and seasonal features: narrow work and one broadcast join.

    ``totals`` are those of ``seasonal_totals``. They also hold the first date, which comes back with the same join;
    their table has a few rows per month, so the window over all of it is small.
    """
    whole = Window.partitionBy(F.lit(0))
    totals = totals.withColumn("_origin", F.min("_first_date").over(whole))
    seasonal = create_seasonality_features(wide, totals=totals)
    dated, calendar = extract_date_features(seasonal, start=F.col("_origin"))
    kept = [c for c in base if c not in (*names, *calendar, *SEASONAL_FEATURES)]
    return dated.select(*kept, *calendar, *SEASONAL_FEATURES, *names)


def slice_features(
    df: DataFrame,
    date_range: tuple[date, date],
    features: Features,
    target_col: str,
    group_cols: Sequence[str],
    rows_per_group: str = "check",
) -> DataFrame:
    """Features of a date slice, from its own rows or with ``context_days`` of history for its windows."""
    start, end = date_range
    context = timedelta(days=features.context_days)
    return make_features(
        slice_by_date(df, (start - context, end)),
        target_col=target_col,
        lags=features.lags,
        rollag=features.rollag,
        explag=features.explag,
        group_cols=group_cols,
        windows=features.windows,
        rolling_stats=features.rolling_stats,
        exp_stats=features.exp_stats,
        rows_per_group=rows_per_group,
        visible_from=start if features.context_days else None,
    )
