"""WIN-4 to WIN-8 and PRJ-7: promotion clocks, streaks and the missing-promotion strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfline.functions.promo import promo_flag
from shelfline.operators.series import (
    POSITION,
    BoundedFeature,
    RunningFeature,
    RunningState,
    add_series_features,
)

#: Helper column with the three-valued promo state, while features are computed.
PROMO_FLAG = "_promo_flag"

# Fixed value: the category of a missing promotion state.
MISSING_PROMO = "NO_PROMO_INFO"

_KEYS = ("store_nbr", "item_nbr")


def _when_promo(date_col: str):
    return F.when(F.col(PROMO_FLAG), F.col(date_col))


def days_since_last(date_col: str) -> RunningFeature:
    """WIN-4: the last promo date is the latest one seen so far, as rows are in date order."""

    def build(run, _, carried):
        seen = F.max(_when_promo(date_col)).over(run)
        before = carried("last_promo")
        return F.datediff(date_col, seen if before is None else F.greatest(before, seen))

    state = RunningState(lambda: F.max(_when_promo(date_col)), F.max)
    return RunningFeature("days_since_last_promo", build, states={"last_promo": state})


def days_until_next(date_col: str) -> RunningFeature:
    """WIN-5: the same from the other end, over a descending window."""

    def build(_, rev, carried):
        coming = F.min(_when_promo(date_col)).over(rev)
        after = carried("next_promo")
        return F.datediff(coming if after is None else F.least(after, coming), date_col)

    state = RunningState(lambda: F.min(_when_promo(date_col)), F.min, reverse=True)
    return RunningFeature("days_until_next_promo", build, states={"next_promo": state})


def streak() -> RunningFeature:
    """WIN-6: rows since the last row that was not a known promo; an unknown row breaks the run and is NULL itself."""
    break_pos = F.when(~F.coalesce(F.col(PROMO_FLAG), F.lit(False)), F.col(POSITION))

    def build(run, _, carried):
        last = F.max(break_pos).over(run)
        before = carried("last_break")
        last = last if before is None else F.greatest(before, last)
        length = (F.col(POSITION) - F.coalesce(last, F.lit(0))).cast("int")
        return F.when(F.col(PROMO_FLAG), length).when(~F.col(PROMO_FLAG), F.lit(0))

    state = RunningState(lambda: F.max(break_pos), F.max)
    return RunningFeature("promo_streak", build, states={"last_break": state})


def next_rows_flag(window: int) -> BoundedFeature:
    """WIN-7: 1 when one of the next rows is a promo, 0 when all are known and none is, else NULL."""

    def build(w):
        frame = w.rowsBetween(1, window)
        seen = F.bool_or(PROMO_FLAG).over(frame)
        known = F.count(PROMO_FLAG).over(frame)
        return F.when(seen, F.lit(1)).when(known == window, F.lit(0))

    return BoundedFeature("promo_in_next_7days", back=0, ahead=window, build=build)


def _apply(df, features, group_cols, date_col, promo_col, spread) -> DataFrame:
    scratch = {PROMO_FLAG: promo_flag(df, promo_col)}
    return add_series_features(df, features, group_cols, date_col=date_col, scratch=scratch, **spread)


def add_days_since_last_promo(
    df: DataFrame, group_cols: Sequence[str] = _KEYS, date_col: str = "date", promo_col: str = "onpromotion", **spread
) -> DataFrame:
    """WIN-4: days since the last promo, 0 on a promo day, NULL before the first."""
    return _apply(df, [days_since_last(date_col)], group_cols, date_col, promo_col, spread)


def add_days_until_next_promo(
    df: DataFrame, group_cols: Sequence[str] = _KEYS, date_col: str = "date", promo_col: str = "onpromotion", **spread
) -> DataFrame:
    """WIN-5: days until the next promo, 0 on a promo day, NULL after the last."""
    return _apply(df, [days_until_next(date_col)], group_cols, date_col, promo_col, spread)


def add_promo_streak(
    df: DataFrame, group_cols: Sequence[str] = _KEYS, date_col: str = "date", promo_col: str = "onpromotion", **spread
) -> DataFrame:
    """WIN-6: length of the current run of promo rows."""
    return _apply(df, [streak()], group_cols, date_col, promo_col, spread)


def add_promo_next_7days_flag(
    df: DataFrame,
    group_cols: Sequence[str] = _KEYS,
    date_col: str = "date",
    promo_col: str = "onpromotion",
    window: int = 7,
    **spread,
) -> DataFrame:
    """WIN-7: whether a promo follows within the next ``window`` rows."""
    return _apply(df, [next_rows_flag(window)], group_cols, date_col, promo_col, spread)


def promo_feature_list(date_col: str = "date", window: int = 7) -> list[BoundedFeature | RunningFeature]:
    return [days_since_last(date_col), days_until_next(date_col), streak(), next_rows_flag(window)]


def promo_features_all(
    df: DataFrame,
    group_cols: Sequence[str] = _KEYS,
    date_col: str = "date",
    promo_col: str = "onpromotion",
    window: int = 7,
    **spread,
) -> DataFrame:
    """WIN-8: the four promo features over shared windows."""
    return _apply(df, promo_feature_list(date_col, window), group_cols, date_col, promo_col, spread)


def process_promotions(
    df: DataFrame,
    strategy_for_missing_promo: str = "nan",
    *,
    observation: Observation | None = None,
) -> DataFrame:
    """PRJ-7: ``onpromotion_processed``, with missing states kept or named as a category of their own.

    With an ``observation`` the counts of missing and named rows come from the query that runs anyway.
    """
    if strategy_for_missing_promo not in ("nan", "new_category"):
        raise ValueError(
            f"unknown strategy_for_missing_promo {strategy_for_missing_promo!r}; use 'nan' or 'new_category'"
        )
    if "onpromotion" not in df.columns:
        return df
    promo = F.col("onpromotion")
    processed = promo
    if strategy_for_missing_promo == "new_category":
        processed = F.coalesce(promo.cast("string"), F.lit(MISSING_PROMO))
    out = df.withColumn("onpromotion_processed", processed)
    if observation is None:
        return out
    done = F.col("onpromotion_processed")
    return out.observe(
        observation,
        F.count_if(promo.isNull()).alias("original_nulls"),
        F.count_if(done.isNull()).alias("remaining_nulls"),
        F.count_if(done.cast("string") == MISSING_PROMO).alias("new_category_rows"),
    )
