"""PRJ-1 to PRJ-3, AGG-1 and AGG-2: date slices, date bounds and target removal."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import as_date, require_columns

DateLike = str | date | datetime


def _moment(value: DateLike) -> datetime:
    return pd.to_datetime(value).to_pydatetime()


def _between(df: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    # Rows are whole days: a lower bound within a day starts with the next one.
    first = lo.date() if lo.time() == time.min else lo.date() + timedelta(days=1)
    return as_date(df).where(F.col("date").between(F.lit(first), F.lit(hi.date())))


def slice_by_date(df: DataFrame, date_range: tuple[DateLike, DateLike] | list[DateLike]) -> DataFrame:
    """PRJ-1: rows of an inclusive date range; reversed bounds are swapped. The predicate reaches the scan."""
    if "date" not in df.columns:
        raise ValueError("slice_by_date: a 'date' column is required")
    if not isinstance(date_range, (list, tuple)) or len(date_range) != 2:
        raise ValueError("slice_by_date: date_range must be a pair (start, end)")
    lo, hi = sorted(_moment(bound) for bound in date_range)
    return _between(df, lo, hi)


def plain_slice(df: DataFrame, date_range: tuple[DateLike, DateLike]) -> DataFrame:
    """PRJ-2: the same without checks; reversed bounds select nothing."""
    return _between(df, _moment(date_range[0]), _moment(date_range[1]))


def drop_target_cols(df: DataFrame, target_col: str) -> DataFrame:
    """PRJ-3."""
    return df.drop(target_col)


def date_bounds(df: DataFrame, date_col: str = "date") -> DataFrame:
    """AGG-1 as one row: ``min_date, max_date``."""
    require_columns(df, [date_col], "date_bounds")
    day = F.col(date_col).cast("date")
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def min_date(df: DataFrame, date_col: str = "date") -> date | None:
    """AGG-1: the first date."""
    return date_bounds(df, date_col).first()["min_date"]


def max_date(df: DataFrame, date_col: str = "date") -> date | None:
    """AGG-1: the last date."""
    return date_bounds(df, date_col).first()["max_date"]


def unique_dates(df: DataFrame) -> DataFrame:
    """AGG-2: the distinct dates in order."""
    return as_date(df).select("date").where(F.col("date").isNotNull()).distinct().orderBy("date")
