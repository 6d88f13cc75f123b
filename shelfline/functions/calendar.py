"""DATE-1 to DATE-5: calendar columns as plain expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import as_date, require_columns

CALENDAR_FEATURES = [
    "day_in_the_month", "day_of_the_week", "week_of_the_year", "month", "year", "quarter", "is_weekend",
    "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end", "days_since_start",
]


def calendar_columns(date_col: str, start: Column) -> dict[str, Column]:
    """The twelve calendar features of a date column; ``start`` is the first date of the table."""
    d = F.col(date_col)
    next_day = F.date_add(d, 1)
    weekday = F.weekday(d)
    return {
        "day_in_the_month": F.dayofmonth(d),
        "day_of_the_week": weekday,
        "week_of_the_year": F.weekofyear(d),
        "month": F.month(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "is_weekend": weekday >= 5,
        "is_month_start": F.dayofmonth(d) == 1,
        "is_month_end": d == F.last_day(d),
        "is_quarter_start": d == F.trunc(d, "quarter"),
        "is_quarter_end": next_day == F.trunc(next_day, "quarter"),
        "days_since_start": F.datediff(d, start),
    }


def first_date(df: DataFrame, date_col: str = "date") -> Column:
    """The earliest date of ``df`` as a scalar subquery: one aggregate, no join."""
    return df.agg(F.min(F.col(date_col).cast("date"))).scalar()


def extract_date_features(
    df: DataFrame, date_column: str = "date", *, start: Column | None = None
) -> tuple[DataFrame, list[str]]:
    """DATE-1: the table with the twelve calendar features, and their names."""
    require_columns(df, [date_column], "extract_date_features")
    origin = first_date(df, date_column) if start is None else start
    return as_date(df, date_column).withColumns(calendar_columns(date_column, origin)), list(CALENDAR_FEATURES)


def in_date_range(column: Column, start_day: str | date | None, end_day: str | date | None) -> Column | None:
    """Predicate of an inclusive date range whose open ends mean the table's own ends; None when it is always true."""
    bounds = []
    if start_day is not None:
        bounds.append(column >= F.lit(start_day).cast("date"))
    if end_day is not None:
        bounds.append(column <= F.lit(end_day).cast("date"))
    if not bounds:
        return None
    return bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]


def _ranged(df: DataFrame, name: str, value: Column, start_day, end_day) -> DataFrame:
    inside = in_date_range(F.col("date"), start_day, end_day)
    return df.withColumn(name, value if inside is None else F.when(inside, value))


def add_week_of_year(df: DataFrame, start_day=None, end_day=None) -> DataFrame:
    """DATE-2: ISO week, null outside the range."""
    return _ranged(as_date(df), "week_of_year", F.weekofyear("date"), start_day, end_day)


def add_month_of_year(df: DataFrame, start_day=None, end_day=None) -> DataFrame:
    """DATE-3: month number, null outside the range."""
    return _ranged(as_date(df), "month_of_year", F.month("date"), start_day, end_day)


def add_is_weekend(df: DataFrame, start_day=None, end_day=None) -> DataFrame:
    """DATE-4: 1 on Saturday and Sunday, else 0; null outside the range."""
    return _ranged(as_date(df), "is_weekend", (F.weekday("date") >= 5).cast("int"), start_day, end_day)


def day_number(date_col: str, start: Column) -> Column:
    """DATE-5: days since the first date of the table."""
    return F.datediff(F.col(date_col), start)
