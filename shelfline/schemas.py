"""Column types of the five input tables, and the rule that keeps NaN out of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type of every input column the engine knows, by column name.
COLUMN_TYPES: dict[str, T.DataType] = {
    "id": T.LongType(),
    "date": T.DateType(),
    "store_nbr": T.IntegerType(),
    "item_nbr": T.IntegerType(),
    "unit_sales": T.DoubleType(),
    "onpromotion": T.BooleanType(),
    "family": T.StringType(),
    "class": T.IntegerType(),
    "city": T.StringType(),
    "state": T.StringType(),
    "dcoilwtico": T.DoubleType(),
    "type": T.StringType(),
    "locale": T.StringType(),
    "locale_name": T.StringType(),
    "description": T.StringType(),
    "transferred": T.BooleanType(),
}


#: Pinned columns of each input table; in other tables nothing is pinned.
TABLE_COLUMNS: dict[str, tuple[str, ...]] = {
    "train": ("id", "date", "store_nbr", "item_nbr", "unit_sales", "onpromotion"),
    "items": ("item_nbr", "family", "class"),
    "stores": ("store_nbr", "city", "state", "type"),
    "oil": ("date", "dcoilwtico"),
    "holidays_events": ("date", "type", "locale", "locale_name", "description", "transferred"),
}


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, COLUMN_TYPES[name], True) for name in names])


SALES = _struct("date", "store_nbr", "item_nbr", "unit_sales", "onpromotion")
ITEMS = _struct("item_nbr", "family", "class")
STORES = _struct("store_nbr", "city", "state")
OIL = _struct("date", "dcoilwtico")
HOLIDAYS = _struct("date", "type", "locale", "locale_name", "description", "transferred")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column: Spark aggregates skip NULL but not NaN."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {missing}")


def as_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Cast the date column once, whatever date-like type it arrived in."""
    return df if df.schema[column].dataType == T.DateType() else df.withColumn(column, F.col(column).cast("date"))
