"""FLOW-2, CV-1 and CV-2: embargoed time-series folds as a small table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fold:
    """Inclusive date ranges of one fold."""

    fold: int
    train_start: date
    train_end: date
    val_start: date
    val_end: date

    @property
    def train_range(self) -> tuple[date, date]:
        return self.train_start, self.train_end

    @property
    def val_range(self) -> tuple[date, date]:
        return self.val_start, self.val_end


def embargo_days(max_lag: int, max_window: int) -> int:
    """FLOW-2: dates between training and validation, so that no window of the latter reaches into the former."""
    return int(max_lag + max_window - 1)


def build_rolling_windows(
    dates: DataFrame, n_windows: int, val_size: int, stride: int, embargo: int, min_train_days: int
) -> DataFrame:
    """CV-1: ``fold, train_start, train_end, val_start, val_end`` from a table of distinct dates.

    Folds are counted back from the last date. Training always starts at the first date and ends ``embargo`` dates
    before validation; folds whose training part would be shorter than ``min_train_days`` dates are left out. The
    windows run over distinct dates, whose number the calendar bounds.
    """
    everything = Window.partitionBy(F.lit(0))
    placed = dates.select(
        "date",
        (F.row_number().over(everything.orderBy("date")) - 1).alias("pos"),
        F.count(F.lit(1)).over(everything).alias("n"),
    )
    numbers = F.sequence(F.lit(0), F.lit(n_windows - 1)) if n_windows > 0 else F.array().cast("array<int>")
    val_end = F.col("n") - F.col("fold") * stride
    val_start = val_end - val_size
    train_end = val_start - embargo

    def at(position):
        return F.max(F.when(F.col("pos") == position, F.col("date")))

    return (
        placed.withColumn("fold", F.explode(numbers))
        .where(train_end >= min_train_days)
        .groupBy("fold")
        .agg(
            at(F.lit(0)).alias("train_start"),
            at(train_end - 1).alias("train_end"),
            at(val_start).alias("val_start"),
            at(val_end - 1).alias("val_end"),
        )
        .orderBy("fold")
    )


def feasibility(dates: DataFrame, val_size: int, embargo: int, min_train_days: int) -> DataFrame:
    """CV-2: how many dates there are, how many one fold needs, and whether that is enough."""
    required = min_train_days + embargo + val_size
    n = F.count(F.lit(1))
    return dates.agg(
        n.alias("n_dates"), F.lit(required).alias("required_min_dates"), (n >= required).alias("feasible")
    )


def collect_folds(folds: DataFrame) -> list[Fold]:
    """The fold table as values for a loop of jobs: one row per fold."""
    return [Fold(**row.asDict()) for row in folds.orderBy("fold").collect()]


def rows_of_folds(df: DataFrame, folds: DataFrame, part: str = "val") -> DataFrame:
    """Rows of ``df`` in the training or validation range of each fold, with the ``fold`` they belong to.

    The ranges become a table of days (bounded by the calendar and the number of folds), so this is an equi-join, and
    ``df`` is read once for all folds.
    """
    if part not in ("train", "val"):
        raise ValueError("part must be 'train' or 'val'")
    days = F.explode(F.sequence(f"{part}_start", f"{part}_end", F.expr("interval 1 day"))).alias("date")
    return df.join(F.broadcast(folds.select("fold", days)), "date").select("fold", *df.columns)
