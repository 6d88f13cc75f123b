"""AGG-3, AGG-4 and WIN-9 to WIN-11: seasonal indices and regularity coefficients.

The fact table is read once, by an aggregate on (year, week, month) that combines on the map side. Everything else
works on its result, which has at most a few hundred rows per year, and is joined back by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.relational import attach, attach_measured
from shelfline.schemas import as_date, require_columns

# Share of the latest past year, and of all older years together.
LATEST_SHARE, OLDER_SHARE = 0.8, 0.2

SEASONAL_FEATURES = [
    "week_of_year", "seasonal_idx_w", "month_of_year", "seasonal_idx_m", "regular_coeff_w", "regular_coeff_m",
]

#: Helper columns of a table of totals.
_TOTALS = ["_total", "_known", "_first_date"]

#: Marks period columns that were derived from the date, whose number the calendar bounds.
_DERIVED = "shelfline.derived"

_PERIODS = {"w": ("week_of_year", F.weekofyear), "m": ("month_of_year", F.month)}


def _with_period_columns(df: DataFrame, *kinds: str) -> DataFrame:
    """Add ``year`` and the period columns unless the table has them already."""
    require_columns(df, ["date"], "seasonality")
    df = as_date(df)
    values = {"year": F.year, **dict(_PERIODS[kind] for kind in kinds)}
    added = {name: value("date").alias(name, metadata={_DERIVED: True}) for name, value in values.items() if name not in df.columns}
    return df.select("*", *added.values()) if added else df


def _year_range(start_year: int | None, end_year: int | None) -> Column | None:
    bounds = []
    if start_year is not None:
        bounds.append(F.col("year") >= start_year)
    if end_year is not None:
        bounds.append(F.col("year") <= end_year)
    if not bounds:
        return None
    return bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]


def _value(target_col: str) -> Column:
    """The target as a number; NaN is a missing value."""
    value = F.col(target_col).cast("double")
    return F.when(~F.isnan(value), value)


def period_totals(
    df: DataFrame,
    kinds: Sequence[str],
    target_col: str = "unit_sales",
    start_year: int | None = None,
    end_year: int | None = None,
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """Sum and count of the target and the first date per year and period: the only pass over the fact table."""
    inside = _year_range(start_year, end_year)
    rows = df if inside is None else df.where(inside)
    names = [_PERIODS[kind][0] for kind in kinds]
    return rows.groupBy(*partition_cols, "year", *names).agg(
        F.sum(_value(target_col)).alias("_total"),
        F.count(_value(target_col)).alias("_known"),
        F.min("date").alias("_first_date"),
    )


def with_index(table: DataFrame, kind: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Add the seasonal index to a table of totals: mean of the period over mean of the year."""
    year = [*partition_cols, "year"]
    means = []
    for keys in ([*year, _PERIODS[kind][0]], year):
        w = Window.partitionBy(*keys)
        means.append(F.try_divide(F.sum("_total").over(w), F.sum("_known").over(w)))
    return table.withColumn(f"seasonal_idx_{kind}", F.try_divide(*means))


def with_coefficient(
    table: DataFrame,
    kind: str,
    partition_cols: Sequence[str] = (),
    decay: str = "oldest",
    inside: Column | None = None,
    name: str = "regular_coeff",
) -> DataFrame:
    """WIN-9/10 on a table of periods: weighted mean of the same period's index in earlier years.

    The latest earlier year weighs 0.8. The others share 0.2 with weights that fall by a factor e per year, from the
    oldest year up (``decay="oldest"``) or from the most recent of them down (``decay="recent"``). Years that are not
    ``inside`` neither count nor get a value. A period that has several rows in the table (weeks cut by the end of a
    month) counts once.
    """
    if decay not in ("oldest", "recent"):
        raise ValueError("decay must be 'oldest' or 'recent'")
    period, value = _PERIODS[kind][0], F.col(f"seasonal_idx_{kind}")
    rows_of_period = Window.partitionBy(*partition_cols, "year", period)
    others = [n for n, _ in _PERIODS.values() if n in table.columns and n != period]
    counted = F.lit(True) if inside is None else inside
    if others:
        counted = counted & (F.row_number().over(rows_of_period.orderBy(*others)) == 1)
    w = Window.partitionBy(*partition_cols, period, "_counted").orderBy("year")
    older = w.rowsBetween(Window.unboundedPreceding, -2)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    # Only the ratio of the weights counts, so a common factor may be left in: e^-j from one end, e^j from the other.
    weight = F.exp(-F.col("_n") if decay == "oldest" else F.col("_n"))
    latest = F.lag(value).over(w)
    old_mean = F.try_divide(F.sum(weight * value).over(older), F.sum(weight).over(older))
    complete = F.count(value).over(earlier) == F.col("_n") - 1
    coefficient = F.when(F.col("_n") == 2, latest).when(
        (F.col("_n") > 2) & complete, F.lit(LATEST_SHARE) * latest + F.lit(OLDER_SHARE) * old_mean
    )
    table = (
        table.withColumn("_counted", F.coalesce(counted, F.lit(False)))
        .withColumn("_n", F.row_number().over(w))
        .withColumn(name, F.when(F.col("_counted"), coefficient))
    )
    if others:
        table = table.withColumn(name, F.max(name).over(rows_of_period))
    return table.drop("_counted", "_n")


def _add_index(df, kind, start_year, end_year, target_col, partition_cols) -> DataFrame:
    df = _with_period_columns(df, kind)
    totals = period_totals(df, [kind], target_col, start_year, end_year, partition_cols)
    return _back(df, with_index(totals, kind, partition_cols), [kind], partition_cols)


def _back(df: DataFrame, table: DataFrame, kinds: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """JOIN-10: join a small table of periods back to the rows, keeping the column order."""
    on = [*partition_cols, "year", *[_PERIODS[kind][0] for kind in kinds]]
    added = [c for c in table.columns if c not in on and c not in _TOTALS]
    # Year and period that follow from the dates bound the joined table. Further partition columns, or periods that the caller
    # brought along, do not: then it is measured.
    derived = not partition_cols and all(df.schema[c].metadata.get(_DERIVED) for c in on)
    side = table.select(*on, *added)
    joined = attach(df, side, on, small=True) if derived else attach_measured(df, side, on)
    return joined.select(*df.columns, *added)


def add_seasonal_idx_w(
    df: DataFrame,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    target_col: str = "unit_sales",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """AGG-3: ``seasonal_idx_w`` = mean sales of the ISO week over mean sales of the year; NULL outside the years."""
    return _add_index(df, "w", start_year, end_year, target_col, partition_cols)


def add_seasonal_idx_m(
    df: DataFrame,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    target_col: str = "unit_sales",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """AGG-4: the same by month."""
    return _add_index(df, "m", start_year, end_year, target_col, partition_cols)


def _add_coefficient(
    df, kind, start_year, end_year, target_col, partition_cols, decay, drop_out_of_range
) -> DataFrame:
    df = _with_period_columns(df, kind)
    name, index_col = _PERIODS[kind][0], f"seasonal_idx_{kind}"
    inside = _year_range(start_year, end_year)
    rows = df if inside is None else df.where(inside)
    if index_col in df.columns:
        table = rows.groupBy(*partition_cols, "year", name).agg(F.avg(index_col).alias(index_col))
        table = with_coefficient(table, kind, partition_cols, decay).drop(index_col)
    else:
        # The index is constant within (year, period): its own table stands for the rows.
        table = with_index(period_totals(df, [kind], target_col, partition_cols=partition_cols), kind, partition_cols)
        table = with_coefficient(table, kind, partition_cols, decay, inside)
    return _back(rows if drop_out_of_range else df, table, [kind], partition_cols)


def add_regular_coeff_w(
    df: DataFrame,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    target_col: str = "unit_sales",
    partition_cols: Sequence[str] = (),
    decay: str = "oldest",
    drop_out_of_range: bool = True,
) -> DataFrame:
    """WIN-9: ``regular_coeff`` of the ISO week. Rows outside the years are dropped, or kept with NULL."""
    return _add_coefficient(df, "w", start_year, end_year, target_col, partition_cols, decay, drop_out_of_range)


def add_regular_coeff_m(
    df: DataFrame,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    target_col: str = "unit_sales",
    partition_cols: Sequence[str] = (),
    decay: str = "oldest",
    drop_out_of_range: bool = True,
) -> DataFrame:
    """WIN-10: ``regular_coeff`` of the month."""
    return _add_coefficient(df, "m", start_year, end_year, target_col, partition_cols, decay, drop_out_of_range)


def create_seasonality_features(
    df: DataFrame,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    target_col: str = "unit_sales",
    partition_cols: Sequence[str] = (),
    decay: str = "oldest",
    drop_out_of_range: bool = False,
    totals: DataFrame | None = None,
) -> DataFrame:
    """WIN-11: both indices and both coefficients, from one pass over the fact table.

    ``totals`` may bring the result of that pass (``seasonal_totals``); further columns it has, named with a leading
    underscore, come along to the rows.
    """
    df = _with_period_columns(df, "w", "m")
    if totals is None:
        totals = seasonal_totals(df, start_year, end_year, target_col=target_col, partition_cols=partition_cols)
    table = totals
    for kind in ("w", "m"):
        table = with_index(table, kind, partition_cols)
    for kind in ("w", "m"):
        table = with_coefficient(table, kind, partition_cols, decay, name=f"regular_coeff_{kind}")
    inside = _year_range(start_year, end_year)
    rows = df.where(inside) if drop_out_of_range and inside is not None else df
    base = [c for c in df.columns if c not in SEASONAL_FEATURES]
    carried = [c for c in totals.columns if c.startswith("_") and c not in _TOTALS]
    return _back(rows, table, ["w", "m"], partition_cols).select(*base, *SEASONAL_FEATURES, *carried)


def seasonal_totals(
    df: DataFrame,
    start_year: int | None = None,
    end_year: int | None = None,
    *,
    target_col: str = "unit_sales",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """The fact pass of ``create_seasonality_features``: totals per (year, week, month)."""
    rows = _with_period_columns(df, "w", "m")
    return period_totals(rows, ["w", "m"], target_col, start_year, end_year, partition_cols)


def daily_totals(df: DataFrame, target_col: str = "unit_sales") -> DataFrame:
    """Totals per date: one pass over the fact table from which ``seasonal_totals`` of any date range follow."""
    df = as_date(df).where(F.col("date").isNotNull())
    return df.groupBy("date").agg(
        F.sum(_value(target_col)).alias("_total"), F.count(_value(target_col)).alias("_known")
    )


def totals_from_days(days: DataFrame) -> DataFrame:
    """``seasonal_totals`` of the dates in a table of daily totals."""
    return (
        _with_period_columns(days, "w", "m")
        .groupBy("year", *[name for name, _ in _PERIODS.values()])
        .agg(F.sum("_total").alias("_total"), F.sum("_known").alias("_known"), F.min("date").alias("_first_date"))
    )
