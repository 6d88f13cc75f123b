"""TS-1 to TS-3, JOIN-8 and JOIN-9: gap-free daily series and the calendar gap report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.calendar import first_date
from shelfline.schemas import as_date, nan_to_null, require_columns

# Known points needed for the cubic, and the period of the detail view.
MIN_KNOTS = 4
ZOOM = ("2016-10-01", "2017-12-31")


def _one_row_per_day(df: DataFrame, date_col: str, keys: Sequence[str]) -> DataFrame:
    """Check that every series has one row per day; a repeated day fails the query.

    The aggregate combines on the map side, and after it the calendar bounds the length of a series: the windows that
    follow never meet a series that does not fit a task, not even on their way to the error.
    """
    days = [*keys, date_col]
    rest = [c for c in df.columns if c not in days]
    merged = df.groupBy(*days).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(F.col(c)).alias(c) for c in rest])
    checked = F.when(F.col("_n") == 1, F.col(date_col)).otherwise(
        F.raise_error(F.lit(f"'{date_col}' must be unique in a daily series")).cast("date")
    )
    return merged.withColumn(date_col, checked).select(*df.columns)


def _edge_slope(h0: Column, h1: Column, s0: Column, s1: Column) -> Column:
    """Slope at an end of the series: three-point formula, limited so that the curve keeps its shape."""
    d = F.try_divide((2 * h0 + h1) * s0 - h0 * s1, h0 + h1)
    return (
        F.when(F.signum(d) != F.signum(s0), F.lit(0.0))
        .when((F.signum(s0) != F.signum(s1)) & (F.abs(d) > 3 * F.abs(s0)), 3 * s0)
        .otherwise(d)
    )


def _inner_slope(h0: Column, h1: Column, s0: Column, s1: Column) -> Column:
    """Slope at an inner knot: weighted harmonic mean of the neighbouring secants, 0 at a turning point."""
    w1, w2 = 2 * h1 + h0, h1 + 2 * h0
    mean = F.try_divide(w1 + w2, F.try_divide(w1, s0) + F.try_divide(w2, s1))
    return F.when(F.signum(s0) * F.signum(s1) <= 0, F.lit(0.0)).otherwise(mean)


def interpolate_daily(
    df: DataFrame, value_col: str, date_col: str, out_col: str, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """Fill ``value_col`` into ``out_col`` by a shape-preserving cubic over days, with a linear fallback.

    Every series needs one row per day. Known points keep their value; the cubics at the ends extend beyond the first
    and last known point. With fewer than four known points values are interpolated linearly by row position, the last
    one is carried forward and the first one back. All windows start from one shuffle by ``partition_cols``.
    """
    keys = list(partition_cols)
    df = _one_row_per_day(df, date_col, keys)
    columns = df.columns
    series = keys or [F.lit(0)]
    whole = Window.partitionBy(*series)
    asc = whole.orderBy(date_col)
    desc = whole.orderBy(F.col(date_col).desc())
    knots = Window.partitionBy(*series, "_known").orderBy(date_col)

    df = df.withColumns(
        {
            "_y": F.col(value_col).cast("double"),
            "_x": F.unix_date(date_col),
            "_known": F.col(value_col).isNotNull(),
        }
    ).withColumn("_knots", F.count("_y").over(whole))

    # Distances and secants to the neighbouring known points (p: previous, n: next; pp and nn: one further).
    near = {}
    for suffix, step in (("p", -1), ("n", 1), ("pp", -2), ("nn", 2)):
        for axis in ("x", "y"):
            near[f"_{axis}{suffix}"] = F.lead(f"_{axis}", step).over(knots)
    df = df.withColumns(near)

    def secant(a: str, b: str) -> Column:
        return F.try_divide(F.col(f"_y{b}") - F.col(f"_y{a}"), F.col(f"_x{b}") - F.col(f"_x{a}"))

    def step(a: str, b: str) -> Column:
        return (F.col(f"_x{b}") - F.col(f"_x{a}")).cast("double")

    slope = (
        F.when(F.col("_xp").isNull(), _edge_slope(step("", "n"), step("n", "nn"), secant("", "n"), secant("n", "nn")))
        .when(F.col("_xn").isNull(), _edge_slope(step("p", ""), step("pp", "p"), secant("p", ""), secant("pp", "p")))
        .otherwise(_inner_slope(step("p", ""), step("", "n"), secant("p", ""), secant("", "n")))
    )
    df = df.withColumn("_d", slope)
    piece = F.struct(
        F.col("_x").alias("x"),
        F.col("_y").alias("y"),
        step("", "n").alias("h"),
        secant("", "n").alias("s"),
        F.col("_d").alias("d0"),
        F.lead("_d").over(knots).alias("d1"),
    )
    df = df.withColumn("_piece", F.when(F.col("_known") & F.col("_xn").isNotNull(), piece))

    df = df.withColumn("_row", F.row_number().over(asc))
    point = F.when(F.col("_known"), F.struct(F.col("_row").alias("row"), F.col("_y").alias("y")))
    seen = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    coming = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns(
        {
            "_piece_before": F.last("_piece", ignorenulls=True).over(seen),
            "_point_before": F.last(point, ignorenulls=True).over(seen),
        }
    ).withColumns(
        {
            "_piece_after": F.last("_piece", ignorenulls=True).over(coming),
            "_point_after": F.last(point, ignorenulls=True).over(coming),
        }
    )

    p = F.coalesce(F.col("_piece_before"), F.col("_piece_after"))
    t = (F.col("_x") - p["x"]).cast("double")
    c2 = F.try_divide(3 * p["s"] - 2 * p["d0"] - p["d1"], p["h"])
    c3 = F.try_divide(p["d0"] + p["d1"] - 2 * p["s"], p["h"] * p["h"])
    cubic = p["y"] + t * (p["d0"] + t * (c2 + t * c3))

    a, b = F.col("_point_before"), F.col("_point_after")
    share = F.try_divide(F.col("_row") - a["row"], b["row"] - a["row"])
    linear = F.when(a.isNull(), b["y"]).when(b.isNull(), a["y"]).otherwise(a["y"] + (b["y"] - a["y"]) * share)

    value = F.when(F.col("_known"), F.col("_y")).when(F.col("_knots") >= MIN_KNOTS, cubic).otherwise(linear)
    return df.select(*[c for c in columns if c != out_col], value.alias(out_col))


def fill_oil_pchip(
    oil_df: DataFrame, value_col: str = "dcoilwtico", date_col: str = "date", *, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """TS-1: adds ``date_numeric`` (days since the first date) and ``{value_col}_filled``."""
    require_columns(oil_df, [value_col, date_col, *partition_cols], "fill_oil_pchip")
    df = as_date(nan_to_null(oil_df), date_col)
    if partition_cols:
        start = F.min(date_col).over(Window.partitionBy(*partition_cols))
    else:
        start = first_date(df, date_col)
    df = df.withColumn("date_numeric", F.datediff(date_col, start))
    return interpolate_daily(df, value_col, date_col, f"{value_col}_filled", partition_cols)


def date_spine(df: DataFrame, date_col: str = "date", partition_cols: Sequence[str] = ()) -> DataFrame:
    """JOIN-8, left side: every day between the first and the last date (of each series)."""
    keys = list(partition_cols)
    ends = df.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    days = F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(date_col)
    return ends.where(F.col("_lo").isNotNull()).select(*keys, days)


def fill_time_series_full_range(
    oil_df: DataFrame,
    value_col: str = "dcoilwtico",
    date_col: str = "date",
    filled_col: str = "dcoilwtico_filled",
    complete_col: str = "dcoilwtico_complete",
    *,
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """TS-2: one row for every day of the range, with ``filled_col`` interpolated again into ``complete_col``."""
    require_columns(oil_df, [value_col, date_col, filled_col, *partition_cols], "fill_time_series_full_range")
    df = as_date(nan_to_null(oil_df), date_col).drop("date_numeric")
    on = [*partition_cols, date_col]
    full = date_spine(df, date_col, partition_cols).join(df, on, "left")
    full = full.select(*on, *[c for c in df.columns if c not in on])
    return interpolate_daily(full, filled_col, date_col, complete_col, partition_cols)


def oil_review(
    oil_processed: DataFrame,
    value_col: str = "dcoilwtico",
    filled_col: str = "dcoilwtico_filled",
    zoom: tuple[str, str] = ZOOM,
) -> DataFrame:
    """TS-3: the data behind an interpolation chart: which values were filled, and which lie in the detail view."""
    lo, hi = (F.lit(day).cast("date") for day in zoom)
    return oil_processed.select(
        "date",
        F.col(value_col).alias("value"),
        F.col(filled_col).alias("filled"),
        F.col(value_col).isNull().alias("is_filled"),
        F.col("date").between(lo, hi).alias("in_zoom"),
    )


@dataclass(frozen=True)
class CalendarGaps:
    """JOIN-9: the days of the joint range, the counts, and the first days missing in one table but not the other."""

    days: DataFrame
    counts: DataFrame
    sample: DataFrame


def check_missing_dates_full_range(
    oil_df: DataFrame, train_df: DataFrame, oil_date_col: str = "date", train_date_col: str = "date", sample: int = 10
) -> CalendarGaps:
    """JOIN-9: which days of the joint range are missing in either table. Facts are reduced to their dates first."""

    def dates(df: DataFrame, column: str, flag: str) -> DataFrame:
        day = F.col(column).cast("date").alias("date")
        return df.select(day).where(F.col("date").isNotNull()).distinct().withColumn(flag, F.lit(True))

    present = (
        dates(oil_df, oil_date_col, "_in_oil")
        .unionByName(dates(train_df, train_date_col, "_in_train"), allowMissingColumns=True)
        .groupBy("date")
        .agg(F.bool_or("_in_oil").alias("_in_oil"), F.bool_or("_in_train").alias("_in_train"))
    )
    days = (
        date_spine(present)
        .join(present, "date", "left")
        .select(
            "date",
            F.coalesce(~F.col("_in_oil"), F.lit(True)).alias("missing_in_oil"),
            F.coalesce(~F.col("_in_train"), F.lit(True)).alias("missing_in_train"),
        )
    )
    only_train = F.col("missing_in_oil") & ~F.col("missing_in_train")
    counts = days.agg(
        F.count_if("missing_in_oil").alias("missing_in_oil"),
        F.count_if("missing_in_train").alias("missing_in_train"),
        F.count_if(only_train).alias("missing_in_oil_present_in_train"),
    )
    return CalendarGaps(days, counts, days.where(only_train).select("date").orderBy("date").limit(sample))
