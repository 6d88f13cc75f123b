"""AGG-3, AGG-4, WIN-9 to WIN-11, TS-1 to TS-3, JOIN-8, JOIN-9 and DATE against literal computations."""

from __future__ import annotations

import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfline.functions.calendar import CALENDAR_FEATURES, add_is_weekend, add_week_of_year, extract_date_features
from shelfline.operators.fill import (
    check_missing_dates_full_range,
    fill_oil_pchip,
    fill_time_series_full_range,
    oil_review,
)
from shelfline.operators.seasonality import (
    SEASONAL_FEATURES,
    add_regular_coeff_m,
    add_regular_coeff_w,
    add_seasonal_idx_m,
    add_seasonal_idx_w,
    create_seasonality_features,
)
from tests.helpers import close, column, day


def literal_index(pdf: pd.DataFrame, period: str) -> pd.Series:
    by_period = pdf.groupby(["year", period])["unit_sales"].transform("mean")
    return by_period / pdf.groupby("year")["unit_sales"].transform("mean")


def literal_coefficient(history: list[float], recent: bool = False) -> float | None:
    """Weighted average over earlier years, oldest first."""
    if not history:
        return None
    values, weights = [history[-1]], [0.8]
    older = history[:-1]
    if older:
        share = np.exp(-np.arange(1, len(older) + 1))
        share = share / share.sum() * 0.2
        values += older
        weights += list(share[::-1] if recent else share)
    return float(np.average(values, weights=weights))


@pytest.fixture(scope="module")
def years(spark):
    rng = np.random.default_rng(3)
    days = pd.date_range("2012-01-01", "2017-03-31", freq="3D")
    pdf = pd.DataFrame({"date": days.date, "unit_sales": np.round(rng.uniform(0, 50, len(days)), 2)})
    pdf.loc[pdf.index % 11 == 0, "unit_sales"] = np.nan
    df = spark.createDataFrame([(d, None if np.isnan(v) else float(v)) for d, v in pdf.itertuples(index=False)], "date date, unit_sales double")
    stamp = pd.to_datetime(pdf["date"])
    pdf["year"], pdf["month_of_year"] = stamp.dt.year, stamp.dt.month
    pdf["week_of_year"] = stamp.dt.isocalendar().week.astype(int).to_numpy()
    return df, pdf


@pytest.mark.parametrize(("period", "kind"), [("week_of_year", "w"), ("month_of_year", "m")])
@pytest.mark.parametrize("decay", ["oldest", "recent"])
def test_index_and_coefficient(spark, years, period, kind, decay):
    df, pdf = years
    add_index, add_coefficient = {
        "w": (add_seasonal_idx_w, add_regular_coeff_w), "m": (add_seasonal_idx_m, add_regular_coeff_m)
    }[kind]
    pdf = pdf.assign(idx=literal_index(pdf, period))
    clean = [None if pd.isna(x) else x for x in pdf["idx"]]
    close(column(add_index(df), f"seasonal_idx_{kind}"), clean)

    table = pdf.groupby([period, "year"])["idx"].mean().reset_index()
    coefficient = {}
    for p, group in table.groupby(period):
        history: list[float] = []
        for year, value in zip(group["year"], group["idx"], strict=True):
            result = literal_coefficient(history, decay == "recent")
            coefficient[year, p] = None if result is None or math.isnan(result) else result
            history.append(value)
    want = [coefficient[y, p] for y, p in zip(pdf["year"], pdf[period], strict=True)]
    close(column(add_coefficient(df, decay=decay), "regular_coeff"), want)
    # An index column that is there already is taken as it is.
    close(column(add_coefficient(add_index(df), decay=decay), "regular_coeff"), want)
    both = create_seasonality_features(df, decay=decay)
    assert both.columns == ["date", "unit_sales", "year", *SEASONAL_FEATURES]
    close(column(both, f"seasonal_idx_{kind}"), clean)
    close(column(both, f"regular_coeff_{kind}"), want)


def test_years_out_of_range(spark, years):
    df, pdf = years
    inside = pdf["year"].between(2013, 2015)
    out = create_seasonality_features(df, 2013, 2015)
    assert out.count() == len(pdf)
    got = [v is not None for v in column(out, "seasonal_idx_m")]
    assert got == list(inside)
    assert create_seasonality_features(df, 2013, 2015, drop_out_of_range=True).count() == inside.sum()
    assert add_regular_coeff_w(df, 2013, 2015).count() == inside.sum()
    kept = add_regular_coeff_w(df, 2013, 2015, drop_out_of_range=False)
    assert kept.count() == len(pdf)
    assert all(v is None for v, ok in zip(column(kept, "regular_coeff"), inside, strict=True) if not ok)
    first = [v for v, y in zip(column(add_regular_coeff_m(df, 2013, 2015), "regular_coeff"), pdf["year"][inside], strict=True) if y == 2013]
    assert all(v is None for v in first)


def test_all_zero_year(spark):
    df = spark.createDataFrame([(day(i), 0.0) for i in range(5)], "date date, unit_sales double")
    assert column(add_seasonal_idx_w(df), "seasonal_idx_w") == [None] * 5


def test_week_53_belongs_to_the_calendar_year(spark):
    df = spark.createDataFrame([(date(2016, 1, 1), 4.0), (date(2016, 6, 1), 12.0)], "date date, unit_sales double")
    assert column(add_week_of_year(df), "week_of_year") == [53, 22]
    assert column(add_seasonal_idx_w(df), "seasonal_idx_w") == [0.5, 1.5]


def test_calendar_features_match_pandas(spark):
    days = [date(2015, 12, 20) + timedelta(days=i) for i in range(500)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    out, names = extract_date_features(df)
    assert names == CALENDAR_FEATURES
    s = pd.Series(pd.to_datetime(days))
    want = pd.DataFrame(
        {
            "day_in_the_month": s.dt.day, "day_of_the_week": s.dt.dayofweek, "week_of_the_year": s.dt.isocalendar().week,
            "month": s.dt.month, "year": s.dt.year, "quarter": s.dt.quarter, "is_weekend": s.dt.dayofweek.isin([5, 6]),
            "is_month_start": s.dt.is_month_start, "is_month_end": s.dt.is_month_end,
            "is_quarter_start": s.dt.is_quarter_start, "is_quarter_end": s.dt.is_quarter_end,
            "days_since_start": (s - s.min()).dt.days,
        }
    )
    rows = out.orderBy("date").collect()
    for name in names:
        assert [r[name] for r in rows] == list(want[name]), name
    weekend = column(add_is_weekend(df, "2016-01-01", "2016-01-31"), "is_weekend")
    assert weekend[:12] == [None] * 12
    assert weekend[12:15] == [0, 1, 1]


# --- Gap-free series ------------------------------------------------------------------------------------------------


def literal_cubic(x: list[int], y: list[float], at: list[int]) -> list[float]:
    """Monotone cubic by its published definition, knot by knot."""
    n = len(x)
    h = [x[i + 1] - x[i] for i in range(n - 1)]
    s = [(y[i + 1] - y[i]) / h[i] for i in range(n - 1)]

    def edge(h0, h1, s0, s1):
        d = ((2 * h0 + h1) * s0 - h0 * s1) / (h0 + h1)
        if np.sign(d) != np.sign(s0):
            return 0.0
        if np.sign(s0) != np.sign(s1) and abs(d) > 3 * abs(s0):
            return 3 * s0
        return d

    d = [edge(h[0], h[1], s[0], s[1])]
    for i in range(1, n - 1):
        if s[i - 1] * s[i] <= 0:
            d.append(0.0)
        else:
            w1, w2 = 2 * h[i] + h[i - 1], h[i] + 2 * h[i - 1]
            d.append((w1 + w2) / (w1 / s[i - 1] + w2 / s[i]))
    d.append(edge(h[-1], h[-2], s[-1], s[-2]))
    out = []
    for t in at:
        k = min(max(int(np.searchsorted(x, t, side="right")) - 1, 0), n - 2)
        u = t - x[k]
        c2 = (3 * s[k] - 2 * d[k] - d[k + 1]) / h[k]
        c3 = (d[k] + d[k + 1] - 2 * s[k]) / h[k] ** 2
        out.append(y[k] + u * (d[k] + u * (c2 + u * c3)))
    return out


def oil_table(spark, values, step=None):
    days = step or range(len(values))
    return spark.createDataFrame(list(zip([day(i) for i in days], values, strict=True)), "date date, dcoilwtico double")


def test_cubic_by_hand(spark):
    # Symmetric hill on 0, 2, 4, 6: flat top, so the middle is the plateau itself.
    out = fill_oil_pchip(oil_table(spark, [0.0, None, 4.0, None, 4.0, None, 0.0]))
    got = column(out, "dcoilwtico_filled")
    close([got[i] for i in (0, 2, 3, 4, 6)], [0.0, 4.0, 4.0, 4.0, 0.0])
    assert 2.0 < got[1] < 4.0 and got[1] == pytest.approx(got[5])
    line = fill_oil_pchip(oil_table(spark, [None, 1.0, 2.0, None, 4.0, 5.0, None]))
    close(column(line, "dcoilwtico_filled"), [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    assert column(line, "date_numeric") == list(range(7))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(1, 4), min_size=4, max_size=12),
    st.data(),
    st.booleans(),
)
def test_cubic_matches_its_definition(spark, gaps, data, increasing):
    knots = [2 + sum(gaps[: i + 1]) for i in range(len(gaps))]
    values = [float(v) for v in data.draw(st.lists(st.integers(-50, 50), min_size=len(gaps), max_size=len(gaps)))]
    if increasing:
        values = sorted(values)
    known = dict(zip(knots, values, strict=True))
    days = list(range(knots[-1] + 3))
    got = column(fill_oil_pchip(oil_table(spark, [known.get(i) for i in days])), "dcoilwtico_filled")
    close(got, literal_cubic(knots, values, days), 1e-7)
    assert all(got[k] == v for k, v in known.items())
    if increasing:
        inner = got[knots[0] : knots[-1] + 1]
        assert all(b >= a - 1e-9 for a, b in zip(inner, inner[1:], strict=False))


def test_linear_fallback(spark):
    out = fill_oil_pchip(oil_table(spark, [None, 2.0, None, None, 8.0, None], [0, 1, 2, 7, 9, 10]))
    close(column(out, "dcoilwtico_filled"), [2.0, 2.0, 4.0, 6.0, 8.0, 8.0])
    assert column(fill_oil_pchip(oil_table(spark, [None, None])), "dcoilwtico_filled") == [None, None]
    assert column(fill_oil_pchip(oil_table(spark, [None, 3.0, float("nan")])), "dcoilwtico_filled") == [3.0] * 3


def test_repeated_day_is_an_error(spark):
    with pytest.raises(Exception, match="unique"):
        fill_oil_pchip(oil_table(spark, [1.0, 2.0], [0, 0])).collect()
    twice = oil_table(spark, [1.0, 2.0], [0, 0]).selectExpr("1 AS item_nbr", "*")
    with pytest.raises(Exception, match="unique"):
        fill_oil_pchip(twice, partition_cols=["item_nbr"]).collect()


def test_full_range(spark):
    sparse = oil_table(spark, [1.0, 2.0, None, 7.0, 9.0], [0, 1, 3, 6, 8])
    out = fill_time_series_full_range(fill_oil_pchip(sparse))
    assert out.columns == ["date", "dcoilwtico", "dcoilwtico_filled", "dcoilwtico_complete"]
    assert column(out, "date") == [day(i) for i in range(9)]
    filled = dict(zip(column(sparse, "date"), column(fill_oil_pchip(sparse), "dcoilwtico_filled"), strict=True))
    x = [(d - day(0)).days for d in filled]
    close(column(out, "dcoilwtico_complete"), literal_cubic(x, list(filled.values()), list(range(9))))


def test_many_series_at_once(spark):
    rows = [(s, day(2 * i), None if (i + s) % 3 == 0 else float(s * i * i)) for s in (1, 2, 3) for i in range(12)]
    df = spark.createDataFrame(rows, "item_nbr int, date date, price double")
    out = fill_time_series_full_range(
        fill_oil_pchip(df, "price", partition_cols=["item_nbr"]), "price", filled_col="price_filled", complete_col="full",
        partition_cols=["item_nbr"],
    )
    for s in (1, 2, 3):
        one = fill_time_series_full_range(
            fill_oil_pchip(df.where(f"item_nbr = {s}").drop("item_nbr"), "price"), "price", filled_col="price_filled", complete_col="full"
        )
        close(column(out.where(f"item_nbr = {s}"), "full"), column(one, "full"))


def test_review(spark):
    out = oil_review(fill_oil_pchip(oil_table(spark, [1.0, None, 3.0])), zoom=("2017-01-02", "2017-01-09"))
    rows = [tuple(r)[1:] for r in out.orderBy("date").collect()]
    assert rows == [(1.0, 1.0, False, False), (None, 2.0, True, True), (3.0, 3.0, False, True)]


def test_calendar_gaps(spark):
    a = spark.createDataFrame([(day(i),) for i in (1, 2, 2, 5)], "date date")
    b = spark.createDataFrame([(day(i),) for i in (0, 2, 3, 3, 4)], "date date")
    gaps = check_missing_dates_full_range(a, b)
    rows = [tuple(r)[1:] for r in gaps.days.orderBy("date").collect()]
    assert rows == [(True, False), (False, True), (False, False), (True, False), (True, False), (False, True)]
    assert tuple(gaps.counts.first()) == (3, 2, 3)
    assert [r[0] for r in gaps.sample.collect()] == [day(0), day(3), day(4)]
