"""WIN-1 to WIN-8: hand-made series, and the cut path against the plain one."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import series
from shelfline.operators.promotions import promo_feature_list, promo_features_all
from shelfline.operators.series import (
    add_series_features,
    expanding_feature,
    first_rows,
    lag_feature,
    make_expanding,
    make_lag,
    make_rolling,
    rolling_feature,
    with_positions,
)
from tests.helpers import close, column, daily, day

KEYS = ["store_nbr", "item_nbr"]
STATS = ["mean", "std", "max", "min", "sum"]


def test_lags_count_rows_and_keep_series_apart(spark):
    a = daily(spark, [1, 2, 3], start=0)
    b = daily(spark, [10, 20, 30], store=2, start=5)
    out = make_lag(a.union(b), "unit_sales", [1, 2], KEYS)
    assert column(out, "unit_sales_lag_1") == [None, 1.0, 2.0, None, 10.0, 20.0]
    assert column(out, "unit_sales_lag_2") == [None, None, 1.0, None, None, 10.0]


def test_rolling_needs_every_value(spark):
    out = make_rolling(daily(spark, [1, 2, None, 4, 5, 6]), "unit_sales", [1], [2], ["mean", "std"], KEYS)
    assert column(out, "unit_sales_roll2_mean_lag1") == [None, None, 1.5, None, None, 4.5]
    close(column(out, "unit_sales_roll2_std_lag1"), [None, None, 0.5**0.5, None, None, 0.5**0.5])
    one = make_rolling(daily(spark, [1, 2, 3]), "unit_sales", [1], [1], ["std"], KEYS)
    assert column(one, "unit_sales_roll1_std_lag1") == [None, None, None]


def test_expanding_skips_missing(spark):
    out = make_expanding(daily(spark, [1, None, 3, 8]), "unit_sales", [1], STATS, KEYS)
    close(column(out, "unit_sales_exp_mean_lag1"), [None, 1.0, 1.0, 2.0])
    close(column(out, "unit_sales_exp_std_lag1"), [None, None, None, 2.0**0.5])
    close(column(out, "unit_sales_exp_sum_lag1"), [None, 1.0, 1.0, 4.0])
    close(column(out, "unit_sales_exp_max_lag1"), [None, 1.0, 1.0, 3.0])


def test_statistics_match_pandas(spark):
    rng = np.random.default_rng(5)
    values = [None if rng.random() < 0.1 else float(np.round(rng.normal(50, 20), 2)) for _ in range(60)]
    df = daily(spark, values)
    out = make_expanding(make_rolling(df, "unit_sales", [1, 3], [3, 7], STATS, KEYS), "unit_sales", [1, 4], STATS, KEYS)
    s = pd.Series(values, dtype="float64")
    for stat in STATS:
        for shift in (1, 3):
            for width in (3, 7):
                want = s.shift(shift).rolling(width).agg(stat)
                got = column(out, f"unit_sales_roll{width}_{stat}_lag{shift}")
                close(got, [None if pd.isna(x) else x for x in want], 1e-7)
        for shift in (1, 4):
            want = s.shift(shift).expanding().agg(stat)
            got = column(out, f"unit_sales_exp_{stat}_lag{shift}")
            close(got, [None if pd.isna(x) else x for x in want], 1e-7)


def test_unknown_statistic(spark):
    with pytest.raises(ValueError):
        make_rolling(daily(spark, [1.0]), "unit_sales", [1], [2], ["median"], KEYS)


def test_promo_states(spark):
    promos = [True, True, None, False, True, True, True, False]
    out = promo_features_all(daily(spark, range(8), promos), KEYS)
    assert column(out, "promo_streak") == [1, 2, None, 0, 1, 2, 3, 0]
    assert column(out, "days_since_last_promo") == [0, 0, 1, 2, 0, 0, 0, 1]
    assert column(out, "days_until_next_promo") == [0, 0, 2, 1, 0, 0, 0, None]
    assert column(out, "promo_in_next_7days") == [1, 1, 1, 1, 1, 1, None, None]


def test_next_rows_flag_is_zero_only_when_all_are_known(spark):
    out = promo_features_all(daily(spark, range(4), [False, False, False, None]), KEYS, window=2)
    assert column(out, "promo_in_next_7days") == [0, None, None, None]


def test_null_keys_get_null_features(spark):
    df = daily(spark, [1, 2, 3], [True, True, True]).withColumn("store_nbr", F.lit(None).cast("int"))
    out = make_lag(promo_features_all(df, KEYS), "unit_sales", [1], KEYS)
    for name in ("unit_sales_lag_1", "promo_streak", "days_since_last_promo", "promo_in_next_7days"):
        assert column(out, name) == [None, None, None]


def all_features():
    return [
        *[lag_feature("unit_sales", k) for k in (1, 3, -1)],
        *[rolling_feature("unit_sales", v, w, s) for s in STATS for v in (1, 2) for w in (2, 4)],
        *[expanding_feature("unit_sales", v, s) for s in STATS for v in (0, 1, 6)],
        *promo_feature_list("date", 3),
    ]


def random_sales(spark, seed, hot_rows):
    """One series with most rows, many short ones, missing values, repeated dates and a few rows without a key."""
    rng = random.Random(seed)

    def row(store, item, i):
        value = None if rng.random() < 0.15 else round(rng.uniform(-5, 100), 2)
        promo = rng.choice([True, True, False, False, None])
        return (day(i), store, item, i, value, promo)

    rows = [row(1, 1, i // 2) for i in range(hot_rows)]
    rows += [row(s, 2, i) for s in range(2, 8) for i in range(rng.randint(1, 9))]
    rows += [row(None, 1, i) for i in range(6)]
    rows = [(*r[:3], n, *r[4:]) for n, r in enumerate(rows)]
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "date date, store_nbr int, item_nbr int, line int, unit_sales double, onpromotion boolean"
    )


@pytest.mark.parametrize(("keys", "seed"), [(KEYS, 1), (["store_nbr"], 2), ([], 3)])
def test_cut_series_equal_whole_series(spark, keys, seed):
    df = random_sales(spark, seed, 70)
    scratch = {"_promo_flag": F.col("onpromotion")}

    def run():
        out = add_series_features(df, all_features(), keys, tiebreak=["line"], scratch=scratch)
        return sorted(out.collect(), key=lambda r: r["line"])

    whole = run()
    spark.conf.set("spark.shelfline.maxGroupRows", "7")
    try:
        cut = run()
    finally:
        spark.conf.unset("spark.shelfline.maxGroupRows")
    assert len(whole) == len(cut) == df.count()
    for a, b in zip(whole, cut, strict=True):
        for name in a.asDict():
            x, y = a[name], b[name]
            if isinstance(x, float) and isinstance(y, float):
                assert abs(x - y) < 1e-7, (name, x, y)
            else:
                assert x == y, (name, a, b)


def test_cut_series_with_identical_rows(tiny_groups):
    """A group of copies, which no sort key can tell apart, is still cut by position."""
    df = tiny_groups.createDataFrame([(day(0), 1, 1, 2.0)] * 40, "date date, store_nbr int, item_nbr int, unit_sales double")
    out = make_expanding(make_lag(df, "unit_sales", [1], KEYS), "unit_sales", [1], ["sum"], KEYS)
    sums = sorted(r["unit_sales_exp_sum_lag1"] or 0.0 for r in out.collect())
    assert sums == [2.0 * i for i in range(40)]


def test_positions_are_complete(spark):
    df = random_sales(spark, 4, 50)
    out = with_positions(df, ["store_nbr"], ["date", "line"], 8).where("store_nbr = 1").orderBy("date", "line").collect()
    assert [r["_pos"] for r in out] == list(range(1, 51))


def test_series_are_dealt_by_rows(spark, monkeypatch):
    """The tasks that window series grow with the table, and nothing else changes."""
    df = random_sales(spark, 12, 40)
    columns = ["date", *KEYS, "line", "unit_sales_lag_1"]
    lagged = lambda: make_lag(df, "unit_sales", [1], KEYS, rows_per_group="daily", tiebreak=("line",)).select(*columns)
    want = sorted(map(str, lagged().collect()))
    monkeypatch.setattr(series, "_TASK_ROWS", 20, raising=False)
    assert sorted(map(str, lagged().collect())) == want
    tasks = {r["task"] for r in lagged().withColumn("task", F.spark_partition_id()).collect()}
    assert len(tasks) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_short_chunks_are_numbered_in_few_ranges(spark):
    df = random_sales(spark, 4, 50)
    out = with_positions(df, ["store_nbr"], ["date", "line"], 1).where("store_nbr = 1").orderBy("date", "line")
    assert [r["_pos"] for r in out.collect()] == list(range(1, 51))
    assert 1 < len(out.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_first_rows(tiny_groups):
    df = random_sales(tiny_groups, 6, 40).where("store_nbr IS NOT NULL")
    got = [r["line"] for r in first_rows(df, 17, ["store_nbr", "item_nbr", "line"]).collect()]
    want = [r["line"] for r in df.orderBy("date", "store_nbr", "item_nbr", "line").limit(17).collect()]
    assert sorted(got) == sorted(want)
