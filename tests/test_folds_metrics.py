"""CV-1, CV-2, AGG-7, AGG-8 and AGG-10."""

from __future__ import annotations

import math
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfline.operators.folds import build_rolling_windows, collect_folds, embargo_days, feasibility
from shelfline.operators.metrics import aggregate_fold_scores, evaluate_metrics, to_long
from shelfline.operators.profile import check_features, feature_catalogue
from tests.helpers import DAY0, day


def dates(spark, n):
    return spark.createDataFrame([(day(i),) for i in range(n)], "date date")


def test_folds(spark):
    folds = collect_folds(build_rolling_windows(dates(spark, 500), 3, 14, 14, embargo_days(84, 14), 365))
    assert [f.fold for f in folds] == [0, 1]  # the third would train on 361 dates only
    first = folds[0]
    assert (first.train_start, first.train_end) == (day(0), day(500 - 14 - 97 - 1))
    assert (first.val_start, first.val_end) == (day(486), day(499))
    assert collect_folds(build_rolling_windows(dates(spark, 100), 3, 14, 14, 97, 365)) == []
    assert tuple(feasibility(dates(spark, 476), 14, 97, 365).first()) == (476, 476, True)
    assert feasibility(dates(spark, 475), 14, 97, 365).first()["feasible"] is False


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    n=st.integers(5, 60), windows=st.integers(0, 5), val=st.integers(1, 8), stride=st.integers(1, 9),
    embargo=st.integers(0, 10), least=st.integers(1, 20),
)
def test_folds_by_counting(spark, n, windows, val, stride, embargo, least):
    want = []
    for i in range(windows):
        end = n - i * stride
        start = end - val
        train_end = start - embargo
        if train_end < least:
            break
        want.append((i, day(0), day(train_end - 1), day(start), day(end - 1)))
    folds = collect_folds(build_rolling_windows(dates(spark, n), windows, val, stride, embargo, least))
    assert [(f.fold, f.train_start, f.train_end, f.val_start, f.val_end) for f in folds] == want
    for f in folds:
        assert f.train_end + timedelta(days=embargo) < f.val_start
        assert f.train_start == DAY0


def test_metrics(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1.0, 2.0), (0, 3.0, 1.0), (0, None, 1.0), (0, nan, 1.0), (0, 1.0, inf), (1, 0.0, 0.0), (2, None, None)]
    df = spark.createDataFrame(rows, "fold int, y double, yhat double")
    got = {r["fold"]: r for r in evaluate_metrics(df, metrics=["rmse", "WMAPE", "MAE"], by=["fold"]).collect()}
    assert got[0]["RMSE"] == pytest.approx(math.sqrt(2.5))
    assert got[0]["WMAPE"] == pytest.approx(3 / (4 + 1e-8))
    assert (got[1]["RMSE"], got[1]["WMAPE"]) == (0.0, 0.0)
    assert 2 not in got
    empty = evaluate_metrics(df.where("fold = 2")).first()
    assert (empty["RMSE"], empty["WMAPE"]) == (None, None)


def test_fold_summary(spark):
    scores = spark.createDataFrame([(0, 1.0, 0.5), (1, 3.0, None), (2, float("nan"), 0.7)], "fold int, RMSE double, WMAPE double")
    got = {r["metric"]: (r["mean"], r["std"]) for r in aggregate_fold_scores(to_long(scores)).collect()}
    assert got["RMSE"] == (2.0, 1.0)
    assert got["WMAPE"] == pytest.approx((0.6, 0.1))
    assert aggregate_fold_scores(to_long(scores.limit(0))).collect() == []


def test_profile(spark):
    rows = [(1, "a", None, True, 2.0), (2, "b", None, True, 4.0), (3, None, None, True, None), (4, "a", None, True, 6.0)]
    df = spark.createDataFrame(rows, "id int, city string, empty int, flag boolean, unit_sales double")
    got = {(r["section"], r["name"]): r["value"] for r in check_features(df, "unit_sales", topk=2).collect()}
    assert got["shape", "rows"] == 4 and got["shape", "columns"] == 5
    assert got["dtype", "int"] == 2
    assert {n for s, n in got if s == "constant"} == {"empty", "flag"}
    assert {n: v for (s, n), v in got.items() if s == "null_ratio"} == {"empty": 1.0, "city": 0.25}
    assert got["cardinality", "city"] == 3  # missing counts as a value
    assert (got["target", "count"], got["target", "nulls"], got["target", "mean"], got["target", "std"]) == (3, 1, 4, 2)
    catalogue = feature_catalogue(df).orderBy("position").collect()
    assert [(r["name"], r["type"]) for r in catalogue][:2] == [("id", "int"), ("city", "string")]
