"""SRC, SNK, ML, CV-3 and FLOW-3."""

from __future__ import annotations

import dataclasses
import json
import random
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.config import LIGHT_FEATURES, BacktestConfig, Columns, CrossValidation, Features, Model, Sweep, fingerprint
from shelfline.operators.enrich import create_extend_train
from shelfline.operators.folds import Fold
from shelfline.plans.backtest import prepare, run_backtest, store_prepared
from shelfline.plans.features import make_features, slice_features
from shelfline.plans.fold_features import FoldFeatures
from shelfline.plans.boosting import best_iteration
from shelfline.plans.model import feature_importance, merge_params, model_inputs, predict, spark_params, train_model
from shelfline.plans.sweep import SEARCH_SPACE, run_sweep, should_prune, suggest_params
from shelfline.sources.sinks import FoldCache, RunRecords, load_model, save_features, save_model
from shelfline.sources.tables import load_tables
from tests.helpers import column, day

KEYS = ["store_nbr", "item_nbr"]


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two years of a small shop as CSV files."""
    root = tmp_path_factory.mktemp("shop")
    rng = random.Random(1)
    lines = ["id,date,store_nbr,item_nbr,unit_sales,onpromotion"]
    n = 0
    for i in range(140):
        for s in (1, 2):
            for it in (10, 11):
                promo = rng.choice(["True", "False", "False", ""])
                sales = 10 * s + (8 if promo == "True" else 0) + i % 7 + rng.random()
                lines.append(f"{n},{day(i)},{s},{it},{sales:.3f},{promo}")
                n += 1
    write(root / "train.csv", "\n".join(lines))
    write(root / "items.csv", "item_nbr,family,class,perishable\n10,BREAD,3,1\n10,CAKE,4,0\n11,MILK,5,0\n")
    write(root / "stores.csv", "store_nbr,city,state,type,cluster\n1,Quito,Pichincha,A,1\n2,Cuenca,Azuay,B,2\n")
    oil = ["date,dcoilwtico"] + [f"{day(i)},{'' if i % 9 == 0 else 50 + i % 13}" for i in range(140) if i % 7 < 5]
    write(root / "oil.csv", "\n".join(oil))
    write(
        root / "holidays_events.csv",
        "date,type,locale,locale_name,description,transferred\n"
        f"{day(10)},Holiday,National,Ecuador,Fiesta,False\n{day(20)},Event,Local,Quito,Feria,False\n",
    )
    write(root / "notes.txt", "not a table")
    return root


def test_load_folder_list_dict_file(spark, folder):
    tables = load_tables(spark, str(folder))
    assert sorted(tables) == ["holidays_events", "items", "oil", "stores", "train"]
    train = tables["train"]
    assert dict(train.dtypes) == {
        "id": "bigint", "date": "date", "store_nbr": "int", "item_nbr": "int", "unit_sales": "double", "onpromotion": "boolean",
    }
    assert train.where("onpromotion IS NULL").count() > 0
    assert dict(tables["items"].dtypes)["perishable"] == "int"
    assert tables["oil"].where("dcoilwtico IS NULL").count() > 0
    assert list(load_tables(spark, [str(folder / "oil.csv")])) == ["oil"]
    assert list(load_tables(spark, {"price": str(folder / "oil.csv")})) == ["price"]
    assert list(load_tables(spark, str(folder / "oil.csv"))) == ["oil"]
    for wrong in ("/nowhere", 5):
        with pytest.raises(ValueError):
            load_tables(spark, wrong)


def test_unreadable_table(spark, folder):
    paths = {"oil": str(folder / "oil.csv"), "gone": str(folder / "gone.csv")}
    with pytest.raises(AnalysisException):
        load_tables(spark, paths)
    assert load_tables(spark, paths, on_error="skip")["gone"] is None


def test_file_order_decides_the_first_row(spark, tmp_path):
    body = "\n".join(f"{i % 50},F{i:05d},{i}" for i in random.Random(2).sample(range(5000), 5000))
    path = write(tmp_path / "items.csv", "item_nbr,family,class\n" + body + "\n")
    first = {}
    for line in body.split("\n"):
        item, family, _ = line.split(",")
        first.setdefault(int(item), family)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")  # many splits of one file
    try:
        items = load_tables(spark, [path], keep_row_order=True)["items"]
        assert items.rdd.getNumPartitions() > 5
        train = spark.createDataFrame([(day(0), 1, i, 1.0) for i in range(50)], "date date, store_nbr int, item_nbr int, unit_sales double")
        stores = spark.createDataFrame([(1, "a", "b")], "store_nbr int, city string, state string")
        out = create_extend_train(train, items, stores)
        assert {r["item_nbr"]: r["family"] for r in out.collect()} == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def sample(spark, n=60, stores=2):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        for s in range(1, stores + 1):
            promo = rng.choice([True, False, None])
            rows.append((day(i), s, 1, 10.0 * s + (5 if promo else 0) + i % 7, promo, "ABC"[i % 3]))
    return spark.createDataFrame(rows, "date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean, family string")


def test_feature_columns_in_order(spark):
    out = make_features(sample(spark), group_cols=KEYS)
    assert out.columns[:6] == ["date", *KEYS, "unit_sales", "onpromotion", "family"]
    assert out.columns[6] == "day_in_the_month" and out.columns[17] == "days_since_start"
    assert out.columns[18:24] == ["week_of_year", "seasonal_idx_w", "month_of_year", "seasonal_idx_m", "regular_coeff_w", "regular_coeff_m"]
    assert out.columns[24:28] == ["days_since_last_promo", "days_until_next_promo", "promo_streak", "promo_in_next_7days"]
    assert len(out.columns) == 28 + 3 + 15 + 5
    assert out.count() == sample(spark).count()
    with pytest.warns(UserWarning):
        make_features(sample(spark), group_cols=["store_nbr", "shop"])


def test_slice_sees_only_itself_unless_given_context(spark):
    df = sample(spark)
    dates = (day(40), day(53))
    alone = slice_features(df, dates, LIGHT_FEATURES, "unit_sales", KEYS).where("store_nbr = 1")
    assert column(alone, "unit_sales_lag_14") == [None] * 14
    assert column(alone, "days_since_start") == list(range(14))
    seeing = slice_features(df, dates, dataclasses.replace(LIGHT_FEATURES, context_days=30), "unit_sales", KEYS).where("store_nbr = 1")
    history = column(df.where("store_nbr = 1"), "unit_sales")
    assert column(seeing, "unit_sales_lag_14") == history[26:40]
    for name in ("days_since_start", "seasonal_idx_w", "seasonal_idx_m", "days_until_next_promo"):
        assert column(seeing, name) == column(alone, name)


@pytest.mark.parametrize("rows_per_group", ["daily", "check"])
def test_shared_fold_features_equal_those_of_each_slice(spark, tmp_path, rows_per_group):
    df = sample(spark, 90)
    folds = [Fold(i, day(0), day(end), day(end + 5), day(end + 14)) for i, end in enumerate((70, 63, 41))]
    settings = Features(lags=(1, 7), windows=(3,), rolling_stats=("mean", "std"), exp_stats=("sum",))
    shared = FoldFeatures(spark, str(tmp_path / "folds"), df, folds, settings, Columns(), rows_per_group)
    assert shared.shared
    for f in folds:
        for got, dates in zip(shared.build(f), (f.train_range, f.val_range), strict=True):
            want = slice_features(df, dates, settings, "unit_sales", KEYS, rows_per_group)
            assert got.columns == want.columns
            assert got.dtypes == want.dtypes
            order = ["date", "store_nbr"]
            for a, b in zip(got.orderBy(*order).collect(), want.orderBy(*order).collect(), strict=True):
                for name in got.columns:
                    same = a[name] == pytest.approx(b[name]) if isinstance(a[name], float) else a[name] == b[name]
                    assert same, (f.fold, a["date"], name, a[name], b[name])


def test_bucketed_table_needs_no_shuffle(spark, tmp_path):
    cfg = BacktestConfig(series_buckets=4)
    stored = store_prepared(sample(spark), str(tmp_path / "prepared"), cfg, "test")
    out = make_features(stored, group_cols=KEYS, rows_per_group="daily")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(store_nbr" not in plan
    assert out.count() == sample(spark).count()
    spark.sql("DROP TABLE shelfline_prepared_test")


def test_model_inputs(spark):
    df = sample(spark, 2).withColumn("at", F.current_timestamp())
    assert model_inputs(df, "unit_sales") == (["store_nbr", "item_nbr", "onpromotion"], ["family"])


def test_parameters_are_mapped():
    got = spark_params({"n_estimators": 7, "learning_rate": 0.1, "num_leaves": 31, "colsample_bytree": 0.8, "random_state": 3})
    assert got == {"maxIter": 7, "stepSize": 0.1, "maxDepth": 5, "featureSubsetStrategy": "0.8", "seed": 3}
    with pytest.warns(UserWarning):
        spark_params({"lambda_l1": 1.0})
    base = {"a": 1}
    assert merge_params(base, {"b": 2}) == {"a": 1, "b": 2} and base == {"a": 1}


MODEL = Model(params={"n_estimators": 8, "learning_rate": 0.3, "max_depth": 3, "random_state": 1})


def test_model_beats_the_mean_and_repeats(spark, tmp_path):
    df = make_features(sample(spark, 90), lags=[7], windows=[7], rolling_stats=["mean"], exp_stats=[], group_cols=KEYS)
    train, val = df.where(F.col("date") < day(70)).cache(), df.where(F.col("date") >= day(70)).cache()
    val = val.withColumn("family", F.when(F.col("family") == "A", "unseen").otherwise(F.col("family")))
    model = train_model(train, val, "unit_sales", MODEL)
    out = predict(model, val)
    assert out.columns == [*val.columns, "prediction"]
    mean = train.agg(F.avg("unit_sales")).first()[0]
    errors = out.agg(
        F.avg((F.col("unit_sales") - F.col("prediction")) ** 2), F.avg((F.col("unit_sales") - F.lit(mean)) ** 2)
    ).first()
    assert errors[0] < 0.5 * errors[1]
    again = train_model(train, val, "unit_sales", MODEL)
    assert column(predict(again, val), "prediction", ("date", "store_nbr")) == column(out, "prediction", ("date", "store_nbr"))
    save_model(model, str(tmp_path / "model"))
    loaded = predict(load_model(str(tmp_path / "model")), val)
    assert column(loaded, "prediction", ("date", "store_nbr")) == column(out, "prediction", ("date", "store_nbr"))
    weights = feature_importance(model)
    assert sum(w for _, w in weights) == pytest.approx(1.0)
    assert [w for _, w in weights] == sorted((w for _, w in weights), reverse=True)
    with pytest.raises(ValueError):
        train_model(train, val, "unit_sales", Model(framework="forest"))


def test_pruning_rule():
    finished = [[1.0, 2.0], [2.0, 2.0], [3.0, 3.0], [4.0, 4.0]]
    assert not should_prune([9.0], finished)  # too few complete trials
    finished.append([5.0, 5.0])
    assert should_prune([3.5], finished)
    assert not should_prune([3.0], finished)
    assert not should_prune([2.5, 9.0], finished)  # its best step counts


def test_suggestions_stay_in_their_space():
    draw = random.Random(0)
    for _ in range(50):
        point = suggest_params(draw)
        assert all(SEARCH_SPACE[k][0] <= v <= SEARCH_SPACE[k][1] for k, v in point.items())
    assert suggest_params(random.Random(1)) == suggest_params(random.Random(1))


def fold(i=0):
    return Fold(i, day(0), day(39), day(45), day(58))


def test_sweep_and_cache(spark, tmp_path):
    df = sample(spark)
    built = []

    def build(f):
        built.append(f.fold)
        return tuple(slice_features(df, d, LIGHT_FEATURES, "unit_sales", KEYS) for d in (f.train_range, f.val_range))

    cache = FoldCache(spark, str(tmp_path / "folds"), Features())
    base = Model(params={"n_estimators": 2, "max_depth": 2, "random_state": 1})
    result = run_sweep(spark, [fold()], build, base, Sweep(n_trials=2, metric="wmape"), cache)
    assert built == [0]
    rows = result.trials.orderBy("number").collect()
    assert [r["state"] for r in rows] == ["COMPLETE", "COMPLETE"]
    assert result.cv_mean == min(r["value"] for r in rows) == result.cv_by_fold.first()["score"]
    assert result.best_model_params == {**base.params, **result.best_tuned_only}
    train, val = cache.load_or_build(fold(), build)
    assert built == [0] and val.count() == 28 and "split" not in train.columns
    assert cache.path(fold()) != cache.path(dataclasses.replace(fold(), val_end=day(57)))
    assert cache.path(fold()) != FoldCache(spark, str(tmp_path / "folds"), Features(lags=(1,))).path(fold())
    with pytest.raises(ValueError):
        run_sweep(spark, [fold()], build, base, Sweep(metric="MAE"))
    assert fingerprint(Features()) == fingerprint(Features())


def test_records(spark, tmp_path):
    first, second = (RunRecords(spark, str(tmp_path), run) for run in ("a", "b"))
    first.config(BacktestConfig().as_json())
    second.config("{}")
    assert json.loads(first.read("config").first()["config"])["cv"]["stride_days"] == 14
    assert second.read("config").count() == 1
    stored = save_features(sample(spark, 3), str(tmp_path / "features"))
    assert stored.count() == 6
    first.catalogue(stored)
    assert first.read("catalogue").where("name = 'date'").first()["type"] == "date"


def test_values_that_do_not_convert(spark, tmp_path):
    path = write(tmp_path / "train.csv", "date,store_nbr,item_nbr,unit_sales,onpromotion,extra\n2017-01-01,1,10.0,1.5,1,2.5\n2017-01-02,1,11,NaN,0.0,3\n2017-01-03,2,,,True,4\n")
    rows = load_tables(spark, path)["train"].orderBy("date").collect()
    assert [r["item_nbr"] for r in rows] == [10, 11, None] and [r["onpromotion"] for r in rows] == [True, False, True]
    assert [r["unit_sales"] for r in rows] == [1.5, None, None] and [r["extra"] for r in rows] == [2.5, 3.0, 4.0]
    wrong = write(tmp_path / "items.csv", "item_nbr,family,class\n1,A,X12\n")
    with pytest.raises(Exception, match="column class: not a value of type int: X12"):
        load_tables(spark, wrong)["items"].collect()
    assert load_tables(spark, wrong, bad_values="null")["items"].first()["class"] is None
    other = write(tmp_path / "notes.csv", "class,id\nX12,A\n")
    assert load_tables(spark, other)["notes"].first().asDict() == {"class": "X12", "id": "A"}


def test_early_stopping_waits(spark):
    assert best_iteration([5, 4, 3, 3.5, 3.4, 2, 9, 9, 9], 3) == 6
    assert best_iteration([5, 4, 3, 3.5, 3.4, 3.3, 2], 3) == 3
    rng = random.Random(3)
    rows = [(day(k % 60), float(k % 7), (k % 7) * 3 + rng.gauss(0, 6)) for k in range(900)]
    df = spark.createDataFrame(rows, "date date, x double, unit_sales double")
    train, val = df.where("date < DATE'2017-02-10'"), df.where("date >= DATE'2017-02-10'")
    params = {"n_estimators": 40, "learning_rate": 0.05, "max_depth": 2, "subsample": 0.8, "random_state": 1, "early_stopping_rounds": 8}
    model = train_model(train, val, "unit_sales", Model(params=params))
    assert 9 < len(model.stages[-1].trees) <= 40
    assert spark_params({"colsample_bytree": 1}) == {"featureSubsetStrategy": "1.0"}


def test_own_promotions_table_brings_no_sales(spark, folder):
    tables = load_tables(spark, str(folder))
    sales = tables["train"]
    promos = sales.select("date", "store_nbr", "item_nbr", "unit_sales", (~F.col("onpromotion")).alias("onpromotion"))
    out = prepare({**tables, "promos": promos}, BacktestConfig())
    assert "promo_unit_sales" not in out.columns
    keys = ["date", "store_nbr", "item_nbr"]
    was = sales.select(*keys, F.col("onpromotion").alias("was"))
    assert out.join(was, keys).where("NOT (onpromotion <=> (NOT was))").count() == 0
    assert out.count() == sales.count()


def test_backtest_from_files(spark, folder, tmp_path):
    cfg = BacktestConfig(
        paths=str(folder),
        output_dir=str(tmp_path / "out"),
        cv=CrossValidation(stride_days=14, min_train_days=40, val_days=14, n_windows=2, max_lag=14, max_window=7),
        model=Model(params={"n_estimators": 3, "max_depth": 3, "random_state": 1}),
        features=LIGHT_FEATURES,
        sweep=Sweep(enabled=True, n_trials=1, windows_limit=1, apply_best=True),
    )
    result = run_backtest(spark, cfg)
    assert [f.fold for f in result.folds] == [0, 1]
    sales = load_tables(spark, str(folder))["train"]
    assert result.folds[0].val_end == sales.agg(F.max("date")).first()[0]
    scores = result.fold_scores.orderBy("fold").collect()
    assert len(scores) == 2 and all(0 < r["WMAPE"] < 1 for r in scores)
    assert {r["metric"] for r in result.cv_summary.collect()} == {"RMSE", "WMAPE"}
    assert result.feasibility.first()["feasible"] is True
    assert result.profile.where("section = 'shape' AND name = 'rows'").first()["value"] > 0
    assert set(result.next_config.model.params) > set(cfg.model.params)
    names = {r["feature"] for r in result.importance.collect()}
    assert {"oil_price", "is_holiday", "family", "unit_sales_lag_7"} <= names
    assert "promo_unit_sales" not in names and "unit_sales" not in names
    records = RunRecords(spark, str(tmp_path / "out" / "records"), result.run_id)
    for name in ("config", "fold_scores", "cv_summary", "catalogue", "importance", "trials", "best_by_fold", "best_params"):
        assert records.read(name).count() > 0, name
    assert load_model(str(tmp_path / "out" / "models" / result.run_id / "fold0")).stages
    prepared = spark.read.parquet(str(tmp_path / "out" / "prepared" / result.run_id))
    assert prepared.count() == sales.count()
    assert "_source_order" not in prepared.columns
    last_price = load_tables(spark, str(folder))["oil"].agg(F.max("date")).first()[0]
    assert prepared.where((F.col("date") <= F.lit(last_price)) & F.col("oil_price").isNull()).count() == 0
    assert prepared.where(F.col("date") == day(10)).agg(F.min("is_holiday")).first()[0] == 1
    assert isinstance(prepared.schema["date"].dataType, T.DateType)
    assert date(2017, 1, 1) == result.folds[0].train_start
