"""Growing ensembles, label codes, sweeps side by side, and runs that go on after a stop."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfline.config import LIGHT_FEATURES, BacktestConfig, CrossValidation, Model, Sweep
from shelfline.operators.folds import Fold
from shelfline.operators.slicing import slice_by_date
from shelfline.plans import boosting, packed
from shelfline.plans.backtest import run_backtest
from shelfline.plans.learners import BoostedTrees, FittedSeason, SeasonalNaive
from shelfline.plans.model import fit_trees, label_index, tree_inputs
from shelfline.plans.sweep import SEARCH_SPACES, STARTUP_TRIALS, ScoreTable, run_sweep, should_prune, suggest_params, trial_states
from shelfline.session import discard, written
from shelfline.sources.sinks import RunRecords
from tests.helpers import day


def model_rows(spark, n=2000):
    rng = random.Random(1)
    rows = [(rng.random() * 10, rng.random() * 5, float(rng.randint(0, 3)), rng.gauss(0, 4), i % 4 == 0) for i in range(n)]
    df = spark.createDataFrame([(a, b, c, a * b + 3 * c + e, check) for a, b, c, e, check in rows], "a double, b double, c double, _y double, _is_val boolean")
    assembled = VectorAssembler(inputCols=["a", "b", "c"], outputCol=boosting.FEATURES).transform(df)
    return assembled.select(boosting.FEATURES, boosting.LABEL, boosting.CHECK).coalesce(1)


@pytest.mark.parametrize(("share", "subset", "block"), [(1.0, "all", 16), (0.8, "0.7", 3)])
def test_growing_gives_the_trees_of_one_fit(spark, monkeypatch, share, subset, block):
    monkeypatch.setattr(boosting, "BLOCK", block)
    rows = model_rows(spark).cache()
    params = {"maxDepth": 3, "subsamplingRate": share, "featureSubsetStrategy": subset, "seed": 5}
    grown, errors = boosting.grow(rows, params, 8, 0.2, 1000)
    once = GBTRegressor(featuresCol=boosting.FEATURES, labelCol=boosting.LABEL, maxIter=8, stepSize=0.2, **params).fit(rows.where(~F.col(boosting.CHECK)))
    want = once.evaluateEachIteration(rows.where(boosting.CHECK), "squared")
    assert errors == pytest.approx(want, rel=1e-9)
    best = boosting.best_iteration(want, 1000)
    assert len(grown.trees) == best and grown.treeWeights == once.treeWeights[:best]
    if best == 8:
        assert grown.featureImportances.toArray() == pytest.approx(once.featureImportances.toArray())


def test_nothing_is_stored_after_the_last_block(spark, monkeypatch):
    """What no later tree reads is not written: rows that are stored already, and forecasts of the last block."""
    stored = []
    monkeypatch.setattr(boosting, "written", lambda df, label: stored.append(label) or written(df, label))
    rows = written(model_rows(spark, 200), "rows")
    monkeypatch.setattr(boosting, "BLOCK", 2)
    boosting.grow(rows, {"maxDepth": 2, "seed": 1}, 2, 0.5, 100)
    assert stored == []
    boosting.grow(rows, {"maxDepth": 2, "seed": 1}, 3, 0.5, 100)
    assert stored == ["boost"] and rows.count() == 200


def test_no_tree_is_fitted_after_patience_ends(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 2)
    fitted = []
    real = boosting.RandomForestRegressor

    def counted(**kwargs):
        fitted.append(kwargs["seed"])
        return real(**kwargs)

    monkeypatch.setattr(boosting, "RandomForestRegressor", counted)
    rows = model_rows(spark, 200)
    noise = rows.withColumn(boosting.LABEL, F.when(F.col(boosting.CHECK), F.lit(0.0)).otherwise(F.col(boosting.LABEL)))
    model, errors = boosting.grow(noise, {"maxDepth": 5, "seed": 1}, 50, 0.5, 3)
    assert len(fitted) == len(set(fitted)) == len(errors) < 50
    assert len(model.trees) == boosting.best_iteration(errors, 3)


def plain_rows(spark, n=3000):
    """Numbers, gaps and texts; whole targets, so that sums are exact, and no two inputs that part the rows alike."""
    rng = random.Random(6)
    rows = []
    for i in range(n):
        a, b, gap, text = rng.random() * 10, rng.choice([0.0, 0.0, 1.5, -2.0]), rng.choice([None, 0.0, 3.0, 4.0]), rng.choice(["u", "v", "w", "x", None])
        rows.append((day(i % 9), a, b, gap, text, float(round(a * (b + 2) + 5 * (text == "v") + (gap or 0) + rng.gauss(0, 2))), i % 4))
    return spark.createDataFrame(rows, "date date, a double, b double, gap double, text string, y double, k int").coalesce(1)


@pytest.mark.parametrize(("params", "block"), [({"maxDepth": 4}, 16), ({"maxDepth": 5, "featureSubsetStrategy": "0.6", "minInstancesPerNode": 20}, 2), ({"maxDepth": 0}, 16)])
def test_packed_rows_give_the_trees_of_spark(spark, monkeypatch, params, block):
    monkeypatch.setattr(boosting, "BLOCK", block)
    df = plain_rows(spark)
    inputs = tree_inputs(df.where("k > 0").drop("k"), df.where("k = 0").drop("k"), "y")
    params = {"seed": 5, "maxBins": 32, **params}
    grown, errors = packed.grow(inputs.packs(32, 5), params, 5, 0.2, 1000)
    want, wanted = boosting.grow(inputs.rows, params, 5, 0.2, 1000)
    assert errors == pytest.approx(wanted, rel=1e-9) and grown.treeWeights == want.treeWeights
    assert [t.numNodes for t in grown.trees] == [t.numNodes for t in want.trees]
    assert grown.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())
    predictions = [[r[0] for r in m.transform(inputs.rows).select("prediction").collect()] for m in (grown, want)]
    assert predictions[0] == pytest.approx(predictions[1])


def test_fits_share_packs_and_spark_cuts_no_rows_anew(spark, monkeypatch):
    """Fits of one fold read one set of packs; before, each tree of each fit cut all rows into bins again."""

    def refused(**kwargs):
        raise AssertionError("rows are cut into bins anew")

    monkeypatch.setattr(boosting, "RandomForestRegressor", refused)
    made = []
    real = packed.pack
    monkeypatch.setattr("shelfline.plans.model.pack", lambda *a: made.append(1) or real(*a))
    monkeypatch.setattr("shelfline.plans.model.SMALL_ROWS", 100)
    df = plain_rows(spark, 400)
    inputs = tree_inputs(df.where("k > 0").drop("k"), df.where("k = 0").drop("k"), "y")
    params = {"n_estimators": 2, "max_depth": 2, "random_state": 7}
    for extra in ({}, {"feature_fraction": 0.7, "min_data_in_leaf": 30, "min_info_gain": 0.1}):
        model = fit_trees(inputs, Model(params={**params, **extra}))
        assert model.transform(df).where("prediction IS NULL").count() == 0
    assert made == [1]
    # Fewer rows than that, and trees that sample rows, are left to Spark.
    few = tree_inputs(df.where("k > 0").limit(100).drop("k"), df.where("k = 0").drop("k"), "y")
    for given, extra in ((few, {}), (inputs, {"subsample": 0.5})):
        with pytest.raises(AssertionError, match="cut into bins anew"):
            fit_trees(given, Model(params={**params, **extra}))


def test_patience_ends_growth_on_packs(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 2)
    df = plain_rows(spark, 200)
    noise = df.where("k = 0").withColumn("y", F.lit(0.0))
    inputs = tree_inputs(df.where("k > 0").drop("k"), noise.drop("k"), "y")
    model, errors = packed.grow(inputs.packs(32, 1), {"maxDepth": 3, "seed": 1}, 50, 0.5, 3)
    assert len(errors) < 50 and len(model.trees) == boosting.best_iteration(errors, 3)
    alone = tree_inputs(df.drop("k"), df.limit(0).drop("k"), "y")
    model, errors = packed.grow(alone.packs(32, 1), {"maxDepth": 2, "seed": 1}, 3, 0.5, 1)
    assert errors == [] and len(model.trees) == 3


def test_bins_by_cells_are_those_of_a_search():
    rng = np.random.default_rng(2)
    for values in (rng.exponential(50, 5000), rng.integers(0, 300, 5000).astype(float), rng.normal(size=5000) ** 9, np.array([0.0, 5e-324, 1.0])):
        cut = packed.thresholds_of(values, 64)
        probe = np.concatenate([values, cut, [-1e300, 1e300, values.min() - 1, values.max() + 1]])
        assert (packed.bins_of(probe, cut, packed._grid(cut)) == np.searchsorted(cut, probe, side="left")).all()


def test_inputs_that_are_not_numbers_are_refused(spark):
    df = plain_rows(spark, 40)
    for odd in (float("nan"), float("inf")):
        bad = df.withColumn("a", F.when(F.col("k") == 1, F.lit(odd)).otherwise(F.col("a")))
        with pytest.raises(Exception, match="NaN or an infinite value"):
            tree_inputs(bad.where("k > 0").drop("k"), bad.where("k = 0").drop("k"), "y").packs(32, 1)


def test_labels_beyond_the_bound_share_categories(spark):
    """200,000 labels: the driver sees the most frequent ones alone, all others are dealt by hash."""
    many = spark.range(200_000).select(
        F.lit(day(0)).alias("date"),
        F.when(F.col("id") % 4 == 0, "it's").when(F.col("id") % 7 == 0, "b\\n").otherwise(F.concat(F.lit("label "), "id")).alias("family"),
        (F.col("id") % 9).cast("double").alias("unit_sales"),
    )
    assert label_index(many, ["family"], 3)["family"][:2] == ["it's", "b\\n"]
    inputs = tree_inputs(many, many.where("unit_sales = 1"), "unit_sales", most_labels=3, bins=4)
    assert inputs.categories == 3 + 4 + 1
    odd = spark.createDataFrame([(day(0), x, 1.0) for x in ("it's", "b\\n", "label 1", "never seen", None, "#1")], "date date, family string, unit_sales double")
    codes = [r["_x_family"] for r in PipelineModel(inputs.stages).transform(odd).collect()]
    assert codes[:2] == [0.0, 1.0] and codes[4] == 7.0 and 3 <= codes[3] < 7
    assert all(2 <= c < 7 for c in (codes[2], codes[5]))
    few = tree_inputs(odd, odd.limit(0), "unit_sales", most_labels=10, bins=4)
    unseen = PipelineModel(few.stages).transform(odd.withColumn("family", F.lit("new"))).first()
    assert few.categories == 6 and unseen["_x_family"] == 5.0


def test_search_spaces():
    assert set(SEARCH_SPACES["xgboost"]) == {"colsample_bytree", "min_info_gain", "min_child_weight"}
    point = suggest_params(random.Random(2), "xgboost")
    assert 0.4 <= point["colsample_bytree"] <= 1 and 1 <= point["min_child_weight"] <= 20
    assert BoostedTrees(Model(framework="XGBoost")).space == "xgboost"
    with pytest.raises(ValueError):
        BoostedTrees(Model(framework="forest"))


def sales(spark, n=120):
    rng = random.Random(4)
    rows = [(day(i), s, it, 10.0 * s + i % 7 + rng.random(), rng.choice([True, False, None])) for i in range(n) for s in (1, 2) for it in (10, 11)]
    return spark.createDataFrame(rows, "date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean")


def test_seasonal_learner(spark, tmp_path):
    rows = sales(spark, 30)
    learner = SeasonalNaive().tuned({"smoothing": 5.0})
    fitted = learner.fit(learner.prepare(rows, rows, "unit_sales"))
    later = spark.createDataFrame([(day(0), 1.0), (day(200), 1.0)], "date date, unit_sales double")
    got = [r["prediction"] for r in fitted.predict(later).orderBy("date").collect()]
    known = [(r["date"].isocalendar().week, r["unit_sales"]) for r in rows.collect()]
    mean = sum(x for _, x in known) / len(known)
    week = [x for w, x in known if w == day(0).isocalendar().week]
    assert got == pytest.approx([(sum(week) + 5 * mean) / (len(week) + 5), mean])
    fitted.save(str(tmp_path / "season"))
    assert [r["prediction"] for r in FittedSeason.load(spark, str(tmp_path / "season")).predict(later).orderBy("date").collect()] == pytest.approx(got)
    empty = SeasonalNaive()
    assert empty.fit(empty.prepare(rows.limit(0), rows, "unit_sales")).predict(later).where("prediction IS NULL").count() == 2


class Fixed:
    """A learner whose score on a fold is known: its error is its parameter times the fold's weight."""

    params: dict = {}
    space = "seasonal"

    def __init__(self, log, smoothing=0.0):
        self.log, self.smoothing = log, smoothing

    def prepare(self, train, val, target_col):
        return val.count()

    def fit(self, prepared):
        self.log.append((self.smoothing, prepared))
        return self

    def tuned(self, params):
        return Fixed(self.log, params["smoothing"])

    def predict(self, rows):
        return rows.withColumn("prediction", F.col("unit_sales") + F.lit(float(self.smoothing)))


FOLDS = [Fold(i, day(0), day(40 - i), day(50), day(60 + i)) for i in range(3)]


def by_hand(points, n_folds):
    finished, states = [], []
    for p in points:
        seen = []
        for _ in range(n_folds):
            seen.append(p)
            if should_prune(seen, finished):
                states.append("PRUNED")
                break
        else:
            states.append("COMPLETE")
            finished.append(seen)
    return states


@pytest.mark.parametrize("parallel", [1, 6])
def test_sweep_side_by_side_decides_as_one_after_the_other(spark, tmp_path, parallel):
    rows = sales(spark)
    build = lambda f: (slice_by_date(rows, f.train_range), slice_by_date(rows, f.val_range))
    draw = random.Random(3)
    points = [suggest_params(draw, "seasonal")["smoothing"] for _ in range(10)]
    log: list = []
    store = str(tmp_path / "scores")
    sweep = Sweep(enabled=True, n_trials=10, seed=3, parallel=parallel)
    result = run_sweep(spark, FOLDS, build, Fixed(log), sweep, store=store)
    states = [r["state"] for r in result.trials.orderBy("number").collect()]
    assert states == by_hand(points, 3) and "PRUNED" in states
    assert result.cv_mean == pytest.approx(min(points)) and result.best_tuned_only == {"smoothing": min(points)}
    derived = {r["number"]: (r["state"], r["value"]) for r in trial_states(result.scores).collect()}
    assert [derived[n][0] for n in range(10)] == states
    assert all((v is None) == (s == "PRUNED") for s, v in derived.values())
    # Started again it reads its scores and fits nothing; with one score lost it fits that one.
    log.clear()
    again = run_sweep(spark, FOLDS, build, Fixed(log), sweep, store=store)
    assert log == [] and again.cv_mean == result.cv_mean
    os.rename(os.path.join(store, "trial=2", "fold=1"), os.path.join(str(tmp_path), "lost"))
    again = run_sweep(spark, FOLDS, build, Fixed(log), sweep, store=store)
    assert [s for s, _ in log] == [points[2]]
    assert [r["state"] for r in again.trials.orderBy("number").collect()] == states


def test_a_failing_trial_ends_the_sweep(spark):
    rows = sales(spark)
    build = lambda f: (slice_by_date(rows, f.train_range), slice_by_date(rows, f.val_range))

    class Broken(Fixed):
        def tuned(self, params):
            return Broken(self.log, params["smoothing"])

        def predict(self, rows):
            raise ValueError("no forecast")

    with pytest.raises(ValueError, match="no forecast"):
        run_sweep(spark, FOLDS, build, Broken([]), Sweep(n_trials=STARTUP_TRIALS))


def test_scores_are_stored_once(spark, tmp_path):
    table = ScoreTable(spark, str(tmp_path / "scores"))
    assert table.known() == {}
    for _ in range(2):
        table.add(0, 1, 2.5)
    assert table.known() == {(0, 1): 2.5}


def test_published_records_are_written_once(spark, tmp_path):
    records = RunRecords(spark, str(tmp_path), "r1")
    frame = spark.createDataFrame([(1, 2.0)], "fold int, RMSE double")
    assert not records.has("fold_scores", 1) and records.parts("fold_scores", "fold int, RMSE double").count() == 0
    for _ in range(2):
        records.fold_scores(frame, 1)
    records.fold_scores(frame.withColumn("fold", F.lit(2)), 2)
    assert records.read("fold_scores").count() == 2 and records.has("fold_scores", 2)
    with pytest.raises(Exception, match="broken"):
        records.fold_scores(frame.withColumn("RMSE", F.raise_error(F.lit("broken")).cast("double")), 2)
    assert records.read("fold_scores").count() == 2
    assert RunRecords(spark, str(tmp_path), "r2").parts("fold_scores", "fold int").count() == 0


def test_a_run_that_broke_off_goes_on(spark, tmp_path):
    """Stopped in the third fold, it does not fit the first two again, and its records are those of a run without a stop."""
    tables = {
        "train": sales(spark, 160),
        "items": spark.createDataFrame([(10, "A", 1), (11, "B", 2)], "item_nbr int, family string, class int"),
        "stores": spark.createDataFrame([(1, "Q", "P"), (2, "C", "A")], "store_nbr int, city string, state string"),
        "oil": spark.createDataFrame([(day(i), 50.0 + i) for i in range(160)], "date date, dcoilwtico double"),
        "holidays_events": spark.createDataFrame(
            [(day(10), "Holiday", "National", "E", "Fiesta", False)], "date date, type string, locale string, locale_name string, description string, transferred boolean"
        ),
    }
    cv = CrossValidation(stride_days=14, min_train_days=40, val_days=14, n_windows=3, max_lag=14, max_window=7)

    class Stops(SeasonalNaive):
        fits: list = []
        stop_at = 99

        def fit(self, prepared):
            Stops.fits.append(1)
            if len(Stops.fits) == Stops.stop_at:
                raise KeyboardInterrupt("stopped")
            return super().fit(prepared)

    def config(name):
        return BacktestConfig(output_dir=str(tmp_path / name), cv=cv, features=LIGHT_FEATURES)

    whole = run_backtest(spark, config("whole"), tables, Stops(), "one")
    assert len(whole.folds) == 3 and len(Stops.fits) == 3
    Stops.fits.clear()
    Stops.stop_at = 3
    with pytest.raises(KeyboardInterrupt):
        run_backtest(spark, config("broken"), tables, Stops(), "one")
    Stops.fits.clear()
    Stops.stop_at = 99
    resumed = run_backtest(spark, config("broken"), tables, Stops(), "one")
    assert len(Stops.fits) == 1
    for name in ("fold_scores", "cv_summary", "importance", "catalogue", "config"):
        a, b = (RunRecords(spark, str(tmp_path / where / "records"), "one").read(name) for where in ("whole", "broken"))
        if name != "config":
            assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())), name
        assert a.count() == b.count()
    assert sorted(map(tuple, resumed.fold_scores.collect())) == sorted(map(tuple, whole.fold_scores.collect()))


def test_discard_removes_own_tables_alone(spark, tmp_path):
    own = written(spark.range(3), "own")
    path = own.inputFiles()[0].removeprefix("file:")
    discard(own)
    assert not os.path.exists(path)
    spark.range(3).write.parquet(str(tmp_path / "other"))
    other = spark.read.parquet(str(tmp_path / "other"))
    discard(other)
    assert other.count() == 3
