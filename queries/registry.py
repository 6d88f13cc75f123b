"""Every registered query: what it runs on Spark and, where SQL can say it, the same in SQL."""

from __future__ import annotations

import dataclasses
import functools
import os
import random
import uuid
import warnings
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries import oracles as sql
from queries import views as v
from shelfline.config import LIGHT_FEATURES, BacktestConfig, Columns, CrossValidation, Features, Model, Sweep
from shelfline.functions.calendar import (
    add_is_weekend,
    add_month_of_year,
    add_week_of_year,
    extract_date_features,
)
from shelfline.functions.promo import promo_flag
from shelfline.operators import holidays as hol
from shelfline.operators.enrich import create_extend_train, join_oil_promos
from shelfline.operators.fill import (
    check_missing_dates_full_range,
    fill_oil_pchip,
    fill_time_series_full_range,
    oil_review,
)
from shelfline.operators.folds import Fold, build_rolling_windows, collect_folds, embargo_days, feasibility, rows_of_folds
from shelfline.operators.metrics import aggregate_fold_scores, evaluate_metrics, to_long
from shelfline.operators.profile import check_features, profile_from_states, profile_states
from shelfline.operators.promotions import (
    add_days_since_last_promo,
    add_days_until_next_promo,
    add_promo_next_7days_flag,
    add_promo_streak,
    process_promotions,
)
from shelfline.operators.relational import aligned, attach_measured, keep_one, require_unique, resolve_group_cols
from shelfline.operators.seasonality import (
    add_regular_coeff_m,
    add_regular_coeff_w,
    add_seasonal_idx_m,
    add_seasonal_idx_w,
    create_seasonality_features,
)
from shelfline.operators.series import (
    STATS,
    add_series_features,
    expanding_feature,
    first_rows,
    lag_feature,
    make_expanding,
    make_lag,
    make_rolling,
    rolling_feature,
)
from shelfline.operators.slicing import date_bounds, drop_target_cols, plain_slice, slice_by_date, unique_dates
from shelfline.plans.backtest import BacktestResult, run_backtest
from shelfline.plans.feature_state import StatefulFeatures
from shelfline.plans.features import make_features, slice_features
from shelfline.plans.fold_features import FoldFeatures
from shelfline.plans.learners import FittedSeason, SeasonalNaive
from shelfline.plans.model import feature_importance, predict, train_model, tree_inputs
from shelfline.plans.sweep import STARTUP_TRIALS, run_sweep, suggest_params, trial_states
from shelfline.session import MAX_GROUP_ROWS, shared_folder, written
from shelfline.sources.sinks import RunRecords, importance_table, save_features
from shelfline.sources.tables import load_tables, read_tolerant

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEYS = ["store_nbr", "item_nbr"]
#: The sales view has one row per store, item and day: the calendar bounds the length of its series.
DAILY = {"group_cols": KEYS, "rows_per_group": "daily"}
CV = CrossValidation()
SLICE = ("1997-03-01", "1999-06-30")
YEARS = (1996, 2000)


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns: two engines add in different orders."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema]
    )


# --- Joins and deduplication ----------------------------------------------------------------------------------------


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return create_extend_train(v.sales(spark, d), v.items(spark, d), v.stores(spark, d), items_order=["p_partkey"])


@query(sql.ENRICH_SALES)
def enrich_sales(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-1, AGG-9: item and store columns, the first item row winning."""
    return enriched(spark, d)


@query(sql.ENRICHED_LAG)
def flagship(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-1, WIN-1, WIN-2: enriched sales with lag 7 and the mean of the seven rows before."""
    lagged = make_lag(enriched(spark, d), "unit_sales", [7], **DAILY)
    return rounded(make_rolling(lagged, "unit_sales", [1], [7], ["mean"], **DAILY))


@query(sql.KEEP_FIRST)
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    """AGG-9: first row per item."""
    return keep_one(v.items(spark, d), ["item_nbr"], keep="first", order_by=["p_partkey"])


@query(sql.KEEP_LAST)
def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    """AGG-9: last promotion row per date, store and item."""
    return keep_one(
        v.promos(spark, d), ["date", *KEYS], keep="last", order_by=["l_orderkey", "l_linenumber"]
    )


@query(sql.OIL_PROMO_JOIN)
def oil_promo_join(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-2 to JOIN-4: raw price, and promotions on the full key with a prefixed clash."""
    return join_oil_promos(
        v.sales(spark, d), v.oil(spark, d), v.promos(spark, d), promos_order=["l_orderkey", "l_linenumber"]
    )


@query(sql.OIL_PROMO_KEPT)
def oil_promo_join_keep(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-3, JOIN-4: promotions on (date, store), the own promotion state kept."""
    promos = v.promos(spark, d).drop("item_nbr", "unit_sales")
    return join_oil_promos(
        v.sales(spark, d), None, promos, overwrite_onpromotion=False, promos_order=["l_orderkey", "l_linenumber"]
    )


@query(sql.OIL_PROMO_BY_DATE)
def oil_promo_join_by_date(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-3 on the date alone; all columns of the promotions come along."""
    promos = v.promos(spark, d).drop("store_nbr", "item_nbr", "unit_sales")
    return join_oil_promos(v.sales(spark, d), None, promos, promos_order=["l_orderkey", "l_linenumber"])


@query(sql.HOLIDAY_PARSE)
def holiday_parse(spark: SparkSession, d: str) -> DataFrame:
    """STR-1 to STR-3: role, anchor, offset and key of every holiday row."""
    return hol.clean(v.holidays(spark, d)).select(
        "holiday_id", "date", "scope", "scope_name", "role", "anchor_label", "offset_days", "anchor_key"
    )


@query(sql.HOLIDAY_DIM)
def holiday_dim(spark: SparkSession, d: str) -> DataFrame:
    """MAP-1 to MAP-3, AGG-5, PRJ-5: the prepared holiday table."""
    return hol.preprocess(v.holidays(spark, d))


@query(sql.HOLIDAY_JOIN)
def holiday_join(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-5, JOIN-6, AGG-6: sales with the holiday features of three scopes."""
    return hol.merge_train(v.sales(spark, d), hol.preprocess(v.holidays(spark, d)), v.stores(spark, d))


# --- Calendar -------------------------------------------------------------------------------------------------------


@query(sql.CALENDAR)
def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    """DATE-1, DATE-5."""
    return extract_date_features(v.sales(spark, d))[0]


@query(sql.RANGE_CALENDAR)
def range_calendar(spark: SparkSession, d: str) -> DataFrame:
    """DATE-2 to DATE-4: calendar columns within a range."""
    df = v.sales(spark, d)
    for add in (add_week_of_year, add_month_of_year, add_is_weekend):
        df = add(df, *SLICE)
    return df


@query(sql.SLICE_DATES)
def slice_dates(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-1, PRJ-3: a date slice with its bounds the wrong way round, without the target."""
    return drop_target_cols(slice_by_date(v.sales(spark, d), SLICE[::-1]), "unit_sales")


@query(sql.DATE_BOUNDS)
def series_date_bounds(spark: SparkSession, d: str) -> DataFrame:
    """AGG-1."""
    return date_bounds(v.sales(spark, d))


@query(sql.DISTINCT_DATES)
def distinct_dates(spark: SparkSession, d: str) -> DataFrame:
    """AGG-2."""
    return unique_dates(v.sales(spark, d))


# --- Windows --------------------------------------------------------------------------------------------------------


@query(sql.LAGS)
def lag_features(spark: SparkSession, d: str) -> DataFrame:
    """WIN-1."""
    return make_lag(v.sales(spark, d), "unit_sales", [1, 7, 14, 28], **DAILY)


@query(sql.LAGS_UNGROUPED)
def lag_ungrouped(spark: SparkSession, d: str) -> DataFrame:
    """WIN-1 without group columns: one series of all rows, cut into chunks when it is long."""
    return make_lag(v.sales(spark, d), "unit_sales", [1, 7], tiebreak=KEYS)


@query(sql.ROLLING)
def rolling_features(spark: SparkSession, d: str) -> DataFrame:
    """WIN-2 with all statistics."""
    return rounded(make_rolling(v.sales(spark, d), "unit_sales", [1], [7, 14], **DAILY))


@query(sql.EXPANDING)
def expanding_features(spark: SparkSession, d: str) -> DataFrame:
    """WIN-3 with all statistics."""
    return rounded(make_expanding(v.sales(spark, d), "unit_sales", [1, 7], **DAILY))


def _sales_with_nan(spark: SparkSession, d: str) -> DataFrame:
    gap = (F.col("item_nbr") + F.dayofmonth("date")) % 5 == 0
    value = F.when(gap, F.lit(float("nan"))).otherwise(F.col("unit_sales").cast("double"))
    return v.sales(spark, d).withColumn("unit_sales", value)


@query(sql.ROLLING_NAN)
def rolling_features_nan(spark: SparkSession, d: str) -> DataFrame:
    """WIN-2 where some sales are NaN: they count as missing."""
    return rounded(make_rolling(_sales_with_nan(spark, d), "unit_sales", [1], [7, 14], **DAILY))


@query(sql.EXPANDING_NAN)
def expanding_features_nan(spark: SparkSession, d: str) -> DataFrame:
    """WIN-3 where some sales are NaN: they are skipped."""
    return rounded(make_expanding(_sales_with_nan(spark, d), "unit_sales", [1, 7], **DAILY))


@query(sql.EXPANDING_BY_STORE)
def expanding_by_store(spark: SparkSession, d: str) -> DataFrame:
    """WIN-3 by store alone: long series, whose length is counted first."""
    stats = ["mean", "max", "min", "sum"]
    df = make_expanding(
        v.sales(spark, d), "unit_sales", [1], stats, ["store_nbr"], tiebreak=["item_nbr"], rows_per_group="check"
    )
    return rounded(df)


@query(sql.DAYS_SINCE)
def days_since_promo(spark: SparkSession, d: str) -> DataFrame:
    """WIN-4."""
    return add_days_since_last_promo(v.sales(spark, d), **DAILY)


@query(sql.DAYS_UNTIL)
def days_until_promo(spark: SparkSession, d: str) -> DataFrame:
    """WIN-5."""
    return add_days_until_next_promo(v.sales(spark, d), **DAILY)


@query(sql.STREAK)
def promo_streak(spark: SparkSession, d: str) -> DataFrame:
    """WIN-6."""
    return add_promo_streak(v.sales(spark, d), **DAILY)


@query(sql.NEXT_7)
def promo_next_7(spark: SparkSession, d: str) -> DataFrame:
    """WIN-7."""
    return add_promo_next_7days_flag(v.sales(spark, d), **DAILY)


@query(sql.PROMO_WORDS)
def promo_words(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-8: promotion states from words, from numbers, and from text that holds numbers."""
    df = v.text_promos(spark, d).withColumn("tax_text", F.col("l_tax").cast("string"))
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        promo_flag(df, "promo_text").alias("from_words"),
        promo_flag(df, "l_tax").alias("from_numbers"),
        promo_flag(df, "tax_text").alias("from_number_text"),
    )


@query(sql.PROMO_STRATEGY)
def promo_strategy(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-7."""
    return process_promotions(v.sales(spark, d), "new_category")


# --- Seasonality ----------------------------------------------------------------------------------------------------


@query(sql.SEASONAL_W)
def seasonal_index_w(spark: SparkSession, d: str) -> DataFrame:
    """AGG-3, JOIN-10: within a range of years."""
    return rounded(add_seasonal_idx_w(v.sales(spark, d), *YEARS))


@query(sql.SEASONAL_M)
def seasonal_index_m(spark: SparkSession, d: str) -> DataFrame:
    """AGG-4, JOIN-10."""
    return rounded(add_seasonal_idx_m(v.sales(spark, d)))


@query(sql.COEFF_W)
def regular_coeff_w(spark: SparkSession, d: str) -> DataFrame:
    """WIN-9: rows outside the years leave."""
    return rounded(add_regular_coeff_w(v.sales(spark, d), *YEARS))


@query(sql.COEFF_M)
def regular_coeff_m(spark: SparkSession, d: str) -> DataFrame:
    """WIN-10."""
    return rounded(add_regular_coeff_m(v.sales(spark, d)))


@query(sql.SEASONALITY)
def seasonality_features(spark: SparkSession, d: str) -> DataFrame:
    """WIN-11."""
    return rounded(create_seasonality_features(v.sales(spark, d)))


@query(sql.SEASONALITY_BY_STORE)
def seasonality_by_store(spark: SparkSession, d: str) -> DataFrame:
    """WIN-11 per store instead of over all series."""
    return rounded(create_seasonality_features(v.sales(spark, d), partition_cols=["store_nbr"]))


# --- Gap-free series ------------------------------------------------------------------------------------------------


@query(sql.OIL_PCHIP)
def oil_pchip(spark: SparkSession, d: str) -> DataFrame:
    """TS-1."""
    return rounded(fill_oil_pchip(v.oil(spark, d)))


@query(sql.OIL_DENSE)
def oil_dense(spark: SparkSession, d: str) -> DataFrame:
    """TS-2, JOIN-8."""
    return rounded(fill_time_series_full_range(fill_oil_pchip(v.oil(spark, d))))


@query(sql.OIL_REVIEW)
def oil_interpolation_review(spark: SparkSession, d: str) -> DataFrame:
    """TS-3."""
    return rounded(oil_review(fill_oil_pchip(v.oil(spark, d)), zoom=SLICE))


@query(sql.ITEM_PRICE_DENSE)
def item_price_dense(spark: SparkSession, d: str) -> DataFrame:
    """TS-1, TS-2 for many series at once."""
    keys = ["item_nbr"]
    filled = fill_oil_pchip(v.store_prices(spark, d), "price", partition_cols=keys)
    return rounded(
        fill_time_series_full_range(
            filled, "price", filled_col="price_filled", complete_col="price_complete", partition_cols=keys
        )
    )


@query(sql.CALENDAR_GAPS)
def calendar_gaps(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-9: missing days of the price and the sales table."""
    return check_missing_dates_full_range(v.oil(spark, d), v.sales(spark, d)).days


@query(sql.CALENDAR_GAP_COUNTS)
def calendar_gap_counts(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-9: their counts."""
    return check_missing_dates_full_range(v.oil(spark, d), v.sales(spark, d)).counts


@query(sql.CALENDAR_GAP_SAMPLE)
def calendar_gap_sample(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-9, TOPK-1: the first ten days missing in the price but not in the sales table."""
    return check_missing_dates_full_range(v.oil(spark, d), v.sales(spark, d)).sample


@query(sql.ALIGNED_JOIN)
def aligned_join(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-10, JOIN-7: stores whose key is written as text, brought to the type of the sales' key and checked to be unique."""
    rows = v.sales(spark, d)
    stores = aligned(v.stores(spark, d).withColumn("store_nbr", F.col("store_nbr").cast("string")), rows, ["store_nbr"])
    require_unique(stores, ["store_nbr"], "stores")
    return attach_measured(rows, stores, ["store_nbr"])


@query(sql.PLAIN_SLICE)
def plain_slice_dates(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-2: a date range without checks."""
    return plain_slice(v.sales(spark, d), tuple(date.fromisoformat(day) for day in SLICE))


@query(sql.RESOLVED_GROUPS)
def resolved_groups(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-4: totals by those of the wanted group columns that the table has."""
    rows = v.sales(spark, d)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        groups = resolve_group_cols(rows, ["store_nbr", "warehouse"])
    return rows.groupBy(*groups).agg(F.sum("unit_sales").alias("unit_sales"), F.count(F.lit(1)).alias("n"))


# --- Folds, scores and profiles -------------------------------------------------------------------------------------


def folds_of(df: DataFrame) -> DataFrame:
    return build_rolling_windows(
        unique_dates(df),
        CV.n_windows,
        CV.val_days,
        CV.stride_days,
        embargo_days(CV.max_lag, CV.max_window),
        CV.min_train_days,
    )


@query(sql.CV_FOLDS)
def cv_folds(spark: SparkSession, d: str) -> DataFrame:
    """CV-1, FLOW-2."""
    return folds_of(v.sales(spark, d))


@query(sql.CV_FEASIBILITY)
def cv_feasibility(spark: SparkSession, d: str) -> DataFrame:
    """CV-2."""
    embargo = embargo_days(CV.max_lag, CV.max_window)
    return feasibility(unique_dates(v.sales(spark, d)), CV.val_days, embargo, CV.min_train_days)


def naive_forecasts(spark: SparkSession, d: str) -> DataFrame:
    """The sales of the validation slice of every fold, forecast by the value one row earlier."""
    lagged = make_lag(v.sales(spark, d), "unit_sales", [1], **DAILY)
    return rows_of_folds(lagged, folds_of(v.sales(spark, d))).select(
        "fold", F.col("unit_sales").alias("y"), F.col("unit_sales_lag_1").alias("yhat")
    )


@query(sql.METRICS)
def forecast_metrics(spark: SparkSession, d: str) -> DataFrame:
    """AGG-7."""
    return rounded(evaluate_metrics(naive_forecasts(spark, d), by=["fold"]))


@query(sql.FOLD_SUMMARY)
def fold_summary(spark: SparkSession, d: str) -> DataFrame:
    """AGG-8."""
    return rounded(aggregate_fold_scores(to_long(evaluate_metrics(naive_forecasts(spark, d), by=["fold"]))))


@query(sql.PROFILE)
def feature_profile(spark: SparkSession, d: str) -> DataFrame:
    """AGG-10, TOPK-1."""
    return rounded(check_features(enriched(spark, d), "unit_sales"))


@query(sql.FIRST_ROWS)
def sample_first_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-4: the first 2,000 rows by date, store and item (a prefix is what this operator is)."""
    return first_rows(v.sales(spark, d), 2000, KEYS)


@query(sql.FEATURE_MATRIX)
def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    """FLOW-1 with the default feature set."""
    return rounded(make_features(v.sales(spark, d), group_cols=KEYS, rows_per_group="daily"))


@query(sql.FEATURE_MATRIX_QTY)
def feature_matrix_other_target(spark: SparkSession, d: str) -> DataFrame:
    """FLOW-1 with a target of another name."""
    sales = v.sales(spark, d).withColumnRenamed("unit_sales", "qty")
    return rounded(make_features(sales, target_col="qty", group_cols=KEYS, rows_per_group="daily"))


@query(sql.FEATURE_SLICE)
def feature_slice_with_context(spark: SparkSession, d: str) -> DataFrame:
    """FLOW-1 on a date slice whose windows may read earlier rows."""
    light = dataclasses.replace(LIGHT_FEATURES, context_days=400)
    dates = tuple(date.fromisoformat(day) for day in SLICE)
    return rounded(slice_features(v.sales(spark, d), dates, light, "unit_sales", KEYS, "daily"))


def _fold_features(spark: SparkSession, d: str) -> tuple[list[Fold], FoldFeatures]:
    sales = v.sales(spark, d)
    folds = collect_folds(folds_of(sales))
    path = os.path.join(shared_folder(spark), f"fold-features-{uuid.uuid4().hex}")
    return folds, FoldFeatures(spark, path, sales, folds, Features(), Columns(), "daily")


@query(sql.FOLD_FEATURES)
def fold_train_features(spark: SparkSession, d: str) -> DataFrame:
    """CV-3, SNK-2: features of both sides of all folds, the training sides cut from the windowed table that all folds share."""
    folds, features = _fold_features(spark, d)
    sides = [
        side.select(F.lit(fold.fold).alias("fold"), F.lit(part).alias("part"), "*")
        for fold in folds
        for part, side in zip(("train", "val"), features.build(fold), strict=True)
    ]
    return rounded(functools.reduce(DataFrame.unionByName, sides))


@query(sql.STORED_FEATURES)
def stored_features(spark: SparkSession, d: str) -> DataFrame:
    """SNK-1: the validation features of the first fold, stored and read back."""
    folds, features = _fold_features(spark, d)
    path = os.path.join(shared_folder(spark), f"stored-{uuid.uuid4().hex}")
    return rounded(save_features(features.val(folds[0]), path))


@query(sql.CSV_LOAD)
def csv_load(spark: SparkSession, d: str) -> DataFrame:
    """SRC-1, SRC-2: the sales table written as CSV and loaded with pinned types."""
    path = os.path.join(shared_folder(spark), f"csv-{uuid.uuid4().hex}", "train.csv")
    v.sales(spark, d).write.option("header", True).csv(path)
    return load_tables(spark, {"train": path})["train"]


@query(sql.CSV_TOLERANT)
def csv_load_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """SRC-3: a folder of CSV files of which some are cut off, and one holds a broken line, read past both."""
    folder = os.path.join(shared_folder(spark), f"csv-{uuid.uuid4().hex}")
    sales = v.sales(spark, d)
    even = F.col("item_nbr") % 2 == 0
    sales.where(even).write.option("header", True).csv(os.path.join(folder, "good"))
    # Two files, made by tasks that only write: the sums before them keep all their tasks.
    sales.where(~even).repartition(2, "date").write.option("header", True).option("compression", "gzip").csv(os.path.join(folder, "cut"))
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(hadoop.Path(os.path.join(folder, "cut", "*.gz"))):
        # A copy that ends in the middle of the file takes its place.
        half = status.getLen() // 2
        piece = spark.sparkContext._gateway.new_array(spark._jvm.byte, min(half, 1 << 20))
        source = files.open(status.getPath())
        short = files.create(hadoop.Path(status.getPath().toString().replace("part-", "short-")))
        for at in range(0, half, 1 << 20):
            size = min(1 << 20, half - at)
            source.readFully(at, piece, 0, size)
            short.write(piece, 0, size)
        source.close()
        short.close()
        files.delete(status.getPath(), True)
    line = files.create(hadoop.Path(os.path.join(folder, "good", "more.csv")))
    line.writeBytes(",".join(sales.columns) + "\n1999-01-01,1\n")
    line.close()
    return read_tolerant(spark, "train", os.path.join(folder, "*")).table


@query(sql.PROFILE_RANGE)
def feature_profile_approx(spark: SparkSession, d: str) -> DataFrame:
    """AGG-10: the profile of a range of days from the stored states of its days."""
    rows = enriched(spark, d)
    states = written(profile_states(rows, "unit_sales"), "profile-states")
    inside = states.where(F.col("_day").between(*[F.lit(date.fromisoformat(x)) for x in SLICE]))
    return rounded(profile_from_states(inside, rows.schema.fields))


@query(sql.FOLD_CACHE_REUSE)
def fold_cache_reuse(spark: SparkSession, d: str) -> DataFrame:
    """SNK-2: the days that stored fold features sum again after the sales of one day changed."""
    sales = v.sales(spark, d)
    folds = collect_folds(folds_of(sales))
    path = os.path.join(shared_folder(spark), f"fold-cache-{uuid.uuid4().hex}")
    FoldFeatures(spark, path, sales, folds, LIGHT_FEATURES, Columns(), "daily").train(folds[0])
    changed = sales.withColumn("unit_sales", F.when(F.col("date") == F.lit(date.fromisoformat(sql.CHANGED_DAY)), F.col("unit_sales") + 1).otherwise(F.col("unit_sales")))
    again = FoldFeatures(spark, path, changed, folds, LIGHT_FEATURES, Columns(), "daily")
    again.train(folds[0])
    return again.days().select("date", F.col("date").isin(again.rebuilt["days"]).alias("rebuilt"))


@query(sql.NEW_DAY_FEATURES)
def new_day_features(spark: SparkSession, d: str) -> DataFrame:
    """WIN-1 to WIN-8, FLOW-1: features of the last two weeks from the state that the days before them left."""
    sales = v.sales(spark, d)
    last = sales.agg(F.max("date")).first()[0]
    start = F.lit(last - timedelta(days=sql.NEW_DAYS))
    path = os.path.join(shared_folder(spark), f"feature-state-{uuid.uuid4().hex}")
    state = StatefulFeatures(spark, path, Features(), Columns())
    state.start(sales.where(F.col("date") <= start))
    return rounded(state.add(sales.where(F.col("date") > start)))


@query(sql.WINDOWS_CUT)
def cut_series_features(spark: SparkSession, d: str) -> DataFrame:
    """WIN-1, WIN-2, WIN-3 on series that are longer than a task may hold: cut into chunks that carry their state on."""
    name, _ = MAX_GROUP_ROWS
    before = spark.conf.get(name, None)
    spark.conf.set(name, "16")
    try:
        features = [
            *[lag_feature("unit_sales", k) for k in (1, 28)],
            *[rolling_feature("unit_sales", 1, w, s) for s in STATS for w in (7, 28)],
            *[expanding_feature("unit_sales", k, s) for s in STATS for k in (1, 7)],
        ]
        return rounded(written(add_series_features(v.sales(spark, d), features, KEYS), "cut-series"))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


# --- Models ---------------------------------------------------------------------------------------------------------

#: A few trees on all features and all rows: what is checked is the way, not the forecast.
SMALL_MODEL = Model(params={"n_estimators": 5, "learning_rate": 0.2, "max_depth": 4, "random_state": 7})


def _fold_builder(spark: SparkSession, d: str):
    prepared = written(enriched(spark, d), "model-input")
    folds = collect_folds(folds_of(prepared))
    path = os.path.join(shared_folder(spark), f"model-folds-{uuid.uuid4().hex}")
    return folds, FoldFeatures(spark, path, prepared, folds, Features(), Columns(), "daily").build


@query(sql.MODEL_INPUTS)
def model_inputs(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-9: the first fold's rows as the trees see them, text as codes of its labels."""
    rows = written(enriched(spark, d), "model-input")
    fold = collect_folds(folds_of(rows))[0]
    inputs = tree_inputs(slice_by_date(rows, fold.train_range), slice_by_date(rows, fold.val_range), "unit_sales")
    both = slice_by_date(rows, fold.train_range).unionByName(slice_by_date(rows, fold.val_range))
    prepared = PipelineModel(inputs.stages).transform(both)
    codes = {"promotion_missing": "_missing_onpromotion", "promotion": "_x_onpromotion", **{f"{c}_code": f"_x_{c}" for c in ("family", "city", "state")}}
    place = {name: inputs.inputs.index(column) for name, column in codes.items()}
    values = vector_to_array("_features")
    return prepared.select("date", *KEYS, *[values[i].alias(name) for name, i in place.items()])


@query(sql.STORED_MODEL)
def stored_model(spark: SparkSession, d: str) -> DataFrame:
    """SNK-3, ML-2: forecasts of the first fold's validation days by a model that was stored and loaded."""
    rows = v.sales(spark, d)
    fold = collect_folds(folds_of(rows))[0]
    val = slice_by_date(rows, fold.val_range)
    learner = SeasonalNaive()
    path = os.path.join(shared_folder(spark), f"model-{uuid.uuid4().hex}")
    learner.fit(learner.prepare(slice_by_date(rows, fold.train_range), val, "unit_sales")).save(path)
    return rounded(FittedSeason.load(spark, path).predict(val).select("date", *KEYS, "prediction"))


@query()
def gbt_forecast(spark: SparkSession, d: str) -> DataFrame:
    """ML-1, ML-2: forecasts of the validation slices of all folds."""
    folds, build = _fold_builder(spark, d)
    parts = []
    for fold in folds:
        train, val = build(fold)
        model = train_model(train, val, "unit_sales", SMALL_MODEL)
        found = predict(model, val).select("date", *KEYS, "unit_sales", "prediction")
        parts.append(written(found.withColumn("fold", F.lit(fold.fold)), "forecast"))
    return functools.reduce(DataFrame.unionByName, parts)


@query()
def gbt_importance(spark: SparkSession, d: str) -> DataFrame:
    """SNK-6: importance of every feature in each fold's model."""
    folds, build = _fold_builder(spark, d)
    found = []
    for fold in folds:
        model = train_model(*build(fold), "unit_sales", SMALL_MODEL)
        found += [(fold.fold, name, weight) for name, weight in feature_importance(model)]
    return importance_table(spark, found)


@query()
def param_sweep(spark: SparkSession, d: str) -> DataFrame:
    """ML-3 to ML-6: the trial history of a sweep with enough trials for pruning."""
    folds, build = _fold_builder(spark, d)
    model = Model(params={**SMALL_MODEL.params, "n_estimators": 3})
    return run_sweep(spark, folds, build, model, Sweep(enabled=True, n_trials=8)).trials


SWEEP = Sweep(enabled=True, n_trials=8, seed=5)


def _smoothings() -> list[float]:
    draw = random.Random(SWEEP.seed)
    return [suggest_params(draw, "seasonal")["smoothing"] for _ in range(SWEEP.n_trials)]


@query(sql.sweep_states(_smoothings(), STARTUP_TRIALS))
def sweep_trial_states(spark: SparkSession, d: str) -> DataFrame:
    """ML-3, ML-6: a sweep of the seasonal learner, every trial's state derived from the stored scores."""
    sales = v.sales(spark, d)
    folds = collect_folds(folds_of(sales))
    build = lambda fold: (slice_by_date(sales, fold.train_range), slice_by_date(sales, fold.val_range))
    result = run_sweep(spark, folds, build, SeasonalNaive(), SWEEP)
    # The states that the run decided on while it went must be those that its scores give.
    told = F.broadcast(result.trials.select("number", "state"))
    return rounded(trial_states(result.scores).join(told, ["number", "state"]))


# --- Whole runs -----------------------------------------------------------------------------------------------------


def _backtest(spark: SparkSession, d: str) -> tuple[BacktestResult, RunRecords]:
    """All folds of the whole flow, with a learner whose forecasts SQL can give."""
    out = os.path.join(shared_folder(spark), f"run-{uuid.uuid4().hex}")
    tables = {"train": v.sales(spark, d), "items": v.items(spark, d), "stores": v.stores(spark, d), "oil": v.oil(spark, d), "holidays_events": v.holidays(spark, d)}
    cfg = BacktestConfig(output_dir=out, rows_per_group="daily")
    result = run_backtest(spark, cfg, tables, SeasonalNaive())
    return result, RunRecords(spark, os.path.join(out, "records"), result.run_id)


@query(sql.BACKTEST_SCORES)
def backtest_fold_scores(spark: SparkSession, d: str) -> DataFrame:
    """CV-3, FLOW-3, UDF-1: scores of every fold."""
    return rounded(_backtest(spark, d)[0].fold_scores)


@query(sql.BACKTEST_SUMMARY)
def backtest_summary(spark: SparkSession, d: str) -> DataFrame:
    """FLOW-3, AGG-8: their mean and spread."""
    return rounded(_backtest(spark, d)[0].cv_summary)


@query(sql.RUN_RECORDS)
def run_records(spark: SparkSession, d: str) -> DataFrame:
    """SNK-4, SNK-6: what a run published, read back."""
    records = _backtest(spark, d)[1]
    scores = to_long(records.read("fold_scores")).select(F.lit("fold_scores").alias("record"), "fold", F.col("metric").alias("name"), F.col("score").alias("value"))
    summary = records.read("cv_summary").select(F.lit("cv_summary"), F.lit(None).cast("int"), "metric", "mean")
    importance = records.read("importance").select(F.lit("importance"), "fold", "feature", "importance")
    return rounded(scores.union(summary).union(importance))
