"""Fold features that know their data, features from stored states, profiles from states, broken files, measured joins."""

from __future__ import annotations

import gzip
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.config import LIGHT_FEATURES, Columns, Features
from shelfline.operators.enrich import join_promos
from shelfline.operators.folds import Fold
from shelfline.operators.profile import check_features, profile_from_states, profile_states
from shelfline.operators.relational import attach, measured_bytes
from shelfline.operators.seasonality import create_seasonality_features
from shelfline.operators.series import first_rows
from shelfline.plans.feature_state import StatefulFeatures
from shelfline.plans.features import make_features
from shelfline.plans.fold_features import FoldFeatures
from shelfline.sources.tables import load_tables, read_tolerant
from tests.helpers import day

KEYS = ["store_nbr", "item_nbr"]
SCHEMA = "date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean, family string"


def sales(spark, days=80, stores=3, seed=4):
    rng = random.Random(seed)
    rows = [
        (day(i), s, 1, 10.0 * s + i % 7 + rng.random(), rng.choice([True, False, None]), "ABC"[i % 3])
        for i in range(days)
        for s in range(1, stores + 1)
        if rng.random() < 0.9
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    """Rows as comparable tuples, floats to nine digits."""
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


FOLDS = [Fold(i, day(0), day(end), day(end + 5), day(end + 12)) for i, end in enumerate((60, 50))]


def test_changed_day_costs_its_series_and_its_days(spark, tmp_path):
    df = sales(spark)
    make = lambda data, name: FoldFeatures(spark, str(tmp_path / name), data, FOLDS, LIGHT_FEATURES, Columns(), "daily", 64)

    def built(features):
        return [rows_of(side) for f in FOLDS for side in features.build(f)]

    first = make(df, "cache")
    whole = built(first)
    assert len(first.rebuilt["windows"]) == 3 and len(first.rebuilt["val"]) == 2
    same = make(df.repartition(5), "cache")
    assert built(same) == whole
    assert same.rebuilt == {"windows": [], "days": []}
    changed = df.withColumn("unit_sales", F.when((F.col("date") == day(20)) & (F.col("store_nbr") == 2), 99.0).otherwise(F.col("unit_sales")))
    again = make(changed, "cache")
    got = built(again)
    assert again.rebuilt["days"] == [day(20)] and len(again.rebuilt["windows"]) == 1 and "val" not in again.rebuilt
    assert got == built(make(changed, "fresh")) and got != whole
    # A series that is gone, and a changed validation day.
    less = df.where("store_nbr <> 3")
    gone = make(less, "cache")
    assert built(gone) == built(make(less, "fresh2"))
    assert len(gone.rebuilt["val"]) == 2
    assert make(df, "cache").path != FoldFeatures(spark, str(tmp_path / "cache"), df, FOLDS, Features(), Columns(), "daily", 64).path


def test_features_of_new_days_equal_those_of_all_rows(spark, tmp_path):
    odd = [(day(70), 9, 1, 5.0, True, "A"), (day(72), 9, 1, None, None, "B"), (day(71), None, 1, 3.0, True, "A"), (day(72), None, 1, 4.0, False, None)]
    df = sales(spark).where("NOT (store_nbr = 1 AND date > DATE'2017-03-05')").unionByName(spark.createDataFrame(odd, SCHEMA))
    settings = Features(lags=(1, 7, 28), windows=(3, 14))
    full = make_features(df, lags=settings.lags, windows=settings.windows, group_cols=KEYS, rows_per_group="daily")
    states = StatefulFeatures(spark, str(tmp_path / "state"), settings, Columns())
    states.start(df.where(F.col("date") < day(66)))
    got = states.add(df.where(F.col("date") >= day(66)))
    assert got.columns == full.columns
    want = full.where(F.col("date") >= day(66))
    assert rows_of(got) == rows_of(want)
    # The same again from the state before, and day by day from a state of a few days.
    assert rows_of(states.add(df.where(F.col("date") >= day(66)))) == rows_of(want)
    assert len(states.versions()) == 2
    daily = StatefulFeatures(spark, str(tmp_path / "daily"), LIGHT_FEATURES, Columns())
    daily.start(df.where(F.col("date") < day(77)))
    for k in (77, 78):
        daily.add(df.where(F.col("date") == day(k)))
    last = daily.add(df.where(F.col("date") == day(79)))
    light = make_features(df, lags=(7, 14), windows=(7,), rolling_stats=("mean",), exp_stats=(), group_cols=KEYS, rows_per_group="daily")
    assert rows_of(last) == rows_of(light.where(F.col("date") == day(79)))


def test_profile_of_a_range_from_its_days(spark):
    df = sales(spark).withColumn("flat", F.lit("x")).withColumn("unit_sales", F.when(F.col("store_nbr") != 2, F.col("unit_sales")))
    states = profile_states(df, "unit_sales")
    inside = F.col("date").between(F.lit(day(10)), F.lit(day(30)))
    got = profile_from_states(states.where(F.col("_day").between(F.lit(day(10)), F.lit(day(30)))), df.schema.fields)
    assert rows_of(got) == rows_of(check_features(df.where(inside), "unit_sales"))
    empty = profile_from_states(states.where("1 = 0"), df.schema.fields)
    assert empty.where("section = 'shape' AND name = 'rows'").first()["value"] == 0
    many = spark.range(60_000).select(F.lit(day(0)).alias("date"), F.concat(F.lit("v"), F.col("id") % 20_000).alias("word"))
    found = profile_from_states(profile_states(many), many.schema.fields).where("section = 'cardinality'").first()["value"]
    assert found == pytest.approx(20_000, rel=0.05)


def test_broken_files_and_lines(spark, tmp_path):
    folder = tmp_path / "train"
    folder.mkdir()
    head = "date,store_nbr,item_nbr,unit_sales,onpromotion,extra\n"
    (folder / "a.csv").write_text(head + "2017-01-01,1,10,1.5,True,3\n2017-01-02,1\n2017-01-03,2,11,2.5,,4\n2017-01-04,2,12,1,1,2,3,4\n")
    whole = gzip.compress((head + "".join(f"2017-02-01,{i % 9},{random.random()},{random.random()},True,1\n" for i in range(5000))).encode())
    (folder / "b.csv.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "c.csv.gz").write_bytes(gzip.compress((head + "2017-03-01,3,13,oops,True,7\n").encode()))
    (folder / "d.csv.gz").write_bytes(b"not a gzip file")
    read = read_tolerant(spark, "train", str(folder))
    assert sorted((r["store_nbr"], r["unit_sales"], r["extra"]) for r in read.table.collect() if r["unit_sales"]) == [(1, 1.5, 3), (2, 2.5, 4)]
    assert read.table.where("store_nbr = 3").first()["unit_sales"] is None and read.table.count() == 3
    states = {r["file"].rsplit("/", 1)[1]: (r["rows"], r["bad_rows"], r["state"]) for r in read.files.collect()}
    assert states == {"a.csv": (4, 2, "read"), "b.csv.gz": (0, 0, "broken"), "c.csv.gz": (1, 0, "read"), "d.csv.gz": (0, 0, "broken")}
    assert sorted(r["line"] for r in read.bad_rows.collect()) == ["2017-01-02,1", "2017-01-04,2,12,1,1,2,3,4"]
    assert read_tolerant(spark, "oil", str(folder / "b.csv.gz")).table is None
    assert read_tolerant(spark, "oil", str(tmp_path / "nothing*")).table is None
    tables = load_tables(spark, {"train": str(folder), "oil": str(folder / "d.csv.gz")}, on_error="tolerate")
    assert tables["train"].count() == 3 and tables["oil"] is None
    with pytest.raises(ValueError):
        load_tables(spark, str(folder), on_error="hope")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_sides_are_broadcast_after_measuring(spark):
    df = sales(spark)
    assert "SortMergeJoin" not in plan_of(create_seasonality_features(df, partition_cols=["store_nbr"]))
    promos = spark.createDataFrame([(day(3), 1, True), (day(3), 1, False)], "date date, store_nbr int, onpromotion boolean")
    assert "BroadcastHashJoin" in plan_of(join_promos(df, promos))
    spark.conf.set("spark.shelfline.broadcastMaxBytes", "10")
    try:
        auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = create_seasonality_features(df, partition_cols=["store_nbr"])
        assert "SortMergeJoin" in plan_of(shuffled)
        wide = rows_of(shuffled)
        own = create_seasonality_features(df.withColumn("year", F.year("date") + 0))
        assert "SortMergeJoin" in plan_of(own)
    finally:
        spark.conf.unset("spark.shelfline.broadcastMaxBytes")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert wide == rows_of(create_seasonality_features(df, partition_cols=["store_nbr"]))


def test_rows_without_a_key_are_spread(spark):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("k"), "id", F.col("id").alias("_x"))
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach(fact, dim, ["k"], small=False)
        assert out.columns == ["k", "id", "_x", "name"] and out.count() == 3000
        where = out.select("k", F.spark_partition_id().alias("p")).groupBy("p").agg(F.count_if(F.col("k").isNull()).alias("n")).where("n > 0").count()
        assert out.where("name IS NOT NULL").count() == sum(1 for i in range(0, 3000, 3) if i % 5 in (0, 1))
        assert where > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_first_rows_of_equal_keys_are_fixed(spark):
    rows = [(day(0), 1, 1, float(i), None, "A") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    once, again = first_rows(df, 7, KEYS), first_rows(df.repartition(6), 7, KEYS)
    assert rows_of(once) == rows_of(again) and once.count() == 7
    assert first_rows(sales(spark), 5, KEYS).agg(F.max("date")).first()[0] <= day(0) + timedelta(days=2)


def test_nested_columns_are_measured(spark):
    short = spark.createDataFrame([([1] * 2, {"a": "b"})], "x array<int>, m map<string,string>")
    long = spark.createDataFrame([([1] * 2000, {"a": "b"})], "x array<int>, m map<string,string>")
    assert measured_bytes(long) - measured_bytes(short) > 3000
