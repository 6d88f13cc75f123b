"""JOIN-1 to JOIN-10, AGG-9, STR, MAP and PRJ on small tables."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfline.functions.promo import promo_flag
from shelfline.functions.text import ascii_key
from shelfline.operators import holidays as hol
from shelfline.operators.enrich import create_extend_train, join_oil_promos
from shelfline.operators.promotions import process_promotions
from shelfline.operators.relational import keep_one, measured_bytes, resolve_group_cols
from shelfline.operators.slicing import drop_target_cols, max_date, min_date, plain_slice, slice_by_date
from tests.helpers import column, daily, day

ITEMS = "item_nbr int, family string, class int, line int"
STORES = "store_nbr int, city string, state string"


def test_first_item_row_wins_and_rows_are_kept(spark):
    sales = daily(spark, [1, 2, 3]).union(daily(spark, [4], item=99))
    items = spark.createDataFrame([(1, "B", 2, 1), (1, "A", 1, 2), (5, "C", 3, 3)], ITEMS)
    stores = spark.createDataFrame([(1, "Quito", "Pichincha"), (1, "Ambato", "Tungurahua")], STORES)
    out = create_extend_train(sales, items, stores, items_order=["line"])
    assert out.columns == [*sales.columns, "family", "class", "city", "state"]
    rows = out.orderBy("item_nbr", "date").collect()
    assert [r["family"] for r in rows] == ["B", "B", "B", None]
    assert {r["city"] for r in rows} == {"Ambato"}  # no order given: the smallest row


def test_dimensions_too_large_to_broadcast_give_the_same(spark):
    sales = daily(spark, [1, 2, 3])
    items = spark.createDataFrame([(1, "A", 1, 1), (2, "B", 2, 2)], ITEMS)
    stores = spark.createDataFrame([(1, "Quito", "Pichincha")], STORES)
    want = create_extend_train(sales, items, stores).collect()
    spark.conf.set("spark.shelfline.broadcastMaxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = create_extend_train(sales, items, stores)
        assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
        assert sorted(out.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.shelfline.broadcastMaxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_one(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (1, 2, None), (None, 1, "z")], "k int, o int, v string")
    assert sorted(r["v"] for r in keep_one(df, ["k"], keep="first", order_by=["o"]).collect()) == ["y", "z"]
    assert sorted(r["v"] for r in keep_one(df, ["k"], keep="last", order_by=["o"]).collect()) == ["x", "z"]
    with pytest.raises(ValueError):
        keep_one(df, ["k"], keep="any")


def test_measured_bytes_counts_strings(spark):
    short = spark.createDataFrame([("a",)] * 10, "v string")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "v string")
    assert measured_bytes(long) - measured_bytes(short) == 9990


def test_oil_choice_and_duplicates(spark):
    sales = daily(spark, [1, 2])
    oil = spark.createDataFrame(
        [(day(0), "x", 5, 7.0), (day(0), "y", 6, 8.0)], "date date, note string, price int, dcoilwtico double"
    )
    assert column(join_oil_promos(sales, oil, None), "oil_price") == [8.0, None]
    assert column(join_oil_promos(sales, oil.drop("dcoilwtico"), None), "oil_price") == [6.0, None]
    assert column(join_oil_promos(sales, oil, None, oil_col="price"), "oil_price") == [6.0, None]
    assert join_oil_promos(sales, None, None).columns == sales.columns
    assert join_oil_promos(sales, oil.limit(0), None).columns == sales.columns
    with pytest.raises(ValueError):
        join_oil_promos(sales, oil.select("date", "note"), None)
    with pytest.raises(ValueError):
        join_oil_promos(sales, oil.drop("date"), None)


def test_promo_keys_and_collisions(spark):
    sales = daily(spark, [1, 2], [True, None])
    full = spark.createDataFrame(
        [(day(0), 1, 1, False, 9.0, "a", 1), (day(0), 1, 1, True, 8.0, "b", 2)],
        "date date, store_nbr int, item_nbr int, onpromotion boolean, unit_sales double, kind string, n int",
    )
    out = join_oil_promos(sales, None, full, promos_order=["n"])
    assert out.columns == ["date", "store_nbr", "item_nbr", "unit_sales", "onpromotion", "promo_unit_sales", "kind", "n"]
    assert column(out, "onpromotion") == [True, None]
    assert column(out, "promo_unit_sales") == [8.0, None]
    kept = join_oil_promos(sales, None, full, overwrite_onpromotion=False, promos_order=["n"])
    assert column(kept, "promo_onpromotion") == [True, None]
    by_date = join_oil_promos(sales, None, full.select("date", "kind"))
    assert column(by_date, "kind") == ["b", None]
    assert join_oil_promos(sales, None, full.select("date", "store_nbr")).columns == sales.columns
    with pytest.raises(ValueError):
        join_oil_promos(sales, None, full.select("kind"))


HOLIDAYS = [
    (date(1996, 12, 25), "Holiday", "National", "X", "Navidad", False),
    (date(1996, 12, 24), "Additional", "National", "X", "Navidad-1", False),
    (date(1996, 12, 26), "Additional", "National", "X", "Navidad+1", False),
    (date(1997, 1, 1), "Holiday", "National", "X", "Primer dia del ano", True),
    (date(1997, 1, 3), "Transfer", "National", "X", "Traslado Primer dia del ano", False),
    (date(1997, 5, 23), "Bridge", "National", "X", "Puente Batalla", False),
    (date(1997, 5, 31), "Work Day", "National", "X", "Recupero puente Batalla", False),
    (date(1997, 7, 25), "Holiday", "Local", "Guayaquil", "Fundación de  Guayaquil", False),
    (date(1997, 8, 10), "Holiday", "Regional", "ASIA", "Provincialización", False),
    (date(1997, 8, 10), "Event", "National", "X", "Terremoto+12", False),
    (date(1997, 8, 11), "Event", "Local", "Quito", "Mundial: A-B", False),
    (date(1997, 9, 1), "Holiday", "National", "X", "Feria-2", False),
    (date(1997, 9, 2), "Half Day", "National", "X", "Otro", False),
    (date(1997, 9, 3), "Holiday", "National", "X", None, None),
]
HOLIDAY_SCHEMA = "date date, type string, locale string, locale_name string, description string, transferred boolean"


def test_holiday_parser(spark):
    rows = hol.clean(spark.createDataFrame(HOLIDAYS, HOLIDAY_SCHEMA)).orderBy("date", "role").collect()
    got = {(r["date"], r["role"]): (r["anchor_label"], r["offset_days"], r["anchor_key"]) for r in rows}
    assert got[date(1996, 12, 24), "additional"] == ("Navidad", -1, "navidad")
    assert got[date(1996, 12, 25), "holiday"] == ("Navidad", 0, "navidad")
    assert got[date(1997, 1, 3), "transfer"] == ("Primer dia del ano", 0, "primer dia del ano")
    assert got[date(1997, 5, 23), "bridge"][0] == "Batalla"
    assert got[date(1997, 5, 31), "work_day"][0] == "Batalla"
    assert got[date(1997, 7, 25), "holiday"][2] == "fundacion de guayaquil"
    assert got[date(1997, 8, 10), "event"] == ("Terremoto", 12, "terremoto")
    assert got[date(1997, 8, 11), "event"] == ("Mundial: A-B", 0, "mundial: a-b")
    assert got[date(1997, 9, 1), "additional"] == ("Feria", -2, "feria")
    assert got[date(1997, 9, 2), "half_day"][0] == "Otro"
    assert got[date(1997, 9, 3), "holiday"] == ("", 0, "")


def test_holiday_features(spark):
    out = hol.preprocess(spark.createDataFrame(HOLIDAYS, HOLIDAY_SCHEMA))
    assert not set(hol.CONSUMED) & set(out.columns)
    by_day = {(r["date"], r["role"]): r for r in out.collect()}
    assert len(by_day) == len(HOLIDAYS)
    assert by_day[date(1996, 12, 25), "holiday"]["holiday_duration"] == 3
    assert by_day[date(1997, 1, 1), "holiday"]["is_day_off"] is False
    assert by_day[date(1997, 1, 3), "transfer"]["is_day_off"] is True
    assert by_day[date(1997, 5, 31), "work_day"]["is_day_off"] is False
    assert by_day[date(1997, 7, 25), "holiday"]["city"] == "Guayaquil"
    assert by_day[date(1997, 8, 10), "holiday"]["state"] == "ASIA"


def test_scoped_holiday_join(spark):
    holidays = hol.preprocess(spark.createDataFrame(HOLIDAYS, HOLIDAY_SCHEMA))
    stores = spark.createDataFrame([(1, "Guayaquil", "ASIA"), (2, "Quito", "EUROPE")], STORES)
    days = [date(1997, 7, 25), date(1997, 8, 10), date(1996, 12, 25), date(1997, 1, 2)]
    train = spark.createDataFrame([(d, s, 1, 1.0) for d in days for s in (1, 2)], "date date, store_nbr int, item_nbr int, unit_sales double")
    out = hol.merge_train(train, holidays, stores)
    assert out.columns == [*train.columns, *hol.HOLIDAY_FLAGS]
    got = {(r["date"], r["store_nbr"]): tuple(r[c] for c in hol.HOLIDAY_FLAGS) for r in out.collect()}
    assert got[days[0], 1] == (1, 1, 1, 0)
    assert got[days[0], 2] == (0, 0, 0, 0)
    assert got[days[1], 1] == (1, 1, 1, 1)
    assert got[days[1], 2] == (0, 1, 0, 1)
    assert got[days[2], 1] == got[days[2], 2] == (1, 3, 1, 0)
    assert got[days[3], 1] == (0, 0, 0, 0)
    with pytest.raises(ValueError):
        hol.merge_train(train, holidays, stores.union(stores))
    with_city = train.withColumn("city", F.lit("Quito"))  # only the state is fetched
    assert hol.merge_train(with_city, holidays, stores).columns == [*with_city.columns, *hol.HOLIDAY_FLAGS]


def test_ascii_key(spark):
    df = spark.createDataFrame([("  Ñandú \t Ægir  Straße ",), ("éxito",), (None,)], "t string")
    got = [r["k"] for r in df.select(ascii_key(F.col("t")).alias("k")).collect()]
    assert got == ["nandu aegir strasse", "exito", None]


def test_promo_words(spark):
    words = spark.createDataFrame([(w,) for w in ["True", " yes ", "0x", "FALSE", "no", "", "nan", None]], "p string")
    assert [r[0] for r in words.select(promo_flag(words, "p")).collect()] == [True, True, None, False, False, None, None, None]
    numbers = spark.createDataFrame([(w,) for w in ["1", "0", "2.5", "yes", " 0.0 ", "inf", None]], "p string")
    assert [r[0] for r in numbers.select(promo_flag(numbers, "p")).collect()] == [True, False, True, None, False, True, None]
    floats = spark.createDataFrame([(1.0,), (0.0,), (float("nan"),), (None,)], "p double")
    assert [r[0] for r in floats.select(promo_flag(floats, "p")).collect()] == [True, False, None, None]


def test_promo_strategy(spark):
    df = daily(spark, [1, 2, 3], [True, False, None])
    seen = Observation("promos")
    out = process_promotions(df, "new_category", observation=seen)
    # Collected as it is: a sort would sample the rows first and count them twice.
    assert sorted(r["onpromotion_processed"] for r in out.collect()) == ["NO_PROMO_INFO", "false", "true"]
    assert seen.get == {"original_nulls": 1, "remaining_nulls": 0, "new_category_rows": 1}
    assert column(process_promotions(df), "onpromotion_processed") == [True, False, None]
    assert process_promotions(df.drop("onpromotion")).columns == ["date", "store_nbr", "item_nbr", "unit_sales"]
    with pytest.raises(ValueError):
        process_promotions(df, "drop")


def test_slices(spark):
    df = daily(spark, range(10))
    assert slice_by_date(df, ("2017-01-05", "2017-01-03")).count() == 3
    assert slice_by_date(df, [day(2), "2017-01-04 12:00"]).count() == 2
    assert slice_by_date(df, ("2017-01-03 01:00", day(4))).count() == 2
    assert plain_slice(df, ("2017-01-05", "2017-01-03")).count() == 0
    assert (min_date(df), max_date(df)) == (day(0), day(9))
    for wrong in ("2017-01-05", (day(1),), (day(1), day(2), day(3))):
        with pytest.raises(ValueError):
            slice_by_date(df, wrong)
    with pytest.raises(ValueError):
        slice_by_date(df.drop("date"), (day(1), day(2)))
    assert "unit_sales" not in drop_target_cols(df, "unit_sales").columns
    assert drop_target_cols(df, "absent").columns == df.columns


def test_group_columns(spark):
    df = daily(spark, [1])
    with pytest.warns(UserWarning):
        assert resolve_group_cols(df, ["store_nbr", "shop"]) == ["store_nbr"]
    assert resolve_group_cols(df, None) == []
