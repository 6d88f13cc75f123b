"""What the plans of the large operators must look like."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from shelfline.operators.series import make_lag
from shelfline.operators.slicing import slice_by_date
from shelfline.plans.features import make_features

KEYS = ["store_nbr", "item_nbr"]


def plan_of(df) -> str:
    """The physical plan of a query that has run, without its initial form."""
    df.write.format("noop").mode("overwrite").save()
    df.toArrow()
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", re.split(r"\+- == Initial Plan ==", text)[0])


def sales(spark, tmp_path):
    rows = [(s, it, i, float(i % 9), i % 4 == 0) for s in range(4) for it in range(5) for i in range(60)]
    df = spark.createDataFrame(rows, "store_nbr int, item_nbr int, i int, unit_sales double, onpromotion boolean")
    path = str(tmp_path / "sales")
    df.select(F.date_add(F.lit("2016-01-01").cast("date"), F.col("i")).alias("date"), *KEYS, "unit_sales", "onpromotion",
              F.lit("x").alias("unused")).write.parquet(path)
    return spark.read.parquet(path)


def test_features_shuffle_the_facts_once(spark, tmp_path):
    plan = plan_of(make_features(sales(spark, tmp_path), group_cols=KEYS, rows_per_group="daily"))
    assert len(re.findall(r"Exchange hashpartitioning\(store_nbr, item_nbr", plan)) == 1
    # The only other shuffles are those of the small (year, week, month) table.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert "FileScan parquet [date,unit_sales]" in plan
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_slices_reach_the_scan(spark, tmp_path):
    df = make_lag(slice_by_date(sales(spark, tmp_path), ("2016-01-05", "2016-01-20")), "unit_sales", [1], KEYS, rows_per_group="daily")
    plan = plan_of(df.select("date", "unit_sales_lag_1"))
    assert "GreaterThanOrEqual(date" in plan and "LessThanOrEqual(date" in plan
    assert "unused" not in plan and "onpromotion" not in plan


def test_sales_of_large_tables_are_dealt_by_rows_before_they_are_summed(spark, tmp_path, monkeypatch):
    from queries import views

    rows = [(i % 50, i % 7, i % 11, float(i % 5), (i % 3) / 50, (i % 2) / 20) for i in range(2000)] + [(None, None, None, 1.0, 0.0, 0.0)]
    lines = spark.createDataFrame(rows, "day int, l_suppkey long, l_partkey long, l_quantity double, l_tax double, l_discount double")
    lines.withColumn("l_shipdate", F.date_add(F.lit("2016-01-01").cast("date"), F.col("day"))).drop("day").write.parquet(str(tmp_path / "lineitem.parquet"))
    brands = [(i, None if i == 3 else f"Brand#{i % 4}") for i in range(11)]
    spark.createDataFrame(brands, "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    few = views.sales(spark, str(tmp_path))
    monkeypatch.setattr(views, "_SMALL_ROWS", 100)
    monkeypatch.setattr(views, "_TASK_ROWS", 50)
    many = views.sales(spark, str(tmp_path))
    # 2,001 rows at 50 a task, in a multiple of the four shuffle partitions; sums are made by these tasks only.
    assert many.rdd.getNumPartitions() == 44
    plan = plan_of(many)
    assert plan.index("REPARTITION_BY_NUM") > plan.rindex("HashAggregate")
    assert sorted(map(repr, many.collect())) == sorted(map(repr, few.collect()))
