"""Features of many folds from one windowed table.

Training ranges all start at the first date, so whatever looks back is the same in every fold. Only what looks ahead
(the next promotion) and what is measured on the whole slice (seasonal means) depends on where a range ends: the first
is cut off at the end by a comparison of dates, the second follows from totals per day. The windows over the fact
table run once for all folds, and a fold's training table is a filter, a projection and a broadcast join.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from shelfline.config import Columns, Features, fingerprint
from shelfline.operators.folds import Fold
from shelfline.operators.promotions import PROMO_FLAG, promo_feature_list
from shelfline.operators.relational import resolve_group_cols
from shelfline.operators.seasonality import daily_totals, totals_from_days
from shelfline.operators.series import BoundedFeature
from shelfline.operators.slicing import slice_by_date
from shelfline.plans.features import dressed, slice_features, target_feature_list, windowed
from shelfline.session import written
from shelfline.sources.sinks import is_complete

_PROMO_ROWS = 7
_COMING, _LAST_ROW = "_next_rows_promo", "_last_next_row"


def _look_ahead() -> list[BoundedFeature]:
    """Dates behind the next-rows flag: of the first promo among the next rows, and of the last of these rows."""

    def coming(w: WindowSpec):
        return F.min(F.when(F.col(PROMO_FLAG), F.col("date"))).over(w.rowsBetween(1, _PROMO_ROWS))

    return [
        BoundedFeature(_COMING, 0, _PROMO_ROWS, coming),
        BoundedFeature(_LAST_ROW, 0, _PROMO_ROWS, lambda w: F.lead("date", _PROMO_ROWS).over(w)),
    ]


_BUCKET, _UNIT = "_bucket", "_unit"


def data_prints(rows: DataFrame, unit: Column) -> DataFrame:
    """SNK-2: an order-free fingerprint of the rows of each unit: their number and two sums of their hashes."""
    named = [F.struct(F.col(c).isNull().alias("missing"), F.col(c).alias("value")) for c in sorted(rows.columns)]
    row = F.xxhash64(*named)
    return rows.groupBy(unit.alias(_UNIT)).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(row).alias("mixed"), F.sum(F.pmod(row, F.lit((1 << 31) - 1))).alias("total")
    )


class FoldFeatures:
    """SNK-2: training and validation features of folds, stored under ``path`` as they are first needed.

    The windowed table lies in buckets of series, as many as there are shuffle partitions unless ``buckets`` says otherwise, and
    dealt by the hash that the windows' shuffle uses: a task writes one bucket, not a piece of each. The folder's name carries the
    settings; each table knows the fingerprints of the data it was made of. On other data only those buckets of series whose rows
    changed are windowed again, only changed days are summed again, and a validation slice is made again if one of its days
    changed. ``rebuilt`` lists what was, by table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        prepared: DataFrame,
        folds: Sequence[Fold],
        features: Features,
        cols: Columns,
        rows_per_group: str = "check",
        buckets: int | None = None,
    ):
        self.spark, self.prepared = spark, prepared
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.features, self.cols, self.rows_per_group = features, cols, rows_per_group
        self.span = (min(f.train_start for f in folds), max(f.train_end for f in folds)) if folds else None
        self.path = os.path.join(path, fingerprint(features, cols, rows_per_group, self.span, sorted(prepared.dtypes), self.buckets))
        self._stored: dict[str, DataFrame] = {}
        self.rebuilt: dict[str, list] = {}
        own_periods = {"year", "week_of_year", "month_of_year"} & set(prepared.columns)
        self.shared = len({f.train_start for f in folds}) == 1 and not own_periods

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._stored:
            where = os.path.join(self.path, name)
            if not is_complete(self.spark, where):
                build().write.mode("overwrite").parquet(where)
                self.rebuilt.setdefault(name.split("-")[0], []).append(name)
            self._stored[name] = self.spark.read.parquet(where)
        return self._stored[name]

    def _changed(self, name: str, now: DataFrame) -> tuple[list, list]:
        """Units whose rows are not those the stored table was made of, and units that are there no more."""
        if not is_complete(self.spark, os.path.join(self.path, f"{name}-prints")):
            return [r[_UNIT] for r in now.select(_UNIT).collect()], []
        columns = ["rows", "mixed", "total"]
        before = self.spark.read.parquet(os.path.join(self.path, f"{name}-prints"))
        before = before.select(F.col(_UNIT), F.struct(*columns).alias("was"))
        both = now.select(F.col(_UNIT), F.struct(*columns).alias("is")).join(before, _UNIT, "full")
        differ = both.where(~F.col("is").eqNullSafe(F.col("was"))).select(_UNIT, F.col("is").isNull().alias("gone"))
        units = differ.collect()  # buckets, or days of the calendar
        return [r[_UNIT] for r in units if not r["gone"]], [r[_UNIT] for r in units if r["gone"]]

    def _remember(self, name: str, now: DataFrame) -> None:
        now.write.mode("overwrite").parquet(os.path.join(self.path, f"{name}-prints"))

    def _bucketed(self) -> DataFrame:
        """The windowed rows of all series, one folder per bucket of series."""
        if "windows" in self._stored:
            return self._stored["windows"]
        groups = resolve_group_cols(self.prepared, self.cols.group_cols)
        rows = slice_by_date(self.prepared, self.span)
        bucket = F.pmod(F.hash(*groups), F.lit(self.buckets)) if groups else F.lit(0)
        now = written(data_prints(rows, bucket), "prints")
        changed, gone = self._changed("windows", now)
        where = os.path.join(self.path, "windows")
        if changed:
            wanted = rows if len(changed) == self.buckets else rows.where(bucket.isin(changed))
            made = self._windows(wanted, groups).withColumn(_BUCKET, bucket)
            # Only the folders of these buckets are written anew.
            made.sortWithinPartitions(_BUCKET, "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                _BUCKET
            ).parquet(where)
        for unit in gone:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(where, f"{_BUCKET}={unit}"))
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self._remember("windows", now)
        self.rebuilt["windows"] = sorted(changed)
        self._stored["windows"] = self.spark.read.parquet(where).drop(_BUCKET)
        return self._stored["windows"]

    def _day_prints(self) -> DataFrame:
        if "prints" not in self._stored:
            self._stored["prints"] = written(data_prints(self.prepared.where(F.col("date").isNotNull()), F.col("date").cast("date")), "prints")
        return self._stored["prints"]

    def days(self) -> DataFrame:
        """Totals per day of the training span."""
        if "days" in self._stored:
            return self._stored["days"]
        now = self._day_prints().where(F.col(_UNIT).between(*map(F.lit, self.span)))
        changed, gone = self._changed("days", now)
        where = os.path.join(self.path, "days")
        rows = slice_by_date(self.prepared, self.span)
        if changed or gone:
            fresh = changed and is_complete(self.spark, where)
            again = daily_totals(rows.where(F.col("date").isin(changed)) if fresh else rows, self.cols.target)
            if is_complete(self.spark, where):
                kept = self.spark.read.parquet(where).where(~F.col("date").isin([*changed, *gone]))
                again = kept.unionByName(again) if changed else kept
            again = written(again, "days")
            again.write.mode("overwrite").parquet(where)
        self._remember("days", now)
        self.rebuilt["days"] = sorted(changed)
        self._stored["days"] = self.spark.read.parquet(where)
        return self._stored["days"]

    def _range_print(self, dates: tuple[date, date]) -> str:
        """The fingerprint of a date range, context rows included, from those of its days."""
        start = dates[0] - timedelta(days=self.features.context_days)
        inside = self._day_prints().where(F.col(_UNIT).between(F.lit(start), F.lit(dates[1])))
        found = inside.agg(F.sum("rows"), F.bit_xor("mixed"), F.sum("total")).first()
        return fingerprint(str(dates[0]), str(dates[1]), *found)

    def _names(self) -> list[str]:
        return [f.name for f in self._features()]

    def _features(self) -> list:
        f = self.features
        return [
            *promo_feature_list("date", _PROMO_ROWS),
            *target_feature_list(
                self.cols.target, f.lags, f.rollag, f.explag, f.windows, f.rolling_stats, f.exp_stats
            ),
        ]

    def _windows(self, rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        wide = [*self._features(), *_look_ahead()]
        return windowed(rows, wide, groups, self.cols.target, rows_per_group=self.rows_per_group)

    def train(self, fold: Fold) -> DataFrame:
        if not self.shared:
            return self._once(f"train-{self._range_print(fold.train_range)}", lambda: self._slice(fold.train_range))
        end = F.lit(fold.train_end)
        wide = self._bucketed().where(F.col("date") <= end)
        days = self.days()
        until, flag = F.col("days_until_next_promo"), F.col("promo_in_next_7days")
        wide = wide.withColumns(
            {
                "days_until_next_promo": F.when(F.date_add("date", until) <= end, until),
                "promo_in_next_7days": F.when(F.col(_COMING) <= end, F.lit(1)).when(
                    (flag == 0) & (F.col(_LAST_ROW) <= end), F.lit(0)
                ),
            }
        )
        totals = totals_from_days(days.where(F.col("date") <= end))
        return dressed(wide, totals, self.prepared.columns, self._names())

    def val(self, fold: Fold) -> DataFrame:
        return self._once(f"val-{self._range_print(fold.val_range)}", lambda: self._slice(fold.val_range))

    def _slice(self, dates) -> DataFrame:
        cols = self.cols
        return slice_features(self.prepared, dates, self.features, cols.target, cols.group_cols, self.rows_per_group)

    def build(self, fold: Fold) -> tuple[DataFrame, DataFrame]:
        return self.train(fold), self.val(fold)
