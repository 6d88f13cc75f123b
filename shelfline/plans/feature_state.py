"""WIN-1 to WIN-8, FLOW-1: features of new days from a stored state per series, without the old days.

The state of a series is its last rows, as many as any bounded window reaches back, and what its running features carry: counts,
sums, spreads, extremes, the last promo date, the last break of a streak. New rows are windowed behind the last rows and continue
the running values; the old facts are not read. Next to it stand the totals per day that the seasonal means follow from. A version
of the state is a folder of its own, complete or not there at all, so that a day can be run again from the version before it.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.config import Columns, Features
from shelfline.functions.promo import promo_flag
from shelfline.operators.promotions import PROMO_FLAG, promo_feature_list
from shelfline.operators.relational import resolve_group_cols
from shelfline.operators.seasonality import daily_totals, totals_from_days
from shelfline.operators.series import POSITION, BoundedFeature, RunningFeature, all_known, bounded_inputs, guarded_columns, spread_series
from shelfline.plans.features import dressed, target_feature_list
from shelfline.schemas import as_date, nan_to_null, require_columns
from shelfline.session import written

_NEW, _LANE, _ROWS = "_new", "_lane", "_rows"
_LANES = 1024


@dataclass(frozen=True)
class FeatureState:
    """What is known of all rows up to a day: last rows, running values and totals per day."""

    tail: DataFrame
    running: DataFrame
    days: DataFrame


class StatefulFeatures:
    """Features of a table that grows by days. Series have one row per day, and days come in order."""

    def __init__(self, spark: SparkSession, path: str, features: Features, cols: Columns, promo_window: int = 7):
        self.spark, self.path, self.cols = spark, path, cols
        f = features
        self.features: list[BoundedFeature | RunningFeature] = [
            *promo_feature_list("date", promo_window),
            *target_feature_list(cols.target, f.lags, f.rollag, f.explag, f.windows, f.rolling_stats, f.exp_stats),
        ]
        self.inputs = bounded_inputs(self.features)
        self.running = [f for f in self.features if isinstance(f, RunningFeature)]
        # What looks ahead starts at the rows themselves: nothing of it is carried forward.
        self.states = {name: s for f in self.running for name, s in f.states.items() if not s.reverse}
        self.back = max([f.back for f in self.inputs.values()], default=0)

    # --- Versions -------------------------------------------------------------------------------------------------

    def _files(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        return hadoop, root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[str]:
        """Last days of the stored versions, ascending."""
        _, root, files = self._files()
        if not files.exists(root):
            return []
        names = [s.getPath().getName() for s in files.listStatus(root)]
        return sorted(n.removeprefix("upto=") for n in names if n.startswith("upto="))

    def read(self, upto: str) -> FeatureState:
        at = os.path.join(self.path, f"upto={upto}")
        return FeatureState(*(self.spark.read.parquet(os.path.join(at, part)) for part in ("tail", "running", "days")))

    def _store(self, state: FeatureState) -> None:
        staged = os.path.join(self.path, f"_staged-{uuid.uuid4().hex}")
        for part in ("tail", "running", "days"):
            getattr(state, part).write.parquet(os.path.join(staged, part))
        upto = self.spark.read.parquet(os.path.join(staged, "days")).agg(F.max("date")).first()[0]
        if upto is None:
            raise ValueError("a state needs at least one day")
        hadoop, _, files = self._files()
        target = hadoop.Path(os.path.join(self.path, f"upto={upto}"))
        files.delete(target, True)
        if not files.rename(hadoop.Path(staged), target):
            raise OSError(f"{target} could not be published")

    # --- Work -----------------------------------------------------------------------------------------------------

    def _keys(self, df: DataFrame) -> list[str]:
        return resolve_group_cols(df, self.cols.group_cols)

    def start(self, rows: DataFrame) -> None:
        """The state after ``rows``, the first days there are."""
        self.add(rows)

    def add(self, rows: DataFrame) -> DataFrame:
        """Features of new days, which are then part of the state.

        The state that is continued is the latest one before the first new day: running a day again gives the same.
        """
        require_columns(rows, ["date", self.cols.target, "onpromotion"], "features of new days")
        keys = self._keys(rows)
        columns = rows.columns
        rows = as_date(nan_to_null(rows)).withColumn(PROMO_FLAG, promo_flag(rows, "onpromotion")).where(F.col("date").isNotNull())
        rows = written(rows, "new-days")
        first = rows.agg(F.min("date")).first()[0]
        known = [v for v in self.versions() if first is not None and v < str(first)]
        state = self.read(known[-1]) if known else None

        wide = self._windowed(rows, keys, state)
        days = daily_totals(rows, self.cols.target)
        days = written(days if state is None else state.days.unionByName(days), "all-days")
        self._store(FeatureState(self._tail(rows, keys, state), self._running(wide, keys, state), days))
        return dressed(wide.drop(PROMO_FLAG), totals_from_days(days), columns, [f.name for f in self.features])

    def _windowed(self, rows: DataFrame, keys: Sequence[str], state: FeatureState | None) -> DataFrame:
        """The new rows with all series features and the helper columns that the state is made of."""
        both = rows.withColumn(_NEW, F.lit(True))
        if state is not None:
            both = both.unionByName(state.tail.withColumn(_NEW, F.lit(False)), allowMissingColumns=True)
        series = all_known(keys)
        # Rows without a key are no series; they are dealt to many tasks and get no features.
        both = both.withColumn(_LANE, F.when(~series, F.pmod(F.xxhash64("date", self.cols.target), F.lit(_LANES))))
        partition = [*keys, _LANE]
        both = spread_series(both, partition)
        asc = Window.partitionBy(*partition).orderBy("date")
        bounded = both.withColumns({name: f.build(asc) for name, f in self.inputs.items()}).where(_NEW)
        wide = bounded.withColumns(guarded_columns(self.features)).drop(_NEW)
        if state is not None:
            wide = wide.join(state.running, list(keys), "left")
        else:
            wide = wide.withColumn(_ROWS, F.lit(0).cast("long"))
        asc = Window.partitionBy(*partition).orderBy("date")
        desc = Window.partitionBy(*partition).orderBy(F.desc("date"))
        run = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rev = desc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        wide = wide.withColumn(POSITION, F.row_number().over(asc) + F.coalesce(_ROWS, F.lit(0)))

        def carried(name: str) -> Column | None:
            return F.col(f"_before_{name}") if state is not None and name in self.states else None

        wide = wide.withColumns({f.name: f.build(run, rev, carried) for f in self.running})
        wide = wide.withColumns({f.name: F.when(series, F.col(f.name)) for f in self.features})
        return written(wide.drop(_LANE, _ROWS, *[f"_before_{s}" for s in self.states]), "new-features")

    def _tail(self, rows: DataFrame, keys: Sequence[str], state: FeatureState | None) -> DataFrame:
        """The last rows of every series that a bounded window can reach."""
        needed = rows.select("date", *keys, self.cols.target, PROMO_FLAG).where(all_known(keys))
        if state is not None:
            needed = needed.unionByName(state.tail)
        if keys:
            needed = spread_series(needed, keys)
        last = F.row_number().over(Window.partitionBy(*keys or [F.lit(0)]).orderBy(F.desc("date")))
        return needed.withColumn("_last", last).where(F.col("_last") <= max(self.back, 1)).drop("_last")

    def _running(self, wide: DataFrame, keys: Sequence[str], state: FeatureState | None) -> DataFrame:
        """What running features carry, of old and new rows together."""
        here = [s.summary().alias(name) for name, s in self.states.items()]
        parts = wide.where(all_known(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS), *here)
        if state is not None:
            before = state.running.select(*keys, _ROWS, *[F.col(f"_before_{s}").alias(s) for s in self.states])
            parts = parts.unionByName(before)
        columns = [F.sum(_ROWS).alias(_ROWS)]
        for name, s in self.states.items():
            combined = s.combine(F.col(name))
            if name.endswith("_m2"):
                # Spread within the parts, and of their means around the common mean.
                n, total = F.col(name[:-2] + "count"), F.col(name[:-2] + "sum")
                mean = F.try_divide(total, n)
                weighted = F.sum(n * mean * mean) - F.try_divide(F.sum(total) * F.sum(total), F.sum(n))
                combined = combined + F.coalesce(F.greatest(weighted, F.lit(0.0)), F.lit(0.0))
            columns.append(combined.alias(f"_before_{name}"))
        return parts.groupBy(*keys).agg(*columns)
