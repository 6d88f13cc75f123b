"""SNK-1 to SNK-6: feature tables, fold caches, models and run records."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.config import fingerprint
from shelfline.operators.folds import Fold
from shelfline.operators.profile import feature_catalogue


def save_features(features: DataFrame, path: str) -> DataFrame:
    """SNK-1: a feature table, target included, as Parquet; returns the stored table."""
    features.write.mode("overwrite").parquet(path)
    return features.sparkSession.read.parquet(path)


class FoldCache:
    """SNK-2: features per fold and split, built once and read by every trial.

    The folder name carries a hash of the settings and of the fold's dates, so a changed configuration never reads
    old features. A fold counts as stored once its success marker exists.
    """

    def __init__(self, spark: SparkSession, root: str, *settings: Any):
        self.spark = spark
        self.root = root
        self.settings = settings

    def path(self, fold: Fold) -> str:
        return os.path.join(self.root, fingerprint(*self.settings, fold))

    def stored(self, fold: Fold) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path(fold), "_SUCCESS"))
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def load_or_build(self, fold: Fold, build: Callable[[Fold], tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
        """Training and validation features of a fold."""
        if not self.stored(fold):
            train, val = build(fold)
            both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
            both.withColumn("fold", F.lit(fold.fold)).write.mode("overwrite").partitionBy("fold", "split").parquet(
                self.path(fold)
            )
        table = self.spark.read.parquet(self.path(fold))
        return tuple(table.where(F.col("split") == split).drop("fold", "split") for split in ("train", "val"))


def save_model(model: PipelineModel, path: str) -> None:
    """SNK-3."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    return _exists(spark, os.path.join(path, "_SUCCESS"))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class RunRecords:
    """SNK-4: what a run was and what came out of it, in tables keyed by ``run_id``.

    A table of a run, or one fold's part of it, is written to a folder that readers pass over and published by one rename. What
    is published again takes the place of what was there: a step that is tried again doubles nothing, and a step that broke off
    shows nothing.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark = spark
        self.root = root
        self.run_id = run_id

    def _where(self, name: str, part: int | None) -> str:
        return os.path.join(self.root, name, f"run_id={self.run_id}", "part=all" if part is None else f"part={part}")

    def publish(self, name: str, df: DataFrame, part: int | None = None) -> None:
        staged = os.path.join(self.root, "_staged", uuid.uuid4().hex)
        df.write.parquet(staged)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(staged), hadoop.Path(self._where(name, part))
        files = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.mkdirs(target.getParent())
        files.delete(target, True)
        if not files.rename(source, target):
            raise OSError(f"{target} could not be published")

    def has(self, name: str, part: int | None = None) -> bool:
        return _exists(self.spark, self._where(name, part))

    def config(self, config_json: str) -> None:
        self.publish("config", self.spark.createDataFrame([(config_json,)], "config string"))

    def fold_scores(self, scores: DataFrame, fold: int | None = None) -> None:
        self.publish("fold_scores", scores, fold)

    def cv_summary(self, summary: DataFrame) -> None:
        self.publish("cv_summary", summary)

    def catalogue(self, features: DataFrame) -> None:
        self.publish("catalogue", feature_catalogue(features))

    def importance(self, importance: DataFrame, fold: int | None = None) -> None:
        self.publish("importance", importance, fold)

    def sweep(self, trials: DataFrame, by_fold: DataFrame, best: Mapping[str, Any]) -> None:
        """Trial history, scores of the best trial by fold, and the best parameters. Only called when a sweep ran."""
        self.publish("trials", trials)
        self.publish("best_by_fold", by_fold)
        self.publish("best_params", self.spark.createDataFrame([(json.dumps(dict(best)),)], "params string"))

    def read(self, name: str) -> DataFrame:
        """The published rows of this run."""
        whole = self.spark.read.parquet(os.path.join(self.root, name, f"run_id={self.run_id}", "part=*"))
        return whole.withColumn("run_id", F.lit(self.run_id))

    def parts(self, name: str, schema: str) -> DataFrame:
        """The same without ``run_id``; no rows if nothing is published."""
        if not _exists(self.spark, os.path.join(self.root, name, f"run_id={self.run_id}")):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(os.path.join(self.root, name, f"run_id={self.run_id}", "part=*"))


def importance_table(spark: SparkSession, rows: Sequence[tuple[int, str, float]]) -> DataFrame:
    """SNK-6: ``fold, feature, importance``, highest first."""
    return spark.createDataFrame(list(rows), "fold int, feature string, importance double").orderBy(
        "fold", F.desc("importance"), "feature"
    )
