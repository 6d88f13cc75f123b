"""Session settings shared by every entry point, and the places where Spark may spill state to shared storage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on. They are defaults: a value the session already carries wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where that costs a shuffle further on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Names of the engine's own settings, with their defaults.
BROADCAST_MAX_BYTES = ("spark.shelfline.broadcastMaxBytes", 64 * 1024 * 1024)
MAX_GROUP_ROWS = ("spark.shelfline.maxGroupRows", 2_000_000)


def build_session(app_name: str = "shelfline", master: str | None = None, **conf: object) -> SparkSession:
    """Create (or fetch) a session with the engine's defaults; extra settings may be given as keyword strings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def int_setting(spark: SparkSession, setting: tuple[str, int]) -> int:
    name, default = setting
    return int(spark.conf.get(name, str(default)))


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster the executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="shelfline-")
    # Our own folder, of this process alone: it goes when the process ends.
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``written`` made, once its last reader is done. Tables elsewhere are left alone."""
    spark = df.sparkSession
    folders = {os.path.dirname(file) for file in df.inputFiles()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    shared = hadoop.Path(shared_folder(spark))
    files = shared.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in folders:
        path = hadoop.Path(folder)
        if files.makeQualified(path).getParent().equals(files.makeQualified(shared)):
            files.delete(path, True)
