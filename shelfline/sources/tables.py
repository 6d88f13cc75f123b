"""SRC-1 to SRC-3: CSV tables with pinned column types."""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.relational import SOURCE_ORDER
from shelfline.schemas import COLUMN_TYPES, TABLE_COLUMNS, nan_to_null
from shelfline.session import written

log = logging.getLogger(__name__)

_CORRUPT = "_corrupt_line"


def _stem(path: str) -> str:
    return os.path.splitext(os.path.basename(path.rstrip("/")))[0]


def _named_paths(spark: SparkSession, csv_paths) -> dict[str, str]:
    if isinstance(csv_paths, Mapping):
        return dict(csv_paths)
    if isinstance(csv_paths, (list, tuple)):
        return {_stem(p): p for p in csv_paths}
    if not isinstance(csv_paths, str):
        raise ValueError("csv_paths must be a dict, a list or a string")
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(csv_paths)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path) and fs.getFileStatus(path).isDirectory() and not csv_paths.endswith(".csv"):
        files = sorted(s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().endswith(".csv"))
        return {_stem(p): p for p in files}
    if csv_paths.endswith(".csv"):
        return {_stem(csv_paths): csv_paths}
    raise ValueError("csv_paths must name a folder, a .csv file, a list of files or a dict of files")


def read_table(
    spark: SparkSession, name: str, path: str, *, keep_row_order: bool = False, bad_values: str = "raise"
) -> DataFrame:
    """SRC-2: one CSV table. Columns pinned for this table are converted, all others are inferred.

    Pinned columns are read as text and converted by expressions: truth values also as 0 and 1, whole numbers also with
    a zero fraction. A value that does not convert fails the job that reads it, without a pass of its own; with
    ``bad_values="null"`` it becomes NULL.
    """
    if bad_values not in ("raise", "null"):
        raise ValueError("bad_values must be 'raise' or 'null'")
    header = spark.read.option("header", True).csv(path)
    pinned = TABLE_COLUMNS.get(name, ())
    others = [c for c in header.columns if c not in pinned]
    inferred = {}
    if others:
        sample = spark.read.option("header", True).option("inferSchema", True).csv(path)
        inferred = {f.name: f.dataType for f in sample.schema.fields}
    kinds = [T.StructField(c, inferred[c] if c in others else T.StringType(), True) for c in header.columns]
    df = spark.read.schema(T.StructType(kinds)).option("header", True).option("mode", "PERMISSIVE").csv(path)
    if keep_row_order:
        df = with_source_order(df)
    converted = {c: _converted(c, COLUMN_TYPES[c], bad_values) for c in header.columns if c in pinned}
    return nan_to_null(df.withColumns(converted))


# Texts for a missing value, and for the two truth values.
MISSING_WORDS = ("", "nan", "na", "n/a", "null", "none", "<na>")
TRUE_WORDS, FALSE_WORDS = ("true", "t", "1", "1.0", "yes"), ("false", "f", "0", "0.0", "no")


def _converted(name: str, kind: T.DataType, bad_values: str) -> Column:
    raw = F.col(name)
    if isinstance(kind, T.StringType):
        return raw
    text = F.lower(F.trim(raw))
    if isinstance(kind, T.BooleanType):
        value = F.when(text.isin(*TRUE_WORDS), F.lit(True)).when(text.isin(*FALSE_WORDS), F.lit(False))
    elif isinstance(kind, (T.IntegerType, T.LongType)):
        # Digits go the direct way, since a floating number cannot hold every long one.
        number = F.trim(raw).try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(kind))
        value = F.coalesce(F.trim(raw).try_cast(kind), whole)
    else:
        value = F.trim(raw).try_cast(kind)
    if bad_values == "null":
        return value
    message = F.concat(F.lit(f"column {name}: not a value of type {kind.simpleString()}: "), raw)
    known = raw.isNotNull() & ~text.isin(*MISSING_WORDS)
    return F.when(value.isNotNull(), value).when(known, F.raise_error(message).cast(kind))


def with_source_order(df: DataFrame) -> DataFrame:
    """Add the place of a row in its source file, for "first row wins" and "last row wins".

    File, block start and the running id of the reading task compare like line numbers, however the file was split.
    """
    return df.withColumn(
        SOURCE_ORDER,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


@dataclass(frozen=True)
class TolerantRead:
    """What could be read of a table: its rows (None if no file could be), every file's counts, and the lines put aside."""

    table: DataFrame | None
    #: ``file``, ``rows``, ``bad_rows``, and ``state``: read or broken.
    files: DataFrame
    #: ``file`` and ``line`` of every line that is not a row of the table.
    bad_rows: DataFrame | None


def _csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a table: itself, or what a folder or pattern holds."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found, todo = [], list(fs.globStatus(where) or [])
    while todo:
        status = todo.pop()
        if status.getPath().getName().startswith(("_", ".")):
            continue
        if status.isDirectory():
            todo.extend(fs.listStatus(status.getPath()))
        else:
            found.append(status.getPath().toString())
    return sorted(found)


def _broken_file(error: Exception, files: Sequence[str]) -> str | None:
    """The file that a failed job names."""
    text = str(error)
    return next((f for f in sorted(files, key=len, reverse=True) if f in text or f.replace(":/", ":///", 1) in text), None)


def read_tolerant(spark: SparkSession, name: str, path: str, *, bad_values: str = "null") -> TolerantRead:
    """SRC-3: read past what is broken, and say what that was.

    A file that cannot be read to its end (cut off, not what its name says) is left out as a whole; a line that has too few or too
    many values is put aside. Both are found by one job that counts every file's lines; a broken file ends it by name, and it runs
    again without that file. What was found good is then read as usual.
    """
    files = _csv_files(spark, path)
    good, broken, counts = list(files), [], None
    where = F.col("_metadata.file_path")
    while good and counts is None:
        try:
            header = spark.read.option("header", True).csv(good).columns
            schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
            lines = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            # Only a parser that reads all columns sees that a line has too few.
            lines = lines.option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False).csv(good)
            marked = lines.select(where.alias("file"), F.col(_CORRUPT).alias("line"), F.concat_ws("", *header).alias("whole"))
            counted = marked.groupBy("file").agg(
                F.count(F.lit(1)).alias("rows"), F.count("line").alias("bad_rows"), F.sum(F.length("whole").cast("long")).alias("_read")
            )
            counts = written(counted, "file-counts")
        except Exception as error:
            found = _broken_file(error, good)
            if found is None:
                raise
            log.warning("left out %s: %s", found, str(error).split("\n")[0])
            broken.append(found)
            good.remove(found)
    states = spark.createDataFrame([(f, 0, 0, "broken") for f in broken], "file string, rows long, bad_rows long, state string")
    if counts is None:
        return TolerantRead(None, states, None)
    states = states.unionByName(counts.select("file", "rows", "bad_rows", F.lit("read").alias("state")))
    bad = written(marked.where(F.col("line").isNotNull()), "bad-lines").select("file", "line")
    pinned = TABLE_COLUMNS.get(name, ())
    others = [c for c in header if c not in pinned]
    inferred = {}
    if others:
        sample = spark.read.option("header", True).option("inferSchema", True).csv(good)
        inferred = {f.name: f.dataType for f in sample.schema.fields}
    # Always true, and it reads all columns: Spark refuses to tell a broken line by its mark alone, as in a bare count.
    kept = lines.where(F.col(_CORRUPT).isNull() & (F.length(F.concat_ws("", *header)) >= 0)).drop(_CORRUPT)
    columns = [
        (_converted(c, COLUMN_TYPES[c], bad_values) if c in pinned else F.col(c).try_cast(inferred[c])).alias(c) for c in header
    ]
    return TolerantRead(nan_to_null(kept.select(*columns)), states, bad)


def load_tables(
    spark: SparkSession,
    csv_paths: Mapping[str, str] | Sequence[str] | str,
    *,
    on_error: str = "raise",
    keep_row_order: bool | Sequence[str] = False,
    bad_values: str = "raise",
) -> dict[str, DataFrame | None]:
    """SRC-1: tables by name from a dict, a list of files, a folder of ``*.csv`` or one ``.csv`` file.

    ``keep_row_order`` is for all tables or for those it names. ``on_error="skip"`` logs a table that cannot be opened and stores
    ``None`` for it; ``on_error="tolerate"`` also reads past broken files and lines (SRC-3).
    """
    if on_error not in ("raise", "skip", "tolerate"):
        raise ValueError("on_error must be 'raise', 'skip' or 'tolerate'")
    tables: dict[str, DataFrame | None] = {}
    for name, path in _named_paths(spark, csv_paths).items():
        if on_error == "tolerate":
            tables[name] = read_tolerant(spark, name, path).table
            continue
        try:
            ordered = keep_row_order if isinstance(keep_row_order, bool) else name in keep_row_order
            tables[name] = read_table(spark, name, path, keep_row_order=ordered, bad_values=bad_values)
        except AnalysisException as error:
            if on_error == "raise":
                raise
            log.warning("could not read %s: %s", path, error)
            tables[name] = None
    return tables
