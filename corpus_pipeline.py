"""The training-data pipeline: each stage is one operator, stored as Parquet and read again by the next.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame; all but the last return the columns of ``documents``. Any extra
columns are kept as well. Null and empty texts pass every stage but may fail the classifier; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bpe, decontaminate, jaccard, quality, suffix
from shelfline.llm.common import batches_of, table
from shelfline.operators.relational import fits_broadcast
from shelfline.session import written

#: Rows of whole texts that a task gets from Spark at a time.
ROWS_A_BATCH = 1000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network predicts to be good."""
    model = quality.fit(*quality.training_sample(docs, table(spark, sf_dir, "labels")))
    scored = quality.score(docs, model, "_quality_score")
    return scored.where(F.col("_quality_score") >= quality.THRESHOLD).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id, of equal or missing ids the first row.

    Documents without words are in no group and stay.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = jaccard.near_components(rows.select(F.col("_row").alias("doc_id"), "text"))
    found = found.withColumnsRenamed({"doc_id": "_row", "component_id": "_group"})
    named = found.join(rows.select("_row", "doc_id"), "_row")
    # The least of a struct combines before it moves; a missing id comes after all others.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "_row"))
    stays = written(named.groupBy("_group").agg(first.alias("first")).select(F.col("first._row").alias("_row")), "kept-rows")
    return rows.join(F.broadcast(stays) if fits_broadcast(stays) else stays, "_row", "left_semi").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 400 bytes that stand anywhere else; documents of which nothing is left go."""
    cleaned = suffix.remove_repeats(docs.withColumn("_had_text", F.length(F.coalesce("text", F.lit(""))) > 0))
    return cleaned.where(~F.col("_had_text") | (F.length("text") > 0)).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, each row judged by its own text."""
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = decontaminate.contaminated(rows.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = written(found.select(F.col("doc_id").alias("_row")).distinct(), "contaminated-rows")
    return rows.join(F.broadcast(bad) if fits_broadcast(bad) else bad, "_row", "left_anti").select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts; stored here, as a batch of texts takes a worker's memory."""
    with batches_of(spark, ROWS_A_BATCH):
        return written(bpe.encoding_digests(docs), "digests")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The network, the suffix order and the encoder have no counterpart in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    # Rows hold whole texts, and a batch of them is held by Spark and by the task.
    with batches_of(spark, ROWS_A_BATCH):
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), name)
    return docs
