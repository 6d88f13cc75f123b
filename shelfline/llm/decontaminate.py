"""Benchmark decontamination by size-partitioned MinHash containment, in DataFrame functions only.

An item of n distinct shingles counts as contained in a document that has at least three quarters of them. Such a document
must have one of any ``n - ceil(0.75 n) + 1`` shingles of the item, hence one of its smallest hashes. Items are partitioned by
size, each size class keeps that many minima of a MinHash order for its largest size, and documents of any length are
searched by their shingle hashes against these sketches. What is found is verified on the shingles' words.

The sketches are broadcast if their measured size allows it, and joined by shuffle else; documents are not shuffled in the
first case. Verification reads only documents with a candidate.

Edge cases: texts are lower-cased, words are split at ASCII white space. An item of fewer than five words is one shingle and
is searched as a run of as many words; an item or document without words or with a null text is contained in and contains
nothing. Null ids and repeated rows: a null item_id or doc_id never matches; repeated ids are taken together. Empty tables
give no pairs. Extra columns are kept in ``clean``; no column name of the documents can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import table
from shelfline.operators.relational import fits_broadcast
from shelfline.session import written

WIDTH = 5
#: Containment in percent from which a document counts as contaminated.
PERCENT = 75


def _words(text: Column) -> Column:
    trimmed = F.trim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t\n\x0b\f\r]+"))


def _hash_shingles(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, h``: the hash of every run of ``width`` words."""
    hashed = docs.select("doc_id", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("w"))
    places = hashed.where(F.size("w") >= width).select("doc_id", "w", F.sequence(F.lit(0), F.size("w") - width).alias("at"))
    return places.select("doc_id", F.explode(F.transform("at", lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(width)]))).alias("h"))


def _shingles(rows: DataFrame, key: str, width: int) -> DataFrame:
    """``key, shingle``: the distinct runs of ``width`` words, as arrays."""
    worded = rows.select(key, _words(F.col("text")).alias("w")).where(F.size("w") >= width)
    places = worded.select(key, "w", F.sequence(F.lit(1), F.size("w") - width + 1).alias("at"))
    runs = F.transform("at", lambda i: F.slice("w", i, width))
    return places.select(key, F.explode(F.array_distinct(runs)).alias("shingle"))


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id, width, shingle, h, n``: all distinct shingles of every item and their number."""
    known = items.where(F.col("item_id").isNotNull())
    short = [
        _shingles(known.where(F.size(_words(F.col("text"))) == width), "item_id", width).withColumn("width", F.lit(width))
        for width in range(1, WIDTH)
    ]
    found = _shingles(known, "item_id", WIDTH).withColumn("width", F.lit(WIDTH))
    for part in short:
        found = found.unionByName(part)
    found = found.distinct()
    hashed = F.lit(None).cast("long")
    for width in range(1, WIDTH + 1):
        own = F.xxhash64(*[F.xxhash64(F.get("shingle", F.lit(j))) for j in range(width)])
        hashed = F.when(F.col("width") == width, own).otherwise(hashed)
    sizes = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("h", hashed).join(sizes, "item_id")


def sketches(shingles: DataFrame) -> DataFrame:
    """``item_id, width, h``: the minima that each item's size class keeps."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n"))) + 1) - 1
    keep = F.floor(largest * (100 - PERCENT) / 100).cast("int") + 1
    # The order is a second hash, so that the minima do not depend on the values that are joined.
    minima = F.array_sort(F.collect_set(F.struct(F.xxhash64("h", F.lit(8)).alias("order"), "h")))
    grouped = shingles.groupBy("item_id", "width", "n").agg(minima.alias("all"))
    return grouped.select("item_id", "width", F.explode(F.slice("all", F.lit(1), keep)).alias("m")).select("item_id", "width", F.col("m.h").alias("h"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles`` of every item that a document contains."""
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    shingles = written(item_shingles(items), "item-shingles")
    sketch = written(sketches(shingles), "item-sketches")
    small = fits_broadcast(sketch)
    candidates = None
    # At most five widths; all but the full one only for items that are shorter.
    for (width,) in sketch.select("width").distinct().orderBy("width").collect():
        own = sketch.where(F.col("width") == width).select("h", "item_id")
        found = _hash_shingles(docs, width).join(F.broadcast(own) if small else own, "h").select("doc_id", "item_id")
        candidates = found if candidates is None else candidates.unionByName(found)
    if candidates is None:
        return docs.limit(0).select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0).cast("long").alias("n_shared"), F.lit(0).cast("long").alias("n_shingles"))
    candidates = written(candidates.distinct(), "contaminated")
    ids = candidates.select("doc_id").distinct()
    suspects = docs.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "doc_id", "left_semi")
    few = fits_broadcast(shingles.select("item_id", "n", F.array_join("shingle", " ").alias("s")))
    own = shingles.select("item_id", "width", "shingle", "n")
    shared = None
    for (width,) in sketch.select("width").distinct().orderBy("width").collect():
        of_items = own.where(F.col("width") == width).drop("width")
        found = _shingles(suspects, "doc_id", width).join(F.broadcast(of_items) if few else of_items, "shingle")
        found = found.select("doc_id", "item_id", "shingle", "n")
        shared = found if shared is None else shared.unionByName(found)
    # A repeated doc_id may give a shingle twice.
    counted = shared.groupBy("doc_id", "item_id", "n").agg(F.count_distinct("shingle").alias("n_shared"))
    verified = counted.where(100 * F.col("n_shared") >= PERCENT * F.col("n"))
    return verified.join(candidates, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "n_shared", F.col("n").alias("n_shingles"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without documents that contain an item; rows with a null id stay."""
    bad = written(contaminated(docs, items).select("doc_id").distinct(), "contaminated-ids")
    return docs.join(F.broadcast(bad) if fits_broadcast(bad) else bad, "doc_id", "left_anti").select(*docs.columns)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it contains."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bs AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id),
ds AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))
SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS n_shared, any_value(n.n) AS n_shingles
FROM ds JOIN bs USING (s) JOIN n ON n.id = bs.id GROUP BY ds.id, bs.id
HAVING 100 * count(*) >= 75 * any_value(n.n)
"""
