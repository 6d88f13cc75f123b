"""Quality rules with host verdicts: rule failures per domain, shrunk by an empirical beta prior, joined back to documents.

Each document is measured once, from its whole text. A document fails if a rule on its words, symbols, lines or repeats
fails. Failures are summed per host; the mean and variance of the hosts' rates give a beta prior, and a host's rate is
drawn towards it by the prior's weight. Hosts whose shrunk rate is high are watched (their failing documents go) or
blocked (all their documents go); elsewhere only the base rule decides.

Edge cases: null and empty texts have no words and fail the base rule; a null host is a host of its own; repeated rows and
ids stay; an empty table gives no rows; clashing column names are replaced by the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import blocks, mixed, table, utf8, word_hashes, word_spans
from shelfline.operators.relational import fits_broadcast
from shelfline.session import written

WINDOW = 8
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))

#: Shrunk rate of failing documents from which a host is watched, and from which it is blocked.
WATCH_RATE = 0.3
BLOCK_RATE = 0.9

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _duplicates(value: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value stood in its text before, and whether it stands there more than once."""
    order = np.lexsort((np.arange(len(value)), value, doc))
    same = np.zeros(len(value), bool)
    if len(value) > 1:
        same[1:] = (value[order][1:] == value[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    again = np.empty(len(value), bool)
    again[order] = same
    both = same.copy()
    both[:-1] |= same[1:]
    more = np.empty(len(value), bool)
    more[order] = both
    return again, more


def measure_block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The five counts of each text of a block."""
    starts, ends, first = word_spans(data, offsets)
    n_words = np.diff(first)
    begins = (data & 0xC0) != 0x80
    letters = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])
    chars = np.concatenate([[0], np.cumsum(letters[ends] - letters[starts])])
    # Lines: a text's first line starts with it, others after a line end.
    is_start = np.zeros(len(data) + 1, bool)
    is_start[offsets[:-1]] = True
    is_start[np.flatnonzero(data == 10) + 1] = True
    is_start[len(data)] = False
    line = np.flatnonzero(is_start)
    line_end = np.append(line[1:], len(data))
    line_end = np.where((line_end > line) & (data[np.maximum(line_end - 1, 0)] == 10), line_end - 1, line_end) if len(data) else line_end
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line)
    line, line_end = line[has_word], line_end[has_word]
    line_doc = np.searchsorted(offsets, line, side="right") - 1
    again, _ = _duplicates(word_hashes(data, line, line_end), line_doc)
    # Windows of eight words that stand in the text at least twice, and the words they cover.
    words = word_hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    covered = np.zeros(len(words) + 1, np.int64)
    if len(words) >= WINDOW:
        size = len(words) - WINDOW + 1
        value = np.zeros(size, np.uint64)
        for j in range(WINDOW):
            value += words[j : j + size] * np.uint64(2 * j + 0x9E3779B97F4A7C15)
            value = mixed(value)
        at = np.flatnonzero(doc[:size] == doc[WINDOW - 1 :])
        _, more = _duplicates(value[at], doc[at])
        np.add.at(covered, at[more], 1)
        np.add.at(covered, at[more] + WINDOW, -1)
    return {
        "n_words": n_words,
        "word_chars": chars[first[1:]] - chars[first[:-1]],
        "n_symbols": _sums(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_doc, weights=again, minlength=len(n_words)).astype(np.int64),
        "n_repeat_words": _sums(np.cumsum(covered)[:-1] > 0, first),
    }


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with the five counts of each whole text."""
    kept = [c for c in keep if c not in MEASURES]
    schema = docs.select(*kept).schema
    for name in MEASURES:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            parts = [measure_block(d, o) for _, _, d, o in blocks(data, offsets)]
            counts = [pa.array(np.concatenate([p[m] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64()) for m in MEASURES]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counts], names=[*kept, *MEASURES])

    return docs.select(*kept, F.col("text").alias("_whole_text")).mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_failed():
    """Any rule: the base rule, symbols for more than a tenth of the letters, repeated lines, odd word lengths."""
    return (
        base_failed()
        | (10 * F.col("n_symbols") > F.col("word_chars"))
        | (10 * F.col("n_dup_lines") > F.col("n_words"))
        | (F.col("word_chars") < 2 * F.col("n_words"))
        | (F.col("word_chars") > 15 * F.col("n_words"))
    )


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """Per host: documents, failures and the rate shrunk by the beta prior that fits all hosts' rates (method of moments)."""
    hosts = measured.groupBy(F.coalesce(F.col(host), F.lit("")).alias("_host")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(rule_failed().cast("long")).alias("failures")
    )
    rate = F.col("failures") / F.col("docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    m, v = F.col("m"), F.greatest(F.col("v"), F.lit(1e-6))
    # a + b of the beta distribution with this mean and variance; at least 2, also when all hosts agree.
    weight = F.least(F.greatest(m * (1 - m) / v - 1, F.lit(2.0)), F.lit(1000.0))
    prior = moments.select(m.alias("prior_mean"), weight.alias("prior_weight"), F.lit(1).alias("_one"))
    # The prior is one row.
    joined = hosts.withColumn("_one", F.lit(1)).join(F.broadcast(prior), "_one").drop("_one")
    shrunk = (F.col("failures") + F.col("prior_mean") * F.col("prior_weight")) / (F.col("docs") + F.col("prior_weight"))
    return joined.withColumn("shrunk_rate", shrunk)


def judge(docs: DataFrame, host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with counts, ``base_failed``, the host's ``shrunk_rate`` and ``kept``."""
    own = {"base_failed", "kept", "shrunk_rate", *MEASURES}
    names = [c for c in (keep or docs.columns) if c not in own]
    rows = docs.withColumn("_host_name", F.coalesce(F.col(host).cast("string"), F.lit("")))
    measured = written(measures(rows, [*names, "_host_name"]), "rule-measures")
    rates = written(host_rates(measured, "_host_name").select(F.col("_host").alias("_host_name"), "shrunk_rate"), "host-rates")
    judged = measured.join(F.broadcast(rates) if fits_broadcast(rates) else rates, "_host_name", "left")
    verdict = (F.col("shrunk_rate") < WATCH_RATE) | (~rule_failed() & (F.col("shrunk_rate") < BLOCK_RATE))
    judged = judged.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict)
    return judged.select(*names, *MEASURES, "shrunk_rate", "base_failed", "kept")


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over all documents, with ``source`` as the host."""
    judged = judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *MEASURES, "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT doc_id, i, x, count(*) OVER f AS full8,
  string_agg(x, ' ') OVER f AS s FROM word
  WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
rep AS (SELECT doc_id, i, CASE WHEN full8 = 8 AND count(*) OVER (PARTITION BY doc_id, full8, s) > 1 THEN 1 ELSE 0 END AS twice FROM win),
cov AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c FROM rep),
r AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS n_repeat_words FROM cov GROUP BY doc_id),
chars AS (SELECT doc_id, CAST(sum(length(x)) AS BIGINT) AS word_chars FROM word GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words, coalesce(word_chars, 0) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN chars USING (doc_id) LEFT JOIN dup USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
g AS (SELECT *, base_failed OR 10 * n_symbols > word_chars OR 10 * n_dup_lines > n_words OR word_chars < 2 * n_words
  OR word_chars > 15 * n_words AS failed FROM f),
h AS (SELECT coalesce(source, '') AS host, count(*) AS docs, sum(CASE WHEN failed THEN 1 ELSE 0 END) AS failures FROM g GROUP BY 1),
p AS (SELECT avg(failures / docs::DOUBLE) AS mu, greatest(var_pop(failures / docs::DOUBLE), 1e-6) AS v FROM h),
s AS (SELECT host, (failures + mu * k) / (docs + k) AS shrunk FROM
  (SELECT host, docs, failures, mu, least(greatest(mu * (1 - mu) / v - 1, 2.0), 1000.0) AS k FROM h, p))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (shrunk < 0.3 OR (NOT failed AND shrunk < 0.9)) AS kept
FROM g JOIN s ON s.host = coalesce(g.source, '')
"""
