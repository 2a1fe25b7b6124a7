"""Quality rules on documents, judged by host as well.

Each text gets its counts (words, symbols, repeated lines and word runs) and fails any of four rules. Failures are
aggregated by host (``source``), each host's rate is shrunk towards the others with a beta prior fitted to the hosts'
rates by moments, and hosts whose shrunk rate is above ``HOST_RATE`` are rejected with all their documents. Documents
that fail a base rule are rejected whatever their host.

Nulls count as empty texts, a null source is a host of its own, and empty texts fail the base rule. Repeated rows and
ids are judged one by one. An empty table gives no rows. A source is summed by partial aggregates, so one that holds a
third of the rows costs no task more than the others.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from junctionflow.llm.common import any_columns, documents, materialise, ngrams, rewrite, utf8, word_hashes

MIN_WORDS = 50
#: Per cent of words in repeated three-word runs, and of lines and symbols to words, above which a document fails.
REPEAT_PERCENT, LINE_PERCENT, SYMBOL_PERCENT = 50, 30, 20
HOST_RATE = 0.6
#: Rejected hosts up to which they are sent to every task; beyond it they are joined by a shuffle.
HOSTS_SENT = 10_000

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
NAMES = [c.split()[0] for c in COUNTS.split(", ")]
_SPACE, _SYMBOLS, _CONTINUED = b" \t\n\r\x0b\x0c", b"#*$%&|<>", bytes(range(0x80, 0xC0))


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = word_hashes(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 3:
        grams = ngrams(words, 3)
        order = np.argsort(grams)
        same = np.r_[False, grams[order[1:]] == grams[order[:-1]], False]
        if same.any():
            hit = np.zeros(len(grams), bool)
            hit[order] = same[1:] | same[:-1]
            covered = np.zeros(len(words), bool)
            for i in range(3):
                covered[i : i + len(hit)] |= hit
            repeated = int(covered.sum())
    return len(words), len(text.translate(None, _CONTINUED + _SPACE)), len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated


def with_counts(docs: DataFrame) -> DataFrame:
    """docs, and the counts of each text."""

    def per_batch(__text):
        rows = [text_counts(t) for t in __text]
        return {c.split()[0]: [r[i] for r in rows] for i, c in enumerate(COUNTS.split(", "))}

    return rewrite(docs.drop(*NAMES).withColumn("__text", utf8()), ["__text"], per_batch, COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def failed() -> Column:
    """Fails a base rule, or has too many symbols or repeated lines for its words."""
    return base_failed() | (100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words")) | (100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_words"))


def host_rates(counted: DataFrame) -> DataFrame:
    """host, n, n_failed, rate: a row for each source, its rate shrunk by the prior that all the hosts give."""
    hosts = counted.groupBy(F.col("source").alias("host")).agg(F.count("*").alias("n"), F.sum(failed().cast("long")).alias("n_failed"))
    raw = F.col("n_failed") / F.col("n")
    prior = hosts.agg(F.avg(raw).alias("m"), F.var_pop(raw).alias("v"))
    # a beta with mean m and variance v has m(1 - m)/v - 1 pseudo-rows; at least one, at most a thousand
    weight = F.greatest(F.lit(1.0), F.least(F.lit(1000.0), F.coalesce(F.try_divide(F.col("m") * (1 - F.col("m")), F.col("v")), F.lit(1001.0)) - 1))
    return hosts.join(F.broadcast(prior), how="left").select("host", "n", "n_failed", ((F.col("n_failed") + weight * F.col("m")) / (F.col("n") + weight)).alias("rate"))


def with_verdicts(counted: DataFrame, judged: DataFrame | None = None) -> DataFrame:
    """counted rows with base_failed and kept; ``judged``: the rows whose hosts are judged, counted itself if None."""
    rejected = host_rates(counted if judged is None else judged).filter(F.col("rate") > HOST_RATE).select(F.col("host").alias("_host"), F.lit(True).alias("_out"))
    rejected = materialise(rejected)
    if rejected.count() <= HOSTS_SENT:
        rejected = F.broadcast(rejected)
    out = counted.join(rejected, F.col("source").eqNullSafe(F.col("_host")), "left")
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & F.col("_out").isNull()).drop("_host", "_out")


@any_columns
def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns. Words are counted once, and hosts judged from the counts."""
    counted = materialise(with_counts(docs))
    return with_verdicts(counted).filter("kept").select(*docs.columns)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = materialise(with_counts(documents(spark, sf_dir).select("doc_id", "source", "text")).drop("text"))
    return with_verdicts(counted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)),
grams AS (SELECT doc_id, k, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
twice AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, gram) > 1 AS hit FROM grams WHERE gram IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS place FROM twice WHERE hit) GROUP BY doc_id),
sizes AS (SELECT doc_id, count(*) AS n, sum(length(word)) AS chars FROM words GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, d.source, CAST(coalesce(s.n, 0) AS BIGINT) AS n_words, CAST(coalesce(s.chars, 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM counted),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR 100 * n_symbols > {SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {LINE_PERCENT} * n_words) AS bad
  FROM judged GROUP BY source),
prior AS (SELECT avg(bad / n) AS m, greatest(1, least(1000, coalesce(avg(bad / n) * (1 - avg(bad / n)) / nullif(var_pop(bad / n), 0), 1001) - 1)) AS k FROM hosts),
rates AS (SELECT source, (bad + k * m) / (n + k) AS rate FROM hosts, prior)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= {HOST_RATE} AS kept
FROM judged j JOIN rates r ON j.source IS NOT DISTINCT FROM r.source
"""
