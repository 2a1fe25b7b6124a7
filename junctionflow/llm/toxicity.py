"""Toxicity: character n-grams scaled by naive Bayes log-count ratios, under a linear classifier.

Features are the runs of three to eight characters of the text in lower case (white space folded to a blank), hashed to
2^20 places; a feature's value is the log of its count, log2(1 + n). Each is scaled by the log of the share of toxic rows
that hold it over the share of the others, and the classifier learns weights for the scaled features; place 0 is the
constant. Each share is smoothed by PRIOR_ROWS rows dealt to the classes as they stand, so that a place nobody holds says
nothing whatever the classes' sizes. Labels, languages, sources and ids are no features.

Nulls count as empty texts, which score by the constant alone. Without labels every score is 0.5. Long texts are taken in
parts of PART characters that overlap. Repeated rows and ids are scored one by one; other columns are not read, whatever
their names. An empty table gives no rows. ``linear.SAMPLE_ROWS`` bounds the rows to learn from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from junctionflow.llm import linear
from junctionflow.llm.common import documents, materialise

BITS, SIZES, THRESHOLD = 20, range(3, 9), 0.5
#: Ratios nearer to 0 than this say nothing and are left out. Both figures were chosen on folds of the rows to learn from.
LEAST_RATIO, PRIOR_ROWS = 1.0, 32
#: Characters whose n-grams are hashed at a time.
PART = 1 << 20


def grams(text: bytes) -> Iterator[np.ndarray]:
    """The places of the text's n-grams, as often as they occur, some at a time."""
    folded = f" {' '.join(text.decode(errors='replace').lower().split())} "
    for begin in range(0, len(folded), PART):
        data = np.frombuffer(folded[begin : begin + PART + max(SIZES) - 1].encode("utf-32-le"), np.uint32)
        rolled = data
        for n in range(2, max(SIZES) + 1):
            if len(data) < n:
                break
            rolled = rolled[: len(data) - n + 1] * np.uint32(0x01000193) + data[n - 1 :]
            if n in SIZES:
                h = (rolled[:PART] ^ (rolled[:PART] >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
                yield (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS)


def ratios(rows: DataFrame) -> np.ndarray:
    """The log-count ratio of each place, 0 where it says nothing."""
    schema = pa.schema([("label", pa.int32()), ("n", pa.int64()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((2, 1 << BITS), np.int32), [0, 0]
        for batch in batches:
            for text, label in zip(*(batch.column(c).to_pylist() for c in ("text", "label")), strict=True):
                seen = np.zeros(1 << BITS, bool)
                for g in grams(text):
                    seen[g] = True
                counts[int(label > 0)] += seen
                n[int(label > 0)] += 1
        for label in (0, 1):
            if n[label]:
                yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([n[label]], pa.int64()), pa.array([counts[label].astype("<i4").tobytes()], pa.binary())], schema=schema)

    total, n = np.zeros((2, 1 << BITS)), np.zeros(2)
    # the sample is dealt to GROUPS tasks: at most two rows of fixed size from each
    for r in rows.select("text", "label").coalesce(linear.GROUPS).mapInArrow(run, "label int, n long, counts binary").collect():
        total[r.label] += np.frombuffer(r.counts, "<i4")
        n[r.label] += r.n
    if not n.all():
        return np.zeros(1 << BITS)
    share = (total + (PRIOR_ROWS * n / n.sum())[:, None]) / n[:, None]
    out = np.log(share[1] / share[0])
    return np.where((np.abs(out) >= LEAST_RATIO) & (np.arange(1 << BITS) > 0), out, 0.0)


def scaled(r: np.ndarray):
    def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        told = [np.empty(0, np.uint32), *(g[r[g] != 0] for g in grams(text))]
        at, n = np.unique(np.concatenate(told), return_counts=True)
        return np.concatenate([[0], at.astype(np.int64)]), np.concatenate([[1.0], r[at] * np.log2(1 + n)])

    return features


def score_documents(docs: DataFrame, labels: DataFrame, target: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    rows = materialise(linear.training_rows(docs, labels, target))
    r = ratios(rows).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast(r)  # of fixed size
    weights = linear.train(rows, lambda text: scaled(sent.value)(text), 1 << BITS, alpha=0.1, l1=0.0, l2=1.0)
    return linear.score(docs, lambda text: scaled(sent.value)(text), weights, threshold)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
