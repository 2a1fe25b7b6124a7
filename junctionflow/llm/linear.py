"""Logistic regression on sparse hashed features, trained by follow-the-regularised-leader updates.

Rows to learn from are labelled rows whose crc32(doc_id as text) mod 5 is not 0. Of these a bounded sample is used: at
most about ``cap`` rows, chosen by a hash of the id. They are dealt to groups, one for every GROUP_ROWS and GROUPS at most.
Each trains a model of its own in one task, bounded by cap / groups rows, over so many epochs that about UPDATES are
made, and the weights are averaged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from junctionflow.llm.common import utf8

#: Labelled rows to learn from, at most (give or take the luck of hashing), and models that are averaged, at most.
SAMPLE_ROWS, GROUPS = 16_000, 8
#: Rows that make a group, and updates of a model.
GROUP_ROWS, UPDATES = 2_000, 10_000

Features = Callable[[bytes], tuple[np.ndarray, np.ndarray]]


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, target: str, cap: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, label, part: the sample. Of several labels of an id the larger counts; null labels are skipped."""
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(target).cast("int").alias("label"))
    n = known.count()
    limit, groups = int(min(1.0, cap / max(1, n)) * (1 << 31)), int(np.clip(n // GROUP_ROWS, 1, GROUPS))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 31)) < limit)
    # about ``cap`` rows of an id and a label whatever the size of the tables, hence the broadcast
    found = docs.select("doc_id", utf8().alias("text")).join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))  # a repeated id teaches once
    return found.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(groups)).cast("int"))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for i, x, y in rows:
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            ni = n[i]
            z[i] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[i] = ni + g * g
    return weights(np.arange(size))


def train(rows: DataFrame, features: Features, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.0, l2: float = 1.0) -> np.ndarray:
    """The mean weights; zeros when there is nothing to learn from."""

    def per_group(table: pa.Table) -> pa.Table:
        order = np.argsort([hash(i) * 2654435761 % (1 << 32) for i in table["doc_id"].to_pylist()], kind="stable")
        texts, labels = table["text"].to_pylist(), table["label"].to_pylist()
        w = ftrl([(*features(texts[k]), labels[k]) for k in order], size, int(np.clip(-(-UPDATES // len(order)), 3, 30)), alpha, beta, l1, l2)
        return pa.table({"w": [w.astype("<f4").tobytes()]}, pa.schema([("w", pa.binary())]))

    found = rows.groupBy("part").applyInArrow(per_group, "w binary").collect()  # at most GROUPS rows of fixed size
    return np.mean([np.frombuffer(r.w, "<f4") for r in found], axis=0).astype(np.float32) if found else np.zeros(size, np.float32)


def score(docs: DataFrame, features: Features, weights: np.ndarray, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            scores = []
            for text in batch.column(1):
                i, x = features(text.as_py())
                scores.append(1 / (1 + np.exp(-np.clip(float(w[i] @ x), -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], schema=schema)

    scored = docs.select("doc_id", utf8().alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
