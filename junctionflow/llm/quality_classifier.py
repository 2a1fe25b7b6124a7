"""Quality classifier: hashed word n-grams, follow-the-regularised-leader logistic regression, sparse dot products.

Features are the single words and word pairs of a text, and the same of the words' shapes (letters by case, digits,
punctuation), each hashed to one of 2^18 places and counted once. A feature's value is one over the square root of
their number; place 0 is the constant. Labels, languages, sources and ids are no features.

Nulls count as empty texts, which score by the constant alone. Without labels every score is 0.5. Repeated rows and ids
are scored one by one; other columns are not read. ``linear.SAMPLE_ROWS`` bounds the rows to learn from.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from junctionflow.llm import linear
from junctionflow.llm.common import documents, ngrams

BITS = 18
#: Words of one task that are remembered with their hashes; beyond it the memory starts afresh.
WORDS_KEPT = 200_000
THRESHOLD = 0.3
_SHAPE = bytes(ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


class _Words(dict):
    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = out = (xxhash.xxh3_64_intdigest(word), xxhash.xxh3_64_intdigest(_RUNS.sub(rb"\1", word.translate(_SHAPE)), 1))
        return out


_WORDS = _Words()


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    words = text.split()
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    h = np.array(list(map(_WORDS.__getitem__, words)), np.uint64)
    raw, shape = h[:, 0].copy(), h[:, 1].copy()
    every = np.concatenate([ngrams(raw, 1), ngrams(raw, 2), ngrams(shape, 1), ngrams(shape, 2), ngrams(shape, 3)])
    places = np.unique((every >> np.uint64(64 - BITS)).astype(np.int64))
    places = np.concatenate([[0], places[places > 0]])
    x = np.full(len(places), 1 / np.sqrt(len(places)))
    x[0] = 1.0
    return places, x


def score_documents(docs: DataFrame, labels: DataFrame, target: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    weights = linear.train(linear.training_rows(docs, labels, target), features, 1 << BITS, alpha=1.0, l2=0.1)
    return linear.score(docs, features, weights, threshold)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
