"""A corpus from documents: rules, line dedup, one document of each near-duplicate group, suffix dedup, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from junctionflow.llm import jaccard_join, line_dedup, packing, quality_rules, suffix_dedup
from junctionflow.llm.common import Tables, documents

#: Repeated rows are judged one by one (near_copies keeps one of them), texts may be of any length, columns beside those of
#: documents pass through the stages whatever their names, and an empty table gives an empty table.
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules and their hosts' verdicts keep. Null and empty texts fail the rules."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later repeats of runs of lines out of their texts. Null texts stay null, empty ones empty."""
    return line_dedup.dedup_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id; texts without words are near none and stay."""
    return jaccard_join.dedup_documents(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, strings of 400 bytes that occur elsewhere out of their texts. Null texts stay null, empty ones empty."""
    return suffix_dedup.dedup_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096-token sequences with their ids (little-endian, 32 bits each); a null text is a lone end id."""
    return packing.pack(packing.tokenise(docs))


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("repeats", repeats), ("packed", packed)]

#: SQL has no subword tokenizer. The stages, one after another, and run() are tested against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's table is written, and the one before it dropped with what the stage has left; the last stage writes what its result is read from."""
    docs = documents(spark, sf_dir)
    with Tables(spark) as tables:
        for _, stage in STAGES[:-1]:
            before, docs = docs, tables.write_alone(partial(stage, spark, docs, sf_dir))
            tables.drop(before)
        return STAGES[-1][1](spark, docs, sf_dir)
