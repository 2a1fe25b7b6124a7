"""Merkle-tree fingerprints of documents, with DataFrame functions only.

A text is a tree: paragraphs (lines) are cut into runs of eight words, the leaves, each with a 64-bit hash. A
paragraph's hash is that of its leaves' hashes, a section's that of its eight paragraphs' hashes, and the root is the
SHA-256 of all sections' hashes (128 bits of it). The fingerprint is the text ``root;sections;paragraphs;leaves``. Equal
texts have equal roots, and equal roots mean equal texts as far as 64-bit hashes can tell; otherwise sections and then
paragraphs that differ tell where the texts differ, and the share of leaves that two texts have in common (twice the
common ones over all of both, as sets) is their likeness.

Null texts count as empty. An empty text has one empty paragraph and no leaf; it is like another empty text (1.0) and
nothing else (0.0). Rows with equal doc_id are ordered by the hash of their text. An empty table gives no rows; the
next document of a single row is the row itself. Rows with one doc_id share a range. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from junctionflow.llm.common import documents

LEAF_WORDS, SECTION = 8, 8
#: Rows that share a range of doc_id, and ranges at most, whose ends are sent to every task (1 MB). Of more rows a range
#: holds more, in a window that spills. The ends are taken from so many sampled ids a range; they only deal the rows out.
RANGE_ROWS, RANGES, SAMPLED = 1000, 1 << 17, 32


def _hashed(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.xxhash64(value)), 16, "0"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column that is not null."""
    leaf = F.lit(f"(?:[^ ]++ *+| ++){{1,{LEAF_WORDS}}}")
    # one text for each paragraph: the hashes of its leaves
    leaves = F.transform(F.split(text, "\n", -1), lambda p: F.array_join(F.transform(F.regexp_extract_all(p, leaf, F.lit(0)), _hashed), " "))

    def of_sections(sections: Column, paragraphs: Column, leaves: Column) -> Column:
        root = F.substring(F.sha2(F.array_join(sections, " ").cast("binary"), 256), 1, 32)
        return F.concat_ws(";", root, F.array_join(sections, " "), F.array_join(paragraphs, " "), F.regexp_replace(F.trim(F.array_join(leaves, " ")), " +", " "))

    def of_paragraphs(paragraphs: Column, leaves: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(paragraphs) - 1) / SECTION).cast("int"))
        sections = F.transform(numbers, lambda i: _hashed(F.array_join(F.slice(paragraphs, i * SECTION + 1, SECTION), " ")))
        return _let(sections, lambda s: of_sections(s, paragraphs, leaves))

    return _let(leaves, lambda x: _let(F.transform(x, _hashed), lambda p: of_paragraphs(p, x)))


def likeness(left: Column, right: Column) -> Column:
    """0 to 1, from two fingerprints."""
    a, b = (F.array_distinct(F.filter(F.split(F.substring_index(x, ";", -1), " "), lambda v: v != "")) for x in (left, right))

    def dice(pair: Column) -> Column:
        return F.coalesce(F.try_divide(2.0 * F.size(F.array_intersect(pair["a"], pair["b"])), F.size(pair["a"]) + F.size(pair["b"])), F.lit(0.0))

    return F.when(left == right, 1.0).otherwise(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), dice)[0])


def differing_paragraphs(left: Column, right: Column) -> Column:
    """0-based numbers of the paragraphs whose hashes differ between two fingerprints, found below differing sections; a
    paragraph that only one text has differs."""
    part = lambda x, i: F.split(F.split(x, ";")[i], " ")
    differ = lambda i: F.zip_with(part(left, i), part(right, i), lambda a, b: ~a.eqNullSafe(b))

    def below(branch: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(branch["paragraphs"]) - 1)
        return F.filter(numbers, lambda i: F.get(branch["sections"], F.floor(i / SECTION).cast("int")) & F.get(branch["paragraphs"], i))

    found = _let(F.struct(differ(1).alias("sections"), differ(2).alias("paragraphs")), below)
    return F.when(left == right, F.array().cast("array<int>")).otherwise(found)


def ends_below(ends: list[int], value: Column) -> Column:
    """How many of the ascending ``ends`` are less than a value, by bisection."""
    if not ends:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(ends).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(F.lit(ends), n + step - 1) < value, n + step).otherwise(n))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """docs with ``next_<c>`` of the next row in descending doc_id for each carried column; the first row follows the last.

    Ranges of doc_id are sorted one by one. The first row of each range is sent to the range before it as well, so that
    no task sees all rows; ranges' first ids are bounded in number (RANGES).
    """
    n = docs.count()
    ranges = max(1, min(RANGES, n // RANGE_ROWS))
    sampled = docs.select("doc_id").sample(min(1.0, SAMPLED * ranges / max(1, n)), seed=7)
    ends = sampled.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).head()[0] if ranges > 1 else []
    ends = sorted(set(ends or []))
    number = ends_below(ends, F.col("doc_id"))
    ranged = docs.withColumn("_range", F.when(F.col("doc_id").isNull(), 0).otherwise(number))
    heads = ranged.groupBy("_range").agg(F.max("doc_id").alias("_head")).orderBy("_range").collect()
    to = docs.sparkSession.createDataFrame([(h._range, h._head, heads[(i + 1) % len(heads)]._range) for i, h in enumerate(heads)], "_range int, _head long, _to int")
    own = F.struct(F.col("_range").alias("at"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_to").alias("at"), F.lit(True).alias("guest"))
    dealt = ranged.join(F.broadcast(to), "_range").withColumn("_place", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("_head")), F.array(own, guest)).otherwise(F.array(own))))
    following = Window.partitionBy("_place.at").orderBy("_place.guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    out = dealt.select("*", *[F.lead(c).over(following).alias(f"next_{c}") for c in carried])
    return out.filter(~F.col("_place.guest")).drop("_range", "_head", "_to", "_place")


def edit_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_paragraphs (the numbers
    of those that the two trees tell apart)."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("fingerprint", fingerprint(F.col("text")))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = with_next(own, ["text", "fingerprint"]).withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("_edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring(F.col("next_text"), F.lit(1), third)))
    rows = rows.select("doc_id", "n_chars", "fingerprint", "next_fingerprint", "_edited").withColumn("edited_fingerprint", fingerprint(F.col("_edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        differing_paragraphs(F.col("fingerprint"), F.col("edited_fingerprint")).alias("edited_paragraphs"),
    )


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(documents(spark, sf_dir))
