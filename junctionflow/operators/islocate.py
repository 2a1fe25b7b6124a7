"""Where insertion elements lie: annotated features, alignment hits, and comparison of two methods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def is_features(features: DataFrame) -> DataFrame:
    """ref, scaf, tn_name, start, end, orientation of insertion-sequence features (type, qualifiers map, start0, end, strand)."""
    note = F.when(F.col("type") == "mobile_element", F.col("qualifiers")["mobile_element_type"][0]).when(F.col("type").isin("misc_feature", "repeat_region"), F.col("qualifiers")["note"][0])
    named = features.withColumn("_note", note).filter(F.lower("_note").contains("insertion sequence"))
    first, second = F.regexp_extract("_note", r"(?i)insertion sequence[:\s]*(\S+)", 1), F.regexp_extract("_note", r"(?i)(IS\d+\w*)", 1)
    name = F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")), F.lit("unknown"))
    return named.select("ref", "scaf", name.alias("tn_name"), (F.col("start0") + 1).alias("start"), "end", F.when(F.col("strand") < 0, -1).otherwise(1).alias("orientation"))


def assign_tn_id(elements: DataFrame, start: int = 1) -> DataFrame:
    """tn_id in source order (scaf, start, end, name) within each reference."""
    order = Window.partitionBy("ref").orderBy("scaf", "start", "end", "tn_name")
    return elements.withColumn("tn_id", F.row_number().over(order) + (start - 1)).withColumn("join", F.lit(False))


def apart_by(*tables: DataFrame) -> list[str]:
    """The columns that keep cohorts and methods apart, of those that all tables have."""
    return [c for c in ("sample", "ref", "method") if all(c in t.columns for t in tables)]


def dedup_hits(hits: DataFrame, by_query: bool = True) -> DataFrame:
    """The first hit, in file order, of each (query, qstart, qend)."""
    keys = apart_by(hits) + (["query"] if by_query else []) + ["qstart", "qend"]
    return hits.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("hit_id"))).filter("_n = 1").drop("_n")


def attach_subject_length(hits: DataFrame, subjects: DataFrame) -> DataFrame:
    """hits with subject_length (0 when missing) from subjects (subject, length)."""
    return hits.join(subjects.select("subject", F.col("length").alias("subject_length")), "subject", "left").fillna(0, ["subject_length"])


def group_overlapping(hits: DataFrame, running_max: bool = False) -> DataFrame:
    """hit_group: a new one wherever qstart lies after the previous hit's qend (or the farthest so far)."""
    order = Window.partitionBy(*apart_by(hits), "query").orderBy("qstart", "bitscore", "hit_id")
    end = F.max("qend").over(order.rowsBetween(Window.unboundedPreceding, -1)) if running_max else F.lag("qend").over(order)
    new = (F.col("qstart") - end > 0).cast("int")
    return hits.withColumn("_new", F.coalesce(new, F.lit(1))).withColumn("hit_group", F.sum("_new").over(order)).drop("_new")


def best_of_group(hits: DataFrame) -> DataFrame:
    """The hit whose query span is nearest to its subject's length; the first in order on a tie."""
    miss = F.abs((F.col("qend") - F.col("qstart")) - F.col("subject_length"))
    order = Window.partitionBy(*apart_by(hits), "query", "hit_group").orderBy(miss, "qstart", "bitscore", "hit_id")
    return hits.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def filter_subject_coverage(hits: DataFrame, least: float = 0.9) -> DataFrame:
    return hits.filter(F.try_divide(F.abs(F.col("sstart") - F.col("send")), F.col("subject_length")) > least)


def orient_hits(hits: DataFrame) -> DataFrame:
    return hits.withColumn("orientation", F.when(F.col("sstart") > F.col("send"), -1).otherwise(1))


def elements_from_hits(hits: DataFrame, subjects: DataFrame) -> DataFrame:
    return orient_hits(filter_subject_coverage(best_of_group(group_overlapping(attach_subject_length(dedup_hits(hits), subjects)))))


def normalise_isescan(rows: DataFrame) -> DataFrame:
    """scaf, tn_name, start, end, orientation, swapped from (seqID, isBegin, isEnd, strand, family, cluster)."""
    clean = lambda c: F.when(~F.lower(F.trim(c)).isin("", "nan", "none", "na", "n/a"), F.trim(c))
    family, cluster = clean(F.col("family")), clean(F.col("cluster"))
    name = F.coalesce(F.nullif(F.concat_ws(":", family, cluster), F.lit("")), F.lit("unknown"))
    return rows.select(
        F.col("seqID").alias("scaf"), name.alias("tn_name"), F.least("isBegin", "isEnd").alias("start"), F.greatest("isBegin", "isEnd").alias("end"),
        F.when(F.trim("strand").isin("-", "-1", "reverse", "rev"), -1).otherwise(1).alias("orientation"), (F.col("isBegin") > F.col("isEnd")).alias("swapped"),
    )


def compare_locations(a: DataFrame, b: DataFrame, tolerance: int = 50) -> DataFrame:
    """kind, scaf, tn_id, other_id, start_delta, end_delta: how b differs from a (both tn_id, tn_name, scaf, start, end), after
    the columns that keep rows apart (sample, ref, method), where both have them.

    A band join: starts are binned by the tolerance and each row of a looks into three bins.
    """
    width, keys = tolerance + 1, apart_by(a, b)
    left = a.withColumn("_bin", F.explode(F.array(*[F.floor(F.col("start") / width) + d for d in (-1, 0, 1)]))).alias("a")
    right = b.withColumn("_bin", F.floor(F.col("start") / width)).alias("b")
    near = (F.abs(F.col("b.start") - F.col("a.start")) <= tolerance) & (F.abs(F.col("b.end") - F.col("a.end")) <= tolerance)
    for c in [*keys, "scaf", "_bin"]:
        near = near & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    pairs = left.join(right, near).select(
        *[F.col(f"a.{c}").alias(c) for c in keys], F.col("a.scaf").alias("scaf"), F.col("a.tn_id").alias("tn_id"), F.col("b.tn_id").alias("other_id"), (F.col("a.tn_name") == F.col("b.tn_name")).alias("same"),
        (F.col("b.start") - F.col("a.start")).alias("start_delta"), (F.col("b.end") - F.col("a.end")).alias("end_delta"), F.count("*").over(Window.partitionBy(*[f"a.{c}" for c in keys], "a.tn_id")).alias("n"),
    )
    best = pairs.withColumn("_k", F.row_number().over(Window.partitionBy(*keys, "tn_id").orderBy(F.desc("same"), "other_id"))).filter("_k = 1")
    row = lambda df, kind: df.select(*keys, F.lit(kind).alias("kind"), "scaf", "tn_id", "other_id", "start_delta", "end_delta")
    void = [F.lit(None).cast("long").alias(c) for c in ("start_delta", "end_delta")]
    lost = a.join(pairs.select(*keys, "tn_id"), [*keys, "tn_id"], "left_anti").select(*keys, "scaf", "tn_id", F.lit(None).cast("long").alias("other_id"), *void)
    extra = b.join(pairs.select(*keys, F.col("other_id").alias("tn_id")), [*keys, "tn_id"], "left_anti").select(*keys, "scaf", F.lit(None).cast("long").alias("tn_id"), F.col("tn_id").alias("other_id"), *void)
    return row(lost, "not found").unionByName(row(extra, "not found in first")).unionByName(row(best.filter("n > 1"), "multiple")).unionByName(row(best.filter("NOT same"), "name")).unionByName(row(best.filter("start_delta <> 0 OR end_delta <> 0"), "ends"))


def select_method_result(found: DataFrame, main: str, compared: list[str]) -> tuple[DataFrame, DataFrame]:
    """The elements that the main method found, and how those of each compared method (column method of the second table)
    differ from them. found: ref, method, tn_id, tn_name, scaf, start, end. A reference in which the main method found none is
    an error, raised when the first table is read."""
    chosen = found.filter(F.col("method") == main)
    without = found.select("ref").distinct().join(chosen.select("ref").distinct(), "ref", "left_anti")
    fail = F.raise_error(F.concat(F.lit(f"no element by {main} in "), F.coalesce("ref", F.lit("null"))))
    failing = without.select(*[(fail if f.name == "ref" else F.lit(None)).cast(f.dataType).alias(f.name) for f in found.schema])
    others = found.filter(F.col("method").isin(compared))
    against = chosen.withColumn("method", F.explode(F.array(*[F.lit(m) for m in compared]).cast("array<string>")))
    return chosen.unionByName(failing), compare_locations(against, others)
