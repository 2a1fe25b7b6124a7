"""Writers of stage tables, reports and exports. Parquet is the working format; text forms are for people and tools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_typed_csv(df: DataFrame, path: str, formats: dict[str, str] | None = None) -> None:
    """Floats as %.1f or by their own format, nested values as JSON."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.col(f.name).isNotNull(), F.format_string((formats or {}).get(f.name, "%.1f"), f.name)).alias(f.name))
        else:
            out.append(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name))
    df.select(*out).write.option("header", True).csv(path)


def write_stage_table(df: DataFrame, folder: str, stage: str) -> None:
    df.write.partitionBy("sample").parquet(f"{folder}/{stage}")


def write_junction_fasta(junctions: DataFrame, path: str) -> None:
    """A folder per candidate with its junctions' records (candidate, junction, junction_type, seq)."""
    junctions.repartition("candidate").sortWithinPartitions("candidate", "junction").select("candidate", F.concat(F.lit(">"), "junction_type", F.lit("\n"), "seq")).write.partitionBy("candidate").text(path)


def write_jc_read_counts(counts: DataFrame, path: str) -> None:
    counts.write.partitionBy("sample", "candidate").option("header", True).csv(path)


def write_read_buckets(hits: DataFrame, path: str) -> None:
    """Hits (arrays of a read's alignments are flattened) by junction and read type, as tabbed lines that
    readers.scan_read_buckets(written=True) reads."""
    rows = hits.withColumn("hit", F.explode("hits")).select("junction", "read_type", "read_id", "is_reverse", "hit.*") if "hits" in hits.columns else hits
    rows.select("junction", "read_type", "read_id", "start", "end", "is_reverse", "aln_index").write.partitionBy("junction", "read_type").option("sep", "\t").csv(path)


def write_summary(amplicons: DataFrame, transpositions: DataFrame, path: str, runs: DataFrame | None = None) -> None:
    """One JSON text per sample with its amplicons and transpositions, in the order of their pairs. ``runs`` (sample, anc, ref,
    read_length, anc_read_length) gives the block about the sample, and samples without either."""

    def lists(df: DataFrame, name: str) -> DataFrame:
        fields = [c for c in df.columns if c not in ("sample", "pair_id")]
        first = ["pair_id"] if "pair_id" in df.columns else []
        rows = df.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct(*first, F.struct(*fields).alias("row")))).alias(name))
        return rows.withColumn(name, F.transform(name, lambda x: x["row"]))

    both = lists(amplicons, "amplicons").join(lists(transpositions, "transpositions"), "sample", "full_outer")
    told = F.col("sample")
    if runs is not None:
        both = runs.join(both, "sample", "left")
        lengths = F.struct(F.col("read_length").alias("isolate"), F.col("anc_read_length").alias("ancestor"))
        told = F.struct(F.col("sample").alias("isolate"), F.col("anc").alias("ancestor"), F.col("ref").alias("reference"), lengths.alias("read_lengths"))
    lists_of = [F.coalesce(F.col(c), F.array().cast(both.schema[c].dataType)).alias(c) for c in ("amplicons", "transpositions")]
    both.select(F.to_json(F.struct(told.alias("sample"), *lists_of)).alias("value")).write.text(path)


def append_run_status(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def write_location_diffs(diffs: DataFrame, path: str) -> bool:
    """Lines of differences; nothing is written when there are none."""
    if diffs.isEmpty():
        return False
    diffs.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in diffs.columns])).write.text(path)
    return True
