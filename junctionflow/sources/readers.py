"""Readers of the files that sequencing tools leave, as DataFrames, and the schema checks on them."""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Callable, Iterator
from itertools import batched, islice
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLAST = "query string, subject string, percent_identical double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
#: Positional fields of the record types that are kept (fixed values).
GENOMEDIFF = {
    "JC": ["type", "num", "dot", "scaf1", "pos1", "dir1", "scaf2", "pos2", "dir2", "zero"],
    "SNP": ["type", "num", "support", "scaf", "pos1", "var1"],
    "MOB": ["type", "num", "support", "scaf", "pos1", "IS", "num1", "num2"],
    "DEL": ["type", "num", "support", "scaf", "pos1", "length"],
    "UN": ["type", "num", "support", "scaf", "pos1", "pos2"],
}


#: Reads that a task hands on at a time.
FASTQ_BATCH = 50_000


def sample_of() -> Column:
    """The sample that a file belongs to: its folder, or the one above where that is a folder of results."""
    return F.regexp_extract(F.input_file_name(), r"([^/]+)/(?:(?:output|data|08_mutation_identification)/)?[^/]+$", 1)


class FastqSource(DataSource):
    """Reads of FASTQ files (paths, one a line; limit; conf), a partition for each file, decompressed from the file system as a
    stream: no file is held whole, and with a limit only its head is read."""

    @classmethod
    def name(cls) -> str:
        return "fastq_reads"

    def schema(self) -> str:
        return "file string, id string, seq string, qual string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FastqReader(self.options)


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, limit = options["files"].split("\n"), options.get("limit")
        self.limit = int(limit) if limit else None

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.files]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(c, pa.string()) for c in ("file", "id", "seq", "qual")])
        with open_stream(partition.value) as raw:
            head = raw.peek(2)[:2]
            lines = (x.rstrip("\r\n") for x in io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if head == b"\x1f\x8b" else raw))
            found = (r for r in islice(batched(lines, 4), self.limit) if len(r) == 4)
            for some in batched(found, FASTQ_BATCH):
                ids, seqs, _, quals = zip(*some, strict=True)
                yield pa.RecordBatch.from_pydict({"file": [partition.value] * len(ids), "id": [x[1:].split(" ")[0] for x in ids], "seq": seqs, "qual": quals}, schema=kinds)


def open_stream(path: str) -> io.BufferedReader:
    """A file as a buffered stream: local ones by Python, others by Arrow's file systems (HDFS, S3, GCS)."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return open(unquote(re.sub(r"^file:/+", "/", path)), "rb")  # noqa: SIM115
    system, place = pa.fs.FileSystem.from_uri(path)
    return io.BufferedReader(system.open_input_stream(place, compression=None))


def scan_fastq(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """file, id, seq, qual, up to ``limit`` reads a file. Records are four lines, so a file is one partition; an unfinished last
    record is left out. Files may be of any size."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.fastq*").load(path).select("path")
    files = [r.path for r in found.collect()]  # names alone, one for each partition
    if not files:
        return spark.createDataFrame([], "file string, id string, seq string, qual string")
    spark.dataSource.register(FastqSource)
    rows = spark.read.format("fastq_reads").option("files", "\n".join(sorted(files)))
    return (rows.option("limit", limit) if limit is not None else rows).load()


def scan_genbank(spark: SparkSession, path: str, with_ref: bool = False) -> DataFrame:
    """scaf (LOCUS name), topology, seq in capitals, length, and features: array of struct(type, start0, end, strand,
    qualifiers map<string, array<string>>), with the outer ends of joined locations. A row for each record. ``with_ref``: and ref, the name of its file."""
    text = F.regexp_replace("value", "\r", "")
    ref = [F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1).alias("ref")] if with_ref else []
    rows = spark.read.option("lineSep", "\n//").text(path).select(*ref, text.alias("t")).filter(F.col("t").rlike(r"(?m)^LOCUS\s"))
    locus = F.regexp_extract("t", r"(?m)^LOCUS\s+(.*)$", 1)
    has_seq = F.col("t").contains("\nORIGIN")
    seq = F.when(has_seq, F.upper(F.regexp_replace(F.regexp_replace(F.substring_index("t", "\nORIGIN", -1), r"^[^\n]*", ""), "[^A-Za-z]", ""))).otherwise("")
    listed = F.when(F.col("t").contains("\nFEATURES"), F.substring_index(F.substring_index(F.substring_index("t", "\nORIGIN", 1), "\nFEATURES", -1), "\nBASE COUNT", 1)).otherwise("")
    blocks = F.slice(F.split(listed, r"\n {5}(?=\S)"), 2, 1 << 30)

    def feature(block: Column) -> Column:
        parts = F.split(block, r"\n\s+/(?=\w)")
        place = F.regexp_replace(F.regexp_extract(parts[0], r"(?s)^\S+\s+(.*)$", 1), r"\s", "")
        ends = F.transform(F.regexp_extract_all(place, F.lit(r"(\d+)")), lambda x: x.cast("long"))
        pairs = F.transform(F.slice(parts, 2, 1 << 30), lambda q: F.struct(F.regexp_extract(q, r"^(\w+)", 1).alias("k"), F.regexp_replace(F.regexp_replace(F.regexp_extract(q, r"(?s)^\w+=?(.*)$", 1), r"\s*\n\s+", " "), r'^"|"\s*$', "").alias("v")))
        names = F.array_distinct(F.transform(pairs, lambda q: q["k"]))
        values = F.transform(names, lambda n: F.transform(F.filter(pairs, lambda q: q["k"] == n), lambda q: q["v"]))
        return F.struct(F.regexp_extract(parts[0], r"^(\S+)", 1).alias("type"), (F.array_min(ends) - 1).alias("start0"), F.array_max(ends).alias("end"), F.when(place.startswith("complement"), -1).otherwise(1).alias("strand"), F.map_from_arrays(names, values).alias("qualifiers"))

    return rows.select(*["ref"] * with_ref, F.split(locus, r"\s+")[0].alias("scaf"), F.nullif(F.regexp_extract(locus, r"\b(circular|linear)\b", 1), F.lit("")).alias("topology"), seq.alias("seq"), F.length(seq).alias("length"), F.transform(blocks, feature).alias("features"))


def genbank_features(records: DataFrame) -> DataFrame:
    """A row for each feature of scan_genbank, as islocate.is_features takes them once ``ref`` is added."""
    return records.select(*[c for c in ("ref", "scaf") if c in records.columns], F.inline("features"))


def reference_files(spark: SparkSession, path: str) -> DataFrame:
    """locus, format (genbank or fasta), path of the genome files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{gb,fasta}").load(path).select("path")
    return files.select(F.regexp_extract("path", r"([^/]+)\.(gb|fasta)$", 1).alias("locus"), F.when(F.col("path").endswith(".gb"), "genbank").otherwise("fasta").alias("format"), "path")


def resolve_reference(names: DataFrame, mapping: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ref_name, locus, format, path of the names that have a file; names that have none). A name is an accession of
    ``mapping`` (accession, name) or the locus itself; GenBank goes before FASTA."""
    asked = names.select("ref_name").distinct().join(mapping.select(F.col("accession").alias("ref_name"), "name").dropDuplicates(["ref_name"]), "ref_name", "left").select("ref_name", F.coalesce("name", "ref_name").alias("locus"))
    best = files.groupBy("locus").agg(F.max(F.struct("format", "path")).alias("f")).select("locus", "f.*")  # genbank is the greater word
    return asked.join(best, "locus").select("ref_name", "locus", "format", "path"), asked.join(best, "locus", "left_anti").select("ref_name", "locus")


def scan_read_buckets(spark: SparkSession, path: str, written: bool = False) -> DataFrame:
    """junction, read_type, read_id, start, end, is_reverse, index of files reads_jct_{junction}_{type}.bam_indices: tabbed
    lines; blank ones are skipped. ``written``: of the folders that sinks.write_read_buckets makes."""
    names = ["junction", "read_type", "read_id", "start", "end", "is_reverse", "index"]
    if written:
        return spark.read.schema("read_id string, start long, end long, is_reverse boolean, index long, junction int, read_type string").option("sep", "\t").csv(path).select(names)
    name, p = F.regexp_extract(F.input_file_name(), r"reads_jct_(\d+_\w+)\.bam_indices$", 1), F.split(F.trim("value"), "\t")
    rows = spark.read.option("pathGlobFilter", "reads_jct_*.bam_indices").option("recursiveFileLookup", True).text(path).filter("trim(value) <> ''")
    return rows.select(F.substring_index(name, "_", 1).cast("int").alias("junction"), F.regexp_replace(name, r"^\d+_", "").alias("read_type"), p[0].alias("read_id"), p[1].cast("long").alias("start"), p[2].cast("long").alias("end"), F.lower(p[3]).isin("true", "1").alias("is_reverse"), p[4].cast("long").alias("index"))


#: The side of the junction that each read type and each older file name stands for (fixed values).
LABELS = {"left": "left", "left_marginal": "left", "right": "right", "right_marginal": "right", "spanning": "span", "paired": "span", "green": "span"}


def read_labels(buckets: DataFrame) -> DataFrame:
    """read_id (name/index), junction, label of scan_read_buckets, as classify.read_label_confusion takes them; far types have none."""
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])[F.col("read_type")]
    return buckets.select(F.concat_ws("/", "read_id", "index").alias("read_id"), "junction", label.alias("label")).filter("label IS NOT NULL").distinct()


def scan_read_labels(spark: SparkSession, path: str, kind: str = "fastq") -> DataFrame:
    """The same of the headers of files reads_jct_{junction}_{left, right or green} in FASTA or FASTQ form. A FASTQ header is the
    first line of its record, so a quality line that begins like one is none."""
    if kind == "fastq":
        rows = scan_fastq(spark, path).select("file", F.col("id").alias("read_id"))
    else:
        lines = spark.read.option("pathGlobFilter", "reads_jct_*.fasta").text(path).filter(F.col("value").startswith(">"))
        rows = lines.select(F.input_file_name().alias("file"), F.trim(F.substring("value", 2, 1 << 30)).alias("read_id"))
    part = lambda i: F.regexp_extract("file", r"reads_jct_(\d+)_(left|right|green)\.[^/]*$", i)
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])[part(2)]
    return rows.select("read_id", part(1).try_cast("int").alias("junction"), label.alias("label")).filter("label IS NOT NULL").distinct()


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    record = F.regexp_replace("value", "^>", "")
    lines = F.split(F.regexp_replace(record, "\r", ""), "\n", 2)
    seq = F.regexp_replace(F.coalesce(F.get(lines, 1), F.lit("")), r"\s", "")
    return spark.read.option("lineSep", "\n>").text(path).filter("length(trim(value)) > 0").select(F.split(lines[0], r"\s")[0].alias("id"), seq.alias("seq"), F.length(seq).alias("length"))


def convert_value(text: Column, kind: str) -> Column:
    """NA and empty are null; whole numbers are read as decimals and cut off."""
    given = F.when(~F.trim(text).isin("NA", ""), F.trim(text))
    return given.try_cast("double").cast("long") if kind in ("int", "long") else given.try_cast(kind)


def scan_genomediff(spark: SparkSession, path: str) -> DataFrame:
    """sample, type, fields map, extra map of the kept record types; blank lines and comments are skipped."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).select(sample_of().alias("sample"), parts.alias("p")).filter(F.col("p")[0].isin(list(GENOMEDIFF)))
    place = lambda names: F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.slice("p", 1, len(names)))
    positional, options = F.lit(None).cast("map<string,string>"), F.lit(None).cast("array<string>")
    for kind, names in GENOMEDIFF.items():
        enough = (F.col("p")[0] == kind) & (F.size("p") >= len(names))
        positional, options = F.when(enough, place(names)).otherwise(positional), F.when(enough, F.slice("p", len(names) + 1, 1000)).otherwise(options)
    extra = F.map_from_entries(F.transform(F.filter(options, lambda x: x.contains("=")), lambda x: F.struct(F.substring_index(x, "=", 1), F.substring(x, F.instr(x, "=") + 1, F.length(x)))))
    return rows.select("sample", F.col("p")[0].alias("type"), positional.alias("fields"), extra.alias("extra"))


def junction_table(gd: DataFrame) -> DataFrame:
    """JC rows with typed fields; flanking_left and _right become flanking1 and 2; the rest stays in extra."""
    f, x = F.col("fields"), F.col("extra")
    typed = [convert_value(f[c], "int").alias(c) for c in ("num", "pos1", "dir1", "pos2", "dir2")]
    return gd.filter("type = 'JC'").select("sample", *typed, f["scaf1"].alias("scaf1"), f["scaf2"].alias("scaf2"), convert_value(x["flanking_left"], "int").alias("flanking1"), convert_value(x["flanking_right"], "int").alias("flanking2"), x["reject"].alias("reject"), "extra")


def scan_coverage_tab(spark: SparkSession, path: str) -> DataFrame:
    """sample, scaf (the file's name), pos, cov of *.coverage.tab files at any depth; fails where there is none."""
    try:
        rows = spark.read.option("sep", "\t").option("header", True).option("pathGlobFilter", "*.coverage.tab").option("recursiveFileLookup", True).csv(path)
    except AnalysisException as e:  # no file, no columns
        raise FileNotFoundError(f"no coverage files in {path}") from e
    cov = (F.col("unique_top_cov").try_cast("double") + F.col("unique_bot_cov").try_cast("double")).cast("int")
    return rows.select(sample_of().alias("sample"), F.regexp_extract(F.input_file_name(), r"([^/]+)\.coverage\.tab$", 1).alias("scaf"), F.col("position").try_cast("long").alias("pos"), cov.alias("cov"))


def scan_blast_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLAST).csv(path)


def scan_isescan(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    rows = spark.read.option("sep", sep).option("header", True).option("recursiveFileLookup", True).csv(path)
    missing = {"seqID", "isBegin", "isEnd", "strand", "family", "cluster"} - set(rows.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return rows.withColumns({c: F.col(c).try_cast("int") for c in ("isBegin", "isEnd")})


def find_isescan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The results for the sequence file ``name`` at any depth below a folder, from its .tsv, else its .csv; fails on none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"{name}.{{tsv,csv}}").load(folder).select("path")
    found = files.agg(F.min_by("path", F.struct(F.col("path").endswith(".csv"), "path"))).head()[0]
    if found is None:
        raise FileNotFoundError(f"no results for {name} in {folder}")
    return scan_isescan(spark, found, "\t" if found.endswith(".tsv") else ",")


def scan_alignments(spark: SparkSession, path: str) -> DataFrame:
    """Alignment lines (SAM text): 0-based half-open places, AS and NM tags, order index by (ref, start, read, flag)."""
    from junctionflow.operators.alignments import cigar_ref_length

    p = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("@"))
    out = rows.select(p[0].alias("read_id"), p[1].cast("int").alias("flag"), p[2].alias("ref"), (p[3].cast("long") - 1).alias("start"), p[5].alias("cigar"), p[9].alias("seq"), F.regexp_extract("value", r"\tAS:i:(-?\d+)", 1).try_cast("int").alias("score"), F.regexp_extract("value", r"\tNM:i:(\d+)", 1).try_cast("int").alias("mismatches"))
    out = out.withColumns({"end": F.col("start") + cigar_ref_length(F.col("cigar")), "is_reverse": F.col("flag").bitwiseAND(F.lit(16)) > 0})
    return out.withColumn("aln_index", F.row_number().over(Window.partitionBy("ref").orderBy("start", "read_id", "flag")))


def scan_run_sheet(spark: SparkSession, path: str, fields: dict[str, str], required: list[str]) -> DataFrame:
    """Typed fields of a batch table, blanks null, and errors: an array of what is wrong with the row."""
    raw = spark.read.option("header", True).csv(path)
    text = {c: F.when(F.trim(c) != "", F.trim(c)) for c in raw.columns}
    typed = {c: text[c].try_cast(fields.get(c, "string")) for c in raw.columns}
    wrong = [F.when(text[c].isNotNull() & typed[c].isNull(), F.concat(F.lit(f"{c}: not {fields[c]}: "), text[c])) for c in raw.columns if c in fields]
    wrong += [F.when(text[c].isNull() if c in raw.columns else F.lit(True), F.lit(f"{c}: missing")) for c in required]
    return raw.select(*[typed[c].alias(c) for c in raw.columns], F.array_compact(F.array(*wrong)).alias("errors"))


def scan_mapping_summary(spark: SparkSession, path: str) -> DataFrame:
    refs = F.from_json("value", "references map<string, struct<bases_mapped_to_reference: long>>")
    each = spark.read.option("wholetext", True).text(path).select(sample_of().alias("sample"), F.explode(refs["references"]).alias("ref", "v"))
    return each.select("sample", "ref", F.col("v.bases_mapped_to_reference").alias("bases"))


def mapping_totals(summaries: DataFrame, samples: DataFrame) -> DataFrame:
    """sample, mapped_bases (of its references in order), total_mapped_bases of all samples; those without a file have an empty
    list and no total. References that tell no number are left out."""
    told = summaries.filter("bases IS NOT NULL").groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("ref", "bases"))).alias("x"), F.sum("bases").alias("total_mapped_bases"))
    rows = samples.select("sample").distinct().join(told, "sample", "left")
    return rows.select("sample", F.coalesce(F.transform("x", lambda v: v["bases"]), F.array().cast("array<bigint>")).alias("mapped_bases"), "total_mapped_bases")


def schema_from_spec(spark: SparkSession, path: str) -> T.StructType:
    """A schema from a field table (fields, types, optional)."""
    kinds = {"string": "string", "double": "double", "int32": "int", "bool": "boolean", "cell": "string"}
    rows = spark.read.option("header", True).csv(path).collect()  # a field table: a row for each column
    return T.StructType([T.StructField(r.fields, T.StructType.fromDDL(f"x {kinds[r.types]}")[0].dataType, str(r.optional).lower() in ("true", "1")) for r in rows])


def enforce_schema(df: DataFrame, schema: T.StructType, check_extra: bool = True, cast: bool = True) -> DataFrame:
    """Columns of the schema in its order; fails on missing, extra or (cast=False) mistyped columns, and on values that
    do not convert or are null where they must not be."""
    missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    extra = [c for c in df.columns if c not in schema.names]
    if missing or (extra and check_extra):
        raise ValueError(f"missing columns: {missing}; extra columns: {extra}")
    out = []
    for f in schema:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        if not cast and df.schema[f.name].dataType != f.dataType:
            raise TypeError(f"{f.name} is {df.schema[f.name].dataType}, not {f.dataType}")
        given, value = F.col(f.name), F.col(f.name).try_cast(f.dataType)
        ok = given.isNull() | value.isNotNull() if f.nullable else value.isNotNull()
        out.append(F.when(ok, value).otherwise(F.raise_error(F.lit(f"bad value in {f.name}")).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def str_to_bool(text: Column) -> Column:
    low = F.lower(F.trim(text))
    return F.when(low.isin("true", "yes", "1"), True).when(low.isin("false", "no", "0"), False).when(low.isin("none", "null", "") | text.isNull(), F.lit(None).cast("boolean")).otherwise(F.raise_error(F.concat(F.lit("not a truth value: "), text)).cast("boolean"))


def parse_compound(text: Column, kind: str, optional: bool = False) -> Column:
    """Lists, tuples of one type, maps and records written as JSON or as Python literals; fails on text of another kind,
    and on nulls unless optional."""
    bare = lambda word: rf"""{word}(?=[^'"]*(?:(?:'[^']*'|"[^"]*")[^'"]*)*$)"""  # outside of quotes
    made = text
    for word, by in ((r"\(", "["), (r"\)", "]"), (r"\bNone\b", "null"), (r"\bTrue\b", "true"), (r"\bFalse\b", "false"), (r",(?=\s*[\]}])", "")):
        made = F.regexp_replace(made, bare(word), by)
    read = F.from_json(F.concat(F.lit('{"v":'), made, F.lit("}")), f"v {kind}, _corrupt_record string")
    bad = read["_corrupt_record"].isNotNull() | text.isNull() if not optional else read["_corrupt_record"].isNotNull()
    return F.when(bad, F.raise_error(F.concat(F.lit(f"not {kind}: "), F.coalesce(text, F.lit("null")))).cast(kind)).otherwise(read["v"])


def parse_tuple(text: Column, kinds: list[str], optional: bool = False) -> Column:
    """A tuple of values of several types as struct(_1, _2, ...); fails on another number of values, on values of another type,
    and on nulls unless optional."""
    values = parse_compound(text, "array<string>", optional)
    wrong = (F.size(values) != len(kinds)) | F.array_contains(F.array(*[F.get(values, F.lit(i)).isNotNull() & F.get(values, F.lit(i)).try_cast(k).isNull() for i, k in enumerate(kinds)]), True)
    made = F.struct(*[F.get(values, F.lit(i)).try_cast(k).alias(f"_{i + 1}") for i, k in enumerate(kinds)])
    kind = "struct<" + ", ".join(f"_{i + 1}: {k}" for i, k in enumerate(kinds)) + ">"
    return F.when(values.isNull(), F.lit(None).cast(kind)).when(wrong, F.raise_error(F.concat(F.lit(f"not {kind}: "), text)).cast(kind)).otherwise(made)


def carry(df: DataFrame, schema: T.StructType, **new: Column) -> DataFrame:
    """The fields of a schema: of ``new`` where given, else of df; optional ones that neither has are null."""
    missing = [f.name for f in schema if f.name not in new and f.name not in df.columns and not f.nullable]
    unknown = sorted(set(new) - set(schema.names))
    if missing or unknown:
        raise ValueError(f"missing fields: {missing}; unknown fields: {unknown}")
    have = {c: F.col(c) for c in df.columns} | new
    return df.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def export_projection(df: DataFrame, fields: list[str], derived: dict[str, Column] | None = None, formats: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """The fields in this order, stored ones or ``derived`` from them, as ``formats`` has them written."""
    derived, formats = derived or {}, formats or {}
    return df.select(*[formats.get(c, lambda x: x)(derived[c] if c in derived else F.col(c)).alias(c) for c in fields])


#: Values that a run's parameters may have (fixed values).
DETECTION_METHODS, AVERAGE_METHODS = ("genbank", "isfinder", "isescan"), ("median", "mean", "mode")


def merge_params(sheet: DataFrame, *layers: dict | None, nested: dict[str, list[str]] | None = None) -> DataFrame:
    """The rows of a run sheet over layers of parameters: the row's value first, then the last layer's that is not None.
    The names that ``nested`` lists go into structs of the given names."""
    merged: dict = {}
    for layer in layers:
        merged |= {k: v for k, v in (layer or {}).items() if v is not None or k not in merged}
    value = {k: F.lit(v) for k, v in merged.items()}
    value |= {c: F.coalesce(F.col(c), value[c]) if c in value else F.col(c) for c in sheet.columns}
    inner = {name: [c for c in names if c in value] for name, names in (nested or {}).items()}
    moved = {c for names in inner.values() for c in names}
    structs = [F.struct(*[value[c].alias(c) for c in names]).alias(name) for name, names in inner.items() if names]
    return sheet.select(*[v.alias(c) for c, v in value.items() if c not in moved], *structs)


def validate_params(runs: DataFrame) -> DataFrame:
    """runs (ref_name, iso_fastq_path, ref_path, ncbi, is_detection_method, run_comparison_methods array, average_method)
    with errors: what is wrong with each."""
    method, compared, local = F.col("is_detection_method"), F.col("run_comparison_methods"), ~F.coalesce("ncbi", F.lit(True))
    known = F.array(*[F.lit(m) for m in DETECTION_METHODS])
    rules = {
        "ref_name is required": F.col("ref_name").isNull(),
        "iso_fastq_path is required": F.col("iso_fastq_path").isNull(),
        "unknown detection method": ~method.isin(*DETECTION_METHODS) | (F.size(F.array_except(compared, known)) > 0),
        "detection method among the compared": F.array_contains(compared, method),
        "local genomes need isfinder or isescan": local & (method == "genbank"),
        "genomesDB is for NCBI references": local & F.col("ref_path").rlike(r"(^|/)genomesDB/?$"),
        "unknown average method": ~F.col("average_method").isin(*AVERAGE_METHODS),
    }
    return runs.withColumn("errors", F.array_compact(F.array(*[F.when(wrong, F.lit(text)) for text, wrong in rules.items()])))
