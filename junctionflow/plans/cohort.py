"""The whole run of a cohort as one dataflow: every table has its sample, ancestors that isolates share are computed once,
and samples that cannot be run are fenced off with a status before the others go on.

Stages are written one after another, as Parquet by sample, and each is read by the next, so a lost executor costs a stage at
most. Nothing of a sample is looked at by the driver; it sees the number of the shortest reads alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from junctionflow.functions import blocks, coords
from junctionflow.operators import alignments, classify, coverage, islocate, junctions, reads
from junctionflow.sources import readers, sinks

#: Names of the stage tables (fixed values).
STAGES = ["ref_tnjc", "tnjc", "tnjc2_A_raw", "tnjc2_B_linked", "tnjc2_C_covered", "tnjc2_D_syn_jcts", "tnjc2_E_analyzed", "tnjc2_F_classified"]


@dataclass(frozen=True)
class Params:
    """What a run may be told; defaults are the usual ones."""

    out_span: int = 100
    in_span: int | None = None
    max_dist: int = 10
    trim: int = 5
    min_length: int = 100
    max_length: int = 1_000_000
    average: str = "median"
    amplified: float = 1.5
    deleted: float = 0.3
    max_lines: int = 10_000
    reject: bool = True
    sampled_reads: int = 1000
    overlap: int = 13
    max_mismatch: int = 3
    block: int = 4096


@dataclass
class Inputs:
    """runs (sample, anc, ref), scaffolds (ref, scaf, seq, length, is_circular), elements (ref, tn_id, tn_name, scaf, start, end,
    orientation), lines (sample: a row for each line of a junction file), junctions (as readers.junction_table), coverage
    (sample, scaf, pos, cov), reads (sample, read_id, seq). anc is null for runs without an ancestor; an ancestor's coverage and
    reads stand under its own name."""

    runs: DataFrame
    scaffolds: DataFrame
    elements: DataFrame
    lines: DataFrame
    junctions: DataFrame
    coverage: DataFrame
    reads: DataFrame


def read_inputs(spark: SparkSession, sheet: str, references: str, samples: str) -> Inputs:
    """From a run sheet (sample, anc, ref), a folder of GenBank files named by reference, and a folder with one folder a sample:
    output/*.gd, 08_mutation_identification/*.coverage.tab, and FASTQ files in data/."""
    runs = readers.scan_run_sheet(spark, sheet, {"sample": "string", "anc": "string", "ref": "string"}, ["sample", "ref"])
    records = readers.scan_genbank(spark, references, with_ref=True)
    scaffolds = coords.infer_circularity(records.select("ref", "scaf", "topology", "seq", "length")).drop("topology")
    elements = islocate.assign_tn_id(islocate.is_features(readers.genbank_features(records)))
    gd = f"{samples}/*/output/*.gd"
    lines = spark.read.text(gd).select(readers.sample_of().alias("sample"))
    fastq = readers.scan_fastq(spark, f"{samples}/*/data").select(F.regexp_extract("file", r"([^/]+)/data/[^/]+$", 1).alias("sample"), F.col("id").alias("read_id"), "seq")
    return Inputs(runs, scaffolds, elements, lines, readers.junction_table(readers.scan_genomediff(spark, gd)), readers.scan_coverage_tab(spark, f"{samples}/*/08_mutation_identification"), fastq)


def admit_runs(runs: DataFrame, references: DataFrame, lines: DataFrame, depths: DataFrame, lengths: DataFrame, max_lines: int = 10_000) -> DataFrame:
    """runs with state (started, terminated or failed), exit_code and error: what each lacks. references: ref; lines: sample;
    depths, lengths: sample. Tables are reduced to their keys before they meet, and a run is judged by all of its faults."""
    size = lines.groupBy("sample").agg(F.count("*").alias("_lines"))
    known = lambda df, key, name: df.select(F.col(key)).distinct().withColumn(name, F.lit(True))
    out = runs.join(known(references, "ref", "_ref"), "ref", "left").join(size, "sample", "left")
    for df, name in ((depths, "_cov"), (lengths, "_reads")):
        own = known(df, "sample", name)
        out = out.join(own, "sample", "left").join(own.select(F.col("sample").alias("anc"), F.col(name).alias(f"{name}_anc")), "anc", "left")
    anc = F.col("anc").isNotNull()
    wrong = F.array_compact(F.array(*[F.when(c, F.lit(text)) for c, text in (
        (F.col("_ref").isNull(), "reference not found"), (F.col("_lines").isNull(), "no junction file"), (F.col("_cov").isNull(), "no coverage"), (F.col("_reads").isNull(), "no reads"),
        (anc & F.col("_cov_anc").isNull(), "no coverage of the ancestor"), (anc & F.col("_reads_anc").isNull(), "no reads of the ancestor"),
    )]))
    long = F.coalesce(F.col("_lines") > max_lines, F.lit(False))
    state = F.when(F.size(wrong) > 0, "failed").when(long, "terminated").otherwise("started")
    text = F.when(F.size(wrong) > 0, F.array_join(wrong, "; ")).when(long, F.format_string("junction file of %d lines", F.col("_lines")))
    return out.select(*runs.columns, state.alias("state"), F.when(state != "started", 1).alias("exit_code"), text.alias("error"))


def reference_tnjc(runs: DataFrame, elements: DataFrame, p: Params) -> DataFrame:
    """Junctions of each run's reference elements."""
    return runs.select("sample", "ref").join(junctions.reference_junctions(elements, p.out_span, p.in_span), "ref")


def element_junctions(runs: DataFrame, reference: DataFrame, observed: DataFrame, scaffolds: DataFrame, p: Params) -> DataFrame:
    """Reference and observed junctions with their element on arm 1, all matches of its end, offsets centred."""
    own = junctions.reject_filter(observed, p.reject).join(runs.select("sample", "ref"), "sample").drop("reject", "extra")
    rows = coords.jc_arms(junctions.union_junctions(reference, own.select([c for c in reference.columns if c in own.columns])))
    rows = blocks.with_arm_sequences(rows, scaffolds, {"arm1": "seq1", "arm2": "seq2"}, p.block)
    ends = rows.filter("ref_tn_side IS NOT NULL").select("ref", "ref_tn_side.*", blocks.junction_seq(F.col("seq2"), F.col("seq1")).alias("end_seq"), F.col("flanking2").alias("flank")).distinct()
    arms = rows.select("sample", "ref", "num", F.explode(F.array(*[F.struct(F.lit(n).alias("arm"), F.col(f"seq{n}").alias("arm_seq")) for n in (1, 2)])).alias("a")).select("sample", "ref", "num", "a.*")
    found = junctions.match_tn_ends(arms, ends, p.max_dist, p.trim)
    side = F.struct(F.col("tn_id").cast("long").alias("tn_id"), "side", "offset")
    lists = found.groupBy("sample", "num").agg(*[F.array_sort(F.collect_list(F.when(F.col("arm") == n, side))).alias(f"sides{n}") for n in (1, 2)])
    void = F.array().cast(lists.schema["sides1"].dataType)
    rows = rows.drop("seq1", "seq2", "arm1", "arm2").join(lists, ["sample", "num"], "left").withColumns({c: F.coalesce(c, void) for c in ("sides1", "sides2")})
    return junctions.recentre_offset(junctions.normalise_tn_arm(rows))


def pairs_of(tnjc: DataFrame, p: Params) -> DataFrame:
    rows = tnjc.select("sample", "num", "scaf2", "pos2", "dir2", F.col("ref_tn_side.tn_id").cast("long").alias("own_tn"), F.col("ref_tn_sides").alias("sides"))
    return junctions.pair_junctions(rows).withColumn("base_event", junctions.base_event(p.min_length))


def linked_pairs(pairs: DataFrame, runs: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """Pairs with their links, reference, length and chosen element."""
    rows = junctions.link_single_locus(pairs).join(runs.select("sample", "anc", "ref"), "sample")
    rows = rows.join(scaffolds.select("ref", "scaf", F.col("length").cast("long").alias("scaf_length"), "is_circular"), ["ref", "scaf"])
    length = coords.segment_length(F.col("left"), F.col("right"), F.lit(1), F.col("scaf_length"), F.col("is_circular"))
    return rows.withColumns({"length": length.cast("long"), "span_origin": F.col("left") > F.col("right"), "chosen_tn": junctions.chosen_tn(linked=True), "raw_architecture": junctions.raw_architecture()})


def run_coverage(depth: DataFrame, runs: DataFrame) -> DataFrame:
    """sample, scaf, pos, iso, anc: each run's depth beside its ancestor's (null without one); an ancestor's table serves all."""
    iso = depth.withColumnRenamed("cov", "iso").join(runs.select("sample", "anc"), "sample")
    anc = depth.select(F.col("sample").alias("_anc"), "scaf", "pos", F.col("cov").alias("_cov"))
    joined = iso.withColumnRenamed("anc", "_anc").join(anc, ["_anc", "scaf", "pos"], "left")
    return joined.select("sample", "scaf", "pos", "iso", F.when(F.col("_anc").isNotNull(), F.coalesce("_cov", F.lit(0))).alias("anc"))


def covered_pairs(linked: DataFrame, cov: DataFrame, p: Params) -> DataFrame:
    """Locus-joining pairs of admitted length with averages and copy numbers."""
    rows = coverage.length_gate(linked, p.min_length, p.max_length)
    cands = rows.select("sample", "scaf", F.col("pair_id").alias("cand_id"), F.col("left").alias("start"), F.col("right").alias("end"), F.col("scaf_length").alias("length"))
    used = cov.join(cands.select("sample", "scaf").distinct(), ["sample", "scaf"], "left_semi")
    found = coverage.copy_numbers(coverage.segment_averages(cands, used, p.average, block=p.block))
    return rows.join(found.withColumnRenamed("cand_id", "pair_id"), ["sample", "pair_id"])


def synthetic(covered: DataFrame, elements: DataFrame, lengths: DataFrame) -> DataFrame:
    """Candidates twice: with arms for the isolate's reads (is_anc false) and, where there is an ancestor, for its own."""
    iso_len, anc_len = (lengths.select(F.col("sample").alias(k), F.col("max_len").alias(n)) for k, n in (("sample", "iso_len"), ("anc", "anc_len")))
    rows = covered.join(iso_len, "sample").join(anc_len, "anc", "left").withColumn("arms", reads.arm_lengths(F.col("iso_len"), F.coalesce("anc_len", "iso_len")))
    both = F.array(F.struct(F.lit(False).alias("is_anc"), F.col("arms.iso_arm").alias("jc_arm"), F.col("iso_len").alias("read_len")), F.struct(F.lit(True).alias("is_anc"), F.col("arms.anc_arm").alias("jc_arm"), F.col("anc_len").alias("read_len")))
    rows = rows.withColumn("_x", F.explode(both)).filter("NOT _x.is_anc OR anc IS NOT NULL").select("*", "_x.*").drop("_x", "arms", "iso_len", "anc_len")
    flank = F.col("jc_arm").cast("int")
    return reads.synthetic_arms(reads.flank_arms(rows, flank), elements, flank)


def junction_calls(syn: DataFrame, scaffolds: DataFrame, read_rows: DataFrame, p: Params) -> DataFrame:
    """sample (the isolate or the ancestor whose reads they are), candidate, junction, the counts of all read types and call. A
    candidate that several isolates of an ancestor share meets the ancestor's reads once."""
    own = syn.withColumn("sample", F.when(F.col("is_anc"), F.col("anc")).otherwise(F.col("sample"))).dropDuplicates(["sample", "candidate"])
    seven = reads.junction_sequences(reads.seven_junctions(own), scaffolds, p.block).select("sample", "candidate", "junction", "jc_arm", "read_len", "seq")
    name = F.to_json(F.struct("sample", "candidate", "junction"))
    targets = seven.select("sample", name.alias("target"), "seq")
    sizes = seven.groupBy("sample").agg(F.max("read_len").alias("_len"))
    admitted = read_rows.join(sizes, "sample").filter(F.length("seq") >= reads.min_query_length(F.col("_len")))
    shortest = sizes.agg(F.min("_len")).head()[0]
    empty = targets.select("sample", "target").limit(0)
    if shortest is None:  # no candidate at all
        hits = empty.select(F.lit("").alias("read_id"), "target", F.lit(False).alias("is_reverse"), F.lit(0).alias("start"), F.lit(0).alias("mismatches"), F.lit(0).alias("n"))
    else:
        # each read under a name of its own, as mates and samples share names
        named = admitted.select("sample", F.to_json(F.struct("sample", "read_id", F.xxhash64("seq").alias("h"))).alias("read_id"), "seq", F.length("seq").alias("n"))
        hits = reads.match_reads(named.select("sample", "read_id", "seq").distinct(), targets, int(shortest), p.max_mismatch)
        hits = hits.join(named.select("read_id", "n").distinct(), "read_id")
    key, read = F.from_json("target", "sample string, candidate string, junction int"), F.from_json("read_id", "sample string, read_id string, h long")
    score = -5 * F.col("mismatches")
    rows = hits.select(key.alias("k"), read["read_id"].alias("read_id"), "is_reverse", "start", (F.col("start") + F.col("n")).alias("end"), score.alias("score"), F.col("start").alias("aln_index")).select("k.*", "read_id", "is_reverse", "start", "end", "score", "aln_index")
    rows = rows.filter("score >= -25")
    mates = alignments.link_pairs(alignments.best_hit(rows)).join(seven.select(*alignments.GROUP, "jc_arm"), alignments.GROUP)
    kind = lambda m: F.when(F.col(f"{m}_start").isNotNull(), alignments.read_type(F.col(f"{m}_start") + 1, F.col(f"{m}_end"), F.col("jc_arm"), p.overlap, F.col("jc_arm") - 10))
    typed = mates.select(*alignments.GROUP, "read_id", F.explode(alignments.pair_read_types(kind("first"), kind("second"))).alias("read_type"))
    counts = alignments.count_read_types(typed, seven).join(seven.select(*alignments.GROUP, "jc_arm", "read_len"), alignments.GROUP)
    expected = alignments.expected_counts(F.col("read_len"), F.col("jc_arm"), p.overlap)
    ratio = F.try_divide(expected["spanning"].cast("double"), expected["left"])
    return counts.withColumn("call", alignments.call_junction(F.col("left"), F.col("right"), F.col("spanning"), ratio))


def classified(syn: DataFrame, calls: DataFrame) -> DataFrame:
    """Candidates of isolates with both architectures and what differs between them."""
    found = classify.architecture(calls, ["sample", "candidate"])
    four = calls.filter("junction = 4").select("sample", "candidate", F.col("call").alias("call4"))
    found = found.join(four, ["sample", "candidate"], "left")
    iso = syn.filter("NOT is_anc").join(found, ["sample", "candidate"], "left")
    anc = syn.filter("is_anc").select("sample", "pair_id", F.col("anc").alias("_anc"), F.col("candidate").alias("anc_candidate"))
    of_anc = found.select(F.col("sample").alias("_anc"), F.col("candidate").alias("anc_candidate"), F.col("architecture").alias("anc_architecture"))
    out = iso.join(anc.join(of_anc, ["_anc", "anc_candidate"], "left").drop("_anc"), ["sample", "pair_id"], "left")
    told = F.when(F.col("anc_architecture").isNotNull(), classify.compare_iso_anc(F.col("architecture"), F.col("anc_architecture"))).otherwise(F.array().cast("array<string>"))
    return out.withColumn("descriptors", classify.flag_amp_amp(told, F.col("call4"))).drop("call4", "is_anc")


def _staged(tables: dict[str, DataFrame], df: DataFrame, folder: str, stage: str) -> DataFrame:
    sinks.write_stage_table(df, folder, stage)
    tables[stage] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{stage}")
    return tables[stage]


def run_cohort(inputs: Inputs, folder: str, params: Params | None = None) -> dict[str, DataFrame]:
    """Runs all stages, writes them below ``folder`` with summary and run_status, and returns the tables by name."""
    p, tables = params or Params(), {}
    admitted = admit_runs(inputs.runs, inputs.scaffolds, inputs.lines, inputs.coverage, inputs.reads, p.max_lines).withColumn("started", F.current_timestamp())
    admitted.write.parquet(f"{folder}/admitted")
    every = admitted.sparkSession.read.parquet(f"{folder}/admitted")
    runs = every.filter("state = 'started'").select("sample", "anc", "ref")
    refs = runs.select("ref").distinct()
    scaffolds, elements = inputs.scaffolds.join(refs, "ref", "left_semi"), inputs.elements.join(refs, "ref", "left_semi")
    reference = _staged(tables, reference_tnjc(runs, elements, p), folder, "ref_tnjc")
    tnjc = _staged(tables, element_junctions(runs, reference, inputs.junctions, scaffolds, p), folder, "tnjc")
    raw = _staged(tables, pairs_of(tnjc, p), folder, "tnjc2_A_raw")
    linked = _staged(tables, linked_pairs(raw, runs, scaffolds), folder, "tnjc2_B_linked")
    covered = _staged(tables, covered_pairs(linked, run_coverage(inputs.coverage, runs), p), folder, "tnjc2_C_covered")
    kept = coverage.filter_copy_number(covered, p.amplified, p.deleted)
    lengths = reads.read_length_stats(inputs.reads)
    syn = _staged(tables, synthetic(kept, elements, lengths), folder, "tnjc2_D_syn_jcts")
    calls = _staged(tables, junction_calls(syn, scaffolds, inputs.reads, p), folder, "tnjc2_E_analyzed")
    final = _staged(tables, classified(syn, calls), folder, "tnjc2_F_classified")
    names = elements.select("ref", "tn_id", "tn_name")
    tables["amplicons"] = classify.summary_amplicons(junctions.multi_tn_names(final, names))
    tables["transpositions"] = classify.summary_transpositions(junctions.multi_tn_names(linked, names))
    told = runs.join(lengths.select("sample", F.col("max_len").alias("read_length")), "sample", "left").join(lengths.select(F.col("sample").alias("anc"), F.col("max_len").alias("anc_read_length")), "anc", "left")
    sinks.write_summary(tables["amplicons"], tables["transpositions"], f"{folder}/summary", told)
    done: Column = F.col("state") == "started"
    status = every.withColumns({"state": F.when(done, "completed").otherwise(F.col("state")), "exit_code": F.when(done, 0).otherwise(F.col("exit_code")), "ended": F.current_timestamp()})
    sinks.append_run_status(status.withColumn("duration_sec", F.unix_timestamp("ended") - F.unix_timestamp("started")), f"{folder}/run_status")
    tables["run_status"] = every.sparkSession.read.parquet(f"{folder}/run_status")
    return tables
