import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from junctionflow.sources import readers, sinks


def test_fasta_and_fastq(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">one x\nACGT\nAC\n>two\nGG\n")
    assert [(r.id, r.seq, r.length) for r in readers.scan_fasta(spark, str(tmp_path / "a.fasta")).orderBy("id").collect()] == [("one", "ACGTAC", 6), ("two", "GG", 2)]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "x.fastq.gz").write_bytes(gzip.compress(b"@r1 z\nACGT\n+\n@@@@\n@r2\nAC\n+\nII\n"))
    assert [(r.id, r.seq) for r in readers.scan_fastq(spark, str(tmp_path / "r")).collect()] == [("r1", "ACGT"), ("r2", "AC")]
    assert readers.scan_fastq(spark, str(tmp_path / "r"), 1).count() == 1


def test_genomediff(spark, tmp_path):
    (tmp_path / "o.gd").write_text("#=GENOME_DIFF\n\nJC\t297\t.\tU1\t257908\t1\tU1\t890745\t-1\t0\tflanking_left=151\tflanking_right=151\tfrequency=NA\nRA\t1\t.\n")
    row = readers.junction_table(readers.scan_genomediff(spark, str(tmp_path / "o.gd"))).head()
    assert (row.num, row.scaf1, row.pos1, row.dir2, row.flanking1, row.reject) == (297, "U1", 257908, -1, 151, None)


def test_values_and_schemas(spark, value):
    got = [value(readers.convert_value(F.lit(x), k)) for x, k in (("123.0", "int"), ("1e-10", "double"), ("NA", "int"), ("", "double"))]
    assert got == [123, 1e-10, None, None]
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType(), True)])
    rows = spark.createDataFrame([("1",), ("2",)], "a string")
    assert [tuple(r) for r in readers.enforce_schema(rows, schema).collect()] == [(1, None), (2, None)]
    with pytest.raises(ValueError):
        readers.enforce_schema(rows.withColumn("c", F.lit(1)), schema)
    with pytest.raises(ValueError):
        readers.enforce_schema(rows.select(F.lit("x").alias("b")), schema)


def test_sam_coverage_and_summary(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tx\nr1\t16\tj\t5\t9\t4M1D2M\t*\t0\t0\tACGTAC\tIIIIII\tAS:i:-5\tNM:i:1\n")
    r = readers.scan_alignments(spark, str(tmp_path / "x.sam")).head()
    assert (r.start, r.end, r.is_reverse, r.score, r.mismatches, r.aln_index) == (4, 11, True, -5, 1, 1)
    (tmp_path / "cov").mkdir()
    (tmp_path / "cov" / "U1.coverage.tab").write_text("unique_top_cov\tunique_bot_cov\tposition\n10\t11\t1\n")
    assert tuple(readers.scan_coverage_tab(spark, str(tmp_path / "cov")).head()) == ("cov", "U1", 1, 21)
    (tmp_path / "s.json").write_text('{"references": {"U1": {"bases_mapped_to_reference": 7}}}')
    assert readers.scan_mapping_summary(spark, str(tmp_path / "s.json")).head().bases == 7


def test_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1.25, [1, 2])], "sample string, x double, y array<int>")
    sinks.write_typed_csv(rows, str(tmp_path / "c"), {"x": "%.2f"})
    assert tuple(spark.read.option("header", True).csv(str(tmp_path / "c")).head()) == ("s", "1.25", "[1,2]")
    sinks.write_stage_table(rows, str(tmp_path), "A")
    assert spark.read.parquet(str(tmp_path / "A")).count() == 1


GENBANK = """LOCUS       AB_1  30 bp    DNA     circular BCT 01-JAN-2000
FEATURES             Location/Qualifiers
     source          1..30
     mobile_element  complement(join(5..9,
                     12..20))
                     /mobile_element_type="insertion
                     sequence:IS7"
                     /note="a"
                     /note="b"
     gene            <22..25
                     /pseudo
ORIGIN
        1 acgtacgtac gtacgtacgt
       21 acgtnacgta
//
LOCUS       X2  4 bp    DNA     linear   BCT
ORIGIN
        1 ttga
//
"""


def test_genbank_to_elements(spark, tmp_path):
    from junctionflow.operators import islocate

    (tmp_path / "a.gb").write_text(GENBANK)
    records = readers.scan_genbank(spark, str(tmp_path / "a.gb"))
    one, two = records.orderBy("scaf").collect()
    assert (one.scaf, one.topology, one.seq, one.length) == ("AB_1", "circular", "ACGTACGTACGTACGTACGTACGTNACGTA", 30)
    assert (two.scaf, two.topology, two.seq, two.features) == ("X2", "linear", "TTGA", [])
    assert [(f.type, f.start0, f.end, f.strand) for f in one.features] == [("source", 0, 30, 1), ("mobile_element", 4, 20, -1), ("gene", 21, 25, 1)]
    assert one.features[1].qualifiers == {"mobile_element_type": ["insertion sequence:IS7"], "note": ["a", "b"]}
    found = islocate.is_features(readers.genbank_features(records.withColumn("ref", F.lit("r")))).collect()
    assert [tuple(r) for r in found] == [("r", "AB_1", "IS7", 5, 20, -1)]


def test_references(spark, tmp_path):
    for name in ("L1.gb", "L1.fasta", "L2.fasta"):
        (tmp_path / name).write_text("x")
    names = spark.createDataFrame([("U1",), ("L2",), ("gone",)], "ref_name string")
    found, missing = readers.resolve_reference(names, spark.createDataFrame([("U1", "L1")], "accession string, name string"), readers.reference_files(spark, str(tmp_path)))
    assert sorted((r.ref_name, r.locus, r.format, r.path.rsplit("/", 1)[1]) for r in found.collect()) == [("L2", "L2", "fasta", "L2.fasta"), ("U1", "L1", "genbank", "L1.gb")]
    assert [r.ref_name for r in missing.collect()] == ["gone"]


def test_read_buckets_and_samples(spark, tmp_path):
    (tmp_path / "s1" / "output").mkdir(parents=True)
    (tmp_path / "s1" / "reads_jct_3_left_marginal.bam_indices").write_text("r1\t5\t90\tTrue\t17\n\nr2\t6\t91\tFalse\t18\n")
    got = readers.scan_read_buckets(spark, str(tmp_path)).orderBy("index").collect()
    assert [tuple(r) for r in got] == [(3, "left_marginal", "r1", 5, 90, True, 17), (3, "left_marginal", "r2", 6, 91, False, 18)]
    (tmp_path / "s1" / "output" / "output.gd").write_text("SNP\t1\t.\tc\t5\tA\n")
    assert readers.scan_genomediff(spark, str(tmp_path / "*" / "output" / "output.gd")).head().sample == "s1"
    (tmp_path / "s1" / "c.coverage.tab").write_text("unique_top_cov\tunique_bot_cov\tposition\n2\t3\t1\n")
    assert tuple(readers.scan_coverage_tab(spark, str(tmp_path)).head()) == ("s1", "c", 1, 5)


def test_compound_values(value):
    read = lambda x, kind, **k: value(readers.parse_compound(F.lit(x), kind, **k))
    assert read("(1, 2,)", "array<int>") == [1, 2] and read("[]", "array<int>") == []
    assert read("{'a': None, \"b (None)\": 2}", "map<string,int>") == {"a": None, "b (None)": 2}
    assert tuple(read("{'x': 'it (True)', 'y': True}", "struct<x:string,y:boolean>")) == ("it (True)", True)
    assert read(None, "array<int>", optional=True) is None
    for bad in (None, "[1, 'x']", "nonsense"):
        with pytest.raises(Exception, match="not array<int>"):
            read(bad, "array<int>")


def test_carry_and_export(spark):
    rows = spark.createDataFrame([(1, "x", 2)], "a int, b string, c int")
    schema = T.StructType([T.StructField("c", T.LongType(), False), T.StructField("d", T.StringType(), False), T.StructField("e", T.StringType(), True)])
    assert tuple(readers.carry(rows, schema, d=F.upper("b")).head()) == (2, "X", None)
    for new in ({}, {"d": F.lit("x"), "z": F.lit(1)}):
        with pytest.raises(ValueError):
            readers.carry(rows, schema, **new)
    got = readers.export_projection(rows, ["total", "b"], {"total": F.col("a") + F.col("c")}, {"b": F.upper})
    assert got.columns == ["total", "b"] and tuple(got.head()) == (3, "X")


def test_parameters_of_runs(spark):
    sheet = spark.createDataFrame([("r", None, 5), ("s", "mean", None)], "ref_name string, average_method string, score_min int")
    got = readers.merge_params(sheet, {"average_method": "median", "score_min": 1, "ncbi": True}, None, {"score_min": 2, "ncbi": None}, nested={"filter": ["score_min", "absent"]})
    assert sorted((r.ref_name, r.average_method, r.ncbi, r.filter.score_min) for r in got.collect()) == [("r", "median", True, 5), ("s", "mean", True, 2)]
    runs = [("r", "p", "x", True, "genbank", ["isescan"], "median"), (None, None, "a/genomesDB", False, "genbank", ["genbank"], "best"), ("r", "p", "x", False, "blast", [], "mode"), ("r", "p", "x", None, "genbank", None, None)]
    checked = readers.validate_params(spark.createDataFrame(runs, "ref_name string, iso_fastq_path string, ref_path string, ncbi boolean, is_detection_method string, run_comparison_methods array<string>, average_method string"))
    assert [len(r.errors) for r in checked.collect()] == [0, 6, 1, 0]


def test_labels_of_reads(spark, tmp_path):
    """From bucket files, from FASTA and FASTQ headers (a quality line may begin with @), and from what the sink wrote."""
    (tmp_path / "reads_jct_2_left_marginal.bam_indices").write_text("r1\t5\t90\tTrue\t17\n")
    (tmp_path / "reads_jct_2_right_far.bam_indices").write_text("r2\t5\t90\tTrue\t18\n")
    (tmp_path / "reads_jct_2_left.fasta").write_text(">r1/17\nACGT\n>r3/4\nAC\n")
    (tmp_path / "reads_jct_5_green.fastq").write_text("@r4/9 x\nACGT\n+\n@III\n")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(readers.read_labels(readers.scan_read_buckets(spark, str(tmp_path)))) == [("r1/17", 2, "left")]
    assert rows(readers.scan_read_labels(spark, str(tmp_path), "fasta")) == [("r1/17", 2, "left"), ("r3/4", 2, "left")]
    assert rows(readers.scan_read_labels(spark, str(tmp_path))) == [("r4/9", 5, "span")]
    hits = spark.createDataFrame([(3, "left", "r", False, [(5, 9, -1, 7), (6, 8, -2, 8)])], "junction int, read_type string, read_id string, is_reverse boolean, hits array<struct<start: long, end: long, score: int, aln_index: long>>")
    sinks.write_read_buckets(hits, str(tmp_path / "out"))
    assert rows(readers.scan_read_buckets(spark, str(tmp_path / "out"), written=True)) == [(3, "left", "r", 5, 9, False, 7), (3, "left", "r", 6, 8, False, 8)]


def test_files_that_are_missing(spark, tmp_path):
    (tmp_path / "s1" / "deep").mkdir(parents=True)
    head, row = ["seqID", "isBegin", "isEnd", "strand", "family", "cluster"], ["c", "5", "90", "+", "IS3", "IS3_1"]
    (tmp_path / "s1" / "deep" / "g.fasta.csv").write_text(",".join(head) + "\n" + ",".join(row) + "\n")
    assert readers.find_isescan(spark, str(tmp_path), "g.fasta").head().isBegin == 5
    (tmp_path / "s1" / "g.fasta.tsv").write_text("\t".join(head) + "\n" + "\t".join(["c", "7", *row[2:]]) + "\n")
    assert readers.find_isescan(spark, str(tmp_path), "g.fasta").head().isBegin == 7
    with pytest.raises(FileNotFoundError):
        readers.find_isescan(spark, str(tmp_path), "h.fasta")
    with pytest.raises(FileNotFoundError):
        readers.scan_coverage_tab(spark, str(tmp_path))
    found = spark.createDataFrame([("s1", "b", 4), ("s1", "a", 3), ("s1", "x", None)], "sample string, ref string, bases long")
    totals = readers.mapping_totals(found, spark.createDataFrame([("s1",), ("s2",)], "sample string"))
    assert {r["sample"]: (r.mapped_bases, r.total_mapped_bases) for r in totals.collect()} == {"s1": ([3, 4], 7), "s2": ([], None)}


def test_tuples_of_several_types(value):
    got = value(readers.parse_tuple(F.lit("(1, 'a, b', 2.5, None)"), ["int", "string", "double", "int"]))
    assert tuple(got) == (1, "a, b", 2.5, None)
    assert value(readers.parse_tuple(F.lit(None).cast("string"), ["int"], optional=True)) is None
    for text, kinds in (("(1, 2)", ["int"]), ("('x',)", ["int"]), (None, ["int"])):
        with pytest.raises(Exception, match="not "):
            value(readers.parse_tuple(F.lit(text).cast("string"), kinds))


def test_counts_of_whole_files(spark):
    from junctionflow.functions import coords
    from junctionflow.operators import reads

    rows = spark.createDataFrame([("s", "ACGT")] * 5 + [("t", "AC")], "sample string, seq string")
    stats = reads.total_bases(reads.read_length_stats(rows.limit(6).distinct()), 20, reads.count_reads(rows))
    assert {r["sample"]: (r.total_bases, r.low_depth) for r in stats.collect()} == {"s": (20, False), "t": (2, True)}
    for o in (1, -1):
        assert tuple(spark.range(1).select(coords.segment_ends(F.lit(o), F.lit(3), F.lit(9)).alias("x")).head().x) == ((3, 9) if o > 0 else (9, 3))
