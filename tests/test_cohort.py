"""The run of a cohort from files to summaries: two isolates of one ancestor, and runs that are fenced off."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from junctionflow.operators import islocate, junctions
from junctionflow.plans import cohort
from junctionflow.sources import readers

FLIP = str.maketrans("ACGT", "TGCA")


def genome():
    """3,000 circular bases with two copies of an element, at 501-700 and 1501-1700."""
    rng = random.Random(9)
    seq = [rng.choice("ACGT") for _ in range(3000)]
    element = [rng.choice("ACGT") for _ in range(200)]
    seq[500:700], seq[1500:1700] = element, element
    return "".join(seq)


def reads_of(seq):
    """100 letters from every third base around the circle, strands in turn."""
    around = seq + seq[:99]
    for i in range(0, len(seq), 3):
        x = around[i : i + 100]
        yield f"@r{i} x\n{x if i % 2 else x.translate(FLIP)[::-1]}\n+\n{'@' * 100}\n"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    top, ref = tmp_path_factory.mktemp("cohort"), genome()
    (top / "refs").mkdir()
    origin = "\n".join(f"{i + 1:9d} {ref[i : i + 60].lower()}" for i in range(0, 3000, 60))
    features = "".join(f'     mobile_element  {a}..{b}\n                     /mobile_element_type="insertion sequence:IS1"\n' for a, b in ((501, 700), (1501, 1700)))
    (top / "refs" / "R1.gb").write_text(f"LOCUS       c   3000 bp    DNA     circular BCT 01-JAN-2000\nFEATURES             Location/Qualifiers\n{features}ORIGIN\n{origin}\n//\n")
    element, doubled = ref[500:700], ref[:1500] + ref[500:700] + ref[700:]
    moved = doubled[: 2300 + 1000] + element + doubled[2295 + 1000 :]  # and an element at 2300, with five bases repeated
    new = "\t".join(["JC", "1", ".", "c", "501", "1", "c", "2300", "-1", "0"]) + "\tflanking_left=60\tflanking_right=60\n" + "\t".join(["JC", "2", ".", "c", "700", "-1", "c", "2296", "1", "0"]) + "\tflanking_left=60\tflanking_right=60\n"
    plain = "#=GENOME_DIFF 1.0\n" + "\t".join(["JC", "9", ".", "c", "100", "1", "c", "900", "-1", "0"]) + "\tflanking_left=50\tflanking_right=50\n"
    for name, seq, gd, twice in (("anc", ref, plain, False), ("iso1", moved, plain + new, True), ("iso2", ref, plain, False), ("long", ref, plain + "#\n" * 30, False), ("bare", ref, plain, False)):
        for sub in ("output", "data", "08_mutation_identification"):
            (top / "samples" / name / sub).mkdir(parents=True)
        (top / "samples" / name / "output" / "output.gd").write_text(gd)
        if name != "bare":
            lines = "".join(f"{20 if twice and 701 <= p <= 1500 else 10}\t{10 if not twice or not 701 <= p <= 1500 else 20}\t{p}\n" for p in range(1, 3001))
            (top / "samples" / name / "08_mutation_identification" / "c.coverage.tab").write_text("unique_top_cov\tunique_bot_cov\tposition\n" + lines)
        with gzip.open(top / "samples" / name / "data" / "reads.fastq.gz", "wt") as f:
            f.writelines(reads_of(seq))
    (top / "runs.csv").write_text("sample,anc,ref\niso1,anc,R1\niso2,anc,R1\nlong,,R1\nbare,anc,R1\nlost,,R9\n")
    return top


@pytest.fixture(scope="module")
def ran(spark, files, tmp_path_factory):
    inputs = cohort.read_inputs(spark, str(files / "runs.csv"), str(files / "refs" / "*.gb"), str(files / "samples"))
    out = str(tmp_path_factory.mktemp("out"))
    return cohort.run_cohort(inputs, out, cohort.Params(max_lines=20)), out


def test_status_of_each_run(ran):
    status = {r["sample"]: (r["state"], r["exit_code"], r["error"]) for r in ran[0]["run_status"].collect()}
    assert status["iso1"] == status["iso2"] == ("completed", 0, None)
    assert status["long"] == ("terminated", 1, "junction file of 32 lines")
    assert status["bare"] == ("failed", 1, "no coverage") and status["lost"][0] == "failed" and status["lost"][2].startswith("reference not found; no junction file")


def test_the_amplified_segment_is_found_and_called(spark, ran):
    tables, folder = ran
    assert set(cohort.STAGES) <= set(tables)
    rows = {r["sample"]: json.loads(r["value"]) for r in spark.read.text(f"{folder}/summary").select(F.get_json_object("value", "$.sample.isolate").alias("sample"), "value").collect()}
    assert set(rows) == {"iso1", "iso2"}
    one = rows["iso1"]
    assert one["sample"] == {"isolate": "iso1", "ancestor": "anc", "reference": "R1", "read_lengths": {"isolate": 100, "ancestor": 100}}
    found = [a for a in one["amplicons"] if a["positions"] == "701-1500"]
    assert len(found) == 1 and found[0]["copy_number"] == 2.0 and found[0]["length"] == 800
    assert found[0]["architecture"] == found[0]["ancestor_architecture"] == "flanked" and found[0]["descriptors"] == ["ancestral"]
    assert found[0]["left_is_ref_tn"] and found[0]["right_is_ref_tn"] and found[0]["possible_ISs"] == ["IS1"] and found[0]["chosen_IS"] == "IS1"
    assert {(t["positions"], t["length"]) for t in one["transpositions"]} == {("2296-2300", 4)}
    assert rows["iso2"]["amplicons"] == [] and rows["iso2"]["transpositions"] == []


def test_junction_counts_come_from_all_reads(spark, ran):
    """Spanning reads of each junction of the candidate, by brute force over the reads."""
    tables = ran[0]
    counts = {(r["sample"], r["junction"]): r for r in tables["tnjc2_E_analyzed"].filter("candidate LIKE '%\\_701-1500\\_%'").collect()}
    assert {s for s, _ in counts} == {"iso1", "anc"} and len(counts) == 14
    # the ancestor's reads over the place where the chromosome meets the element (junction 2: base 500 to 501)
    spanning = {i for i in range(0, 3000, 3) if i + 13 <= 500 and i + 100 >= 500 + 13}
    assert counts["anc", 2]["spanning"] >= len(spanning) and counts["anc", 2]["call"] is True
    assert counts["anc", 1]["spanning"] == 0 and counts["anc", 1]["call"] is False


def test_an_ancestor_is_matched_once(spark, files, ran):
    """Two isolates with the same candidate share the ancestor's junctions; one without reads has zeros and no call."""
    inputs = cohort.read_inputs(spark, str(files / "runs.csv"), str(files / "refs" / "*.gb"), str(files / "samples"))
    syn = ran[0]["tnjc2_D_syn_jcts"]
    k = syn.filter("is_anc").count()
    both = syn.unionByName(syn.withColumn("sample", F.lit("iso9")))
    calls = cohort.junction_calls(both, inputs.scaffolds, inputs.reads, cohort.Params()).groupBy("sample").agg(F.count("*").alias("n"), F.sum("spanning").alias("s"), F.count("call").alias("c")).collect()
    assert {r["sample"]: (r["n"], r["s"] > 0, r["c"] > 0) for r in calls} == {"anc": (7 * k, True, True), "iso1": (7 * k, True, True), "iso9": (7 * k, False, False)}


def test_methods_by_reference(spark):
    rows = [("r1", "a", 1, "IS1", "c", 100, 200), ("r1", "b", 1, "IS1", "c", 110, 200), ("r1", "c", 1, "IS2", "c", 100, 200), ("r2", "a", 1, "IS1", "c", 900, 990), ("r2", "b", 1, "IS1", "c", 100, 200)]
    found = spark.createDataFrame(rows, "ref string, method string, tn_id long, tn_name string, scaf string, start long, end long")
    chosen, diffs = islocate.select_method_result(found, "a", ["b", "c"])
    assert chosen.count() == 2
    got = {(r.ref, r.method, r.kind, r.tn_id, r.other_id) for r in diffs.collect()}
    assert got == {("r1", "b", "ends", 1, 1), ("r1", "c", "name", 1, 1), ("r2", "b", "not found", 1, None), ("r2", "b", "not found in first", None, 1), ("r2", "c", "not found", 1, None)}
    with pytest.raises(Exception, match="no element by c in r2"):
        islocate.select_method_result(found, "c", ["a"])[0].collect()


def test_names_by_reference(spark):
    pairs = spark.createDataFrame([("s1", 1, "r1", [1, 2], 2), ("s2", 1, "r2", [1], None)], "sample string, pair_id int, ref string, tn_ids array<long>, chosen_tn long")
    names = spark.createDataFrame([("r1", 1, "IS1"), ("r1", 2, "IS2"), ("r2", 1, "IS9")], "ref string, tn_id long, tn_name string")
    got = {r["sample"]: (r["tn_names"], r["chosen_name"]) for r in junctions.multi_tn_names(pairs, names).collect()}
    assert got == {"s1": (["IS1", "IS2"], "IS2"), "s2": (["IS9"], None)}


def test_fastq_of_several_members_and_a_limit(spark, tmp_path):
    """Gzip members one after another, an unfinished record, a limit that leaves the rest of a file unread."""
    record = "@r{0} x\nACGT{1}\n+\n@III{1}\n"
    with open(tmp_path / "a.fastq.gz", "wb") as f:
        f.write(gzip.compress("".join(record.format(i, "A" * (i % 5)) for i in range(60_000)).encode()))
        f.write(gzip.compress((record.format(60_000, "") + "@r\nAC").encode()))
    (tmp_path / "b c.fastq").write_text(record.format(7, "G"))
    rows = readers.scan_fastq(spark, str(tmp_path))
    assert rows.count() == 60_002 and rows.select("file").distinct().count() == 2
    assert {tuple(r) for r in rows.filter("id = 'r7'").select("id", "seq", "qual").collect()} == {("r7", "ACGTAA", "@IIIAA"), ("r7", "ACGTG", "@IIIG")}
    with open(tmp_path / "c.fastq.gz", "wb") as f:  # broken after the first records
        f.write(gzip.compress("".join(record.format(i, "") for i in range(50_000)).encode())[:-400])
    assert readers.scan_fastq(spark, str(tmp_path), 100).count() == 201
    (tmp_path / "none").mkdir()
    assert readers.scan_fastq(spark, str(tmp_path / "none")).count() == 0
