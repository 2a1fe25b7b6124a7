import random

import pytest
from pyspark.sql import functions as F

from junctionflow.functions import blocks, coords
from junctionflow.operators import alignments, classify, coverage, islocate, junctions, reads

L = F.lit


def test_slices(value):
    s = lambda x, a, b, o, c: value(coords.slice_seq(L(x), L(a), L(b), L(o), L(c)))
    assert s("abcdef", 2, 4, 1, False) == "bcd"
    assert s("ATGCAT", 5, 2, 1, True) == "ATAT"
    assert s("ATGCAT", 5, 2, 1, False) == ""
    assert value(coords.reverse_complement(L("ACGTNacgt"))) == "acgtNACGT"


def test_segment_length(value):
    n = lambda a, b, c: value(coords.segment_length(L(a), L(b), L(1), L(1000), L(c)))
    assert [n(900, 100, True), n(100, 900, True), n(900, 100, False)] == [201, 801, -1]


def test_junction_sequences(value):
    az = L("abcdefghijklmnopqrstuvwxyz".replace("b", "B"))
    a, b = coords.arm(L("s"), L(10), L(-1), L(5)), coords.arm(L("s"), L(11), L(1), L(5))
    one = value(coords.junction_seq_1to2(az, a, L(True), az, b, L(True)))
    assert one == "fghijklmno"


def test_expected_counts_and_read_types(value):
    e = alignments.expected_counts(L(150), L(300))
    got = {k: value(v) for k, v in e.items()}
    assert got == {"left_far": 10, "left": 141, "left_marginal": 13, "spanning": 123, "right_marginal": 13, "right": 141, "right_far": 10}
    kind = lambda a, b: value(alignments.read_type(L(a), L(b), L(300), 13, L(290)))
    cases = {(1, 150): "left_far", (151, 300): "left", (288, 437): "spanning", (289, 438): "right_marginal", (163, 312): "left_marginal", (164, 313): "spanning", (301, 450): "right", (451, 600): "right_far"}
    assert {c: kind(*c) for c in cases} == cases


@pytest.mark.parametrize("spanning,call", [(87, True), (45, True), (20, None), (0, False)])
def test_call(value, spanning, call):
    assert value(alignments.call_junction(L(100), L(100), L(spanning), L(123 / 141))) is call
    assert value(alignments.call_junction(L(0), L(0), L(0), L(123 / 141))) is None


@pytest.mark.parametrize("a,b,out", [("left", "right", ["left", "right", "paired"]), ("left", "spanning", ["left", "spanning"]), ("left", "left", ["left"]), ("left_far", "left", ["left"]), ("right", "left", []), ("left", None, ["left"])])
def test_pair_read_types(value, a, b, out):
    assert value(alignments.pair_read_types(L(a).cast("string"), L(b).cast("string"))) == out


def test_cigars(spark, value):
    ops = value(alignments.cigar_ops(L("5M2I3D4M")))
    assert [(o.op, o["len"], o.ref) for o in ops] == [("M", 5, 0), ("I", 2, 5), ("D", 3, 5), ("M", 4, 8)]
    assert value(alignments.cigar_ref_length(L("5M2I3D4M"))) == 12
    told = value(alignments.resolve_m(alignments.cigar_ops(L("4M1D")), L("ACGT"), L("ACTT")))
    assert [(o.op, o["len"]) for o in told] == [("=", 2), ("X", 1), ("=", 1), ("D", 1)]


def test_architecture_changes(value):
    d = lambda a, b: value(classify.compare_iso_anc(L(a), L(b)))
    assert d("flanked", "unflanked") == ["de novo left", "de novo right"]
    assert d("unflanked", "flanked") == ["lost left", "lost right"]
    assert d("amplicon-only", "unflanked") == ["to singleton"]
    assert d("flanked", "flanked") == ["ancestral"]


def test_arm_lengths(value):
    assert tuple(value(reads.arm_lengths(L(150), L(151)))) == (302, 302)
    assert tuple(value(reads.arm_lengths(L(150), L(100)))) == (300, 200)


def test_recentre(spark):
    rows = spark.createDataFrame([(10, 1, None, [(1, 1, 3), (2, 1, 4)]), (10, 1, None, [(1, 1, -3), (2, 1, -4)])], "pos1 long, dir1 int, ref_tn_side struct<tn_id:int>, ref_tn_sides array<struct<tn_id:int,side:int,offset:int>>")
    got = [(r.pos1, [s.offset for s in r.ref_tn_sides]) for r in junctions.recentre_offset(rows).collect()]
    assert got == [(7, [0, 1]), (14, [1, 0])]


def test_pairing(spark):
    schema = "sample string, num int, scaf2 string, pos2 long, dir2 int, own_tn int, sides array<struct<tn_id:int,side:int>>"
    make = lambda *rows: junctions.pair_junctions(spark.createDataFrame([("s", *r) for r in rows], schema)).collect()
    one = make((1, "c", 500, 1, None, [(1, -1)]), (2, "c", 1000, -1, None, [(1, 1)]))
    assert [(r.left, r.right, r.tn_ids) for r in one] == [(500, 1000, [1])]
    assert not make((1, "c", 500, 1, None, [(1, -1)]), (2, "c", 1000, 1, None, [(1, 1)]))
    assert not make((1, "c", 500, 1, None, [(1, -1)]), (2, "d", 1000, -1, None, [(1, 1)]))
    assert not make((1, "c", 500, 1, None, [(1, 1)]), (2, "c", 1000, -1, None, [(1, 1)]))


def test_chosen_element_is_shared_with_linked_pairs(spark):
    lj, tp = "locus-joining", "transposition"
    made = [(1, 1, 2, None, None, [1, 2, 3], lj), (2, 1, 9, None, None, [2, 3], tp), (3, 8, 2, None, None, [3, 4], tp), (4, 1, 7, None, None, [1, 4], lj), (5, 8, 5, None, 6, [6, 7], lj), (6, 5, 6, None, None, [8, 9], lj)]
    pairs = spark.createDataFrame([("s", *r, 10, 20) for r in made], "sample string, pair_id int, left_num int, right_num int, left_own int, right_own int, tn_ids array<int>, base_event string, left long, right long")
    got = {r.pair_id: r.chosen for r in junctions.link_single_locus(pairs).withColumn("chosen", junctions.chosen_tn(linked=True)).collect()}
    # 1 is linked with 2 on the left and 3 on the right, 4 with 2 (nothing in common), 6 with none
    assert got == {1: 3, 2: 2, 3: 3, 4: None, 5: 6, 6: 8}


def test_isescan_names(spark):
    rows = spark.createDataFrame([("c", 5, 1, "-", None, "IS1"), ("c", 1, 5, "+", None, None), ("c", 1, 5, "+", "IS1", "IS1A")], "seqID string, isBegin int, isEnd int, strand string, family string, cluster string")
    assert [(r.tn_name, r.start, r.end, r.orientation) for r in islocate.normalise_isescan(rows).collect()] == [("IS1", 1, 5, -1), ("unknown", 1, 5, 1), ("IS1:IS1A", 1, 5, 1)]


def test_location_comparison(spark):
    s = "tn_id long, tn_name string, scaf string, start long, end long"
    kinds = lambda a, b: sorted((r.kind, r.start_delta, r.end_delta) for r in islocate.compare_locations(spark.createDataFrame(a, s), spark.createDataFrame(b, s)).collect())
    a = [(1, "IS1", "c", 100, 500)]
    assert kinds(a, [(1, "IS1", "c", 105, 495)]) == [("ends", 5, -5)]
    assert [k[0] for k in kinds(a, [(1, "IS1", "c", 200, 600)])] == ["not found", "not found in first"]
    assert [k[0] for k in kinds(a, [(1, "IS2", "c", 105, 495)])] == ["ends", "name"]
    assert "multiple" in [k[0] for k in kinds(a, [(1, "IS1", "c", 100, 500), (2, "IS2", "c", 101, 500)])]


def test_copy_number_filter(spark):
    rows = spark.createDataFrame([(1, 1.5), (1, 2.0), (1, 3.0), (1, None), (None, 3.0), (1, 0.1)], "chosen_tn int, copy_number double")
    assert [r.copy_number for r in coverage.filter_copy_number(rows, 1.6).collect()] == [2.0, 3.0, None, 0.1]


def test_coverage_profile_against_brute_force(spark):
    made = [(1, 20, 40, True, None, None), (2, 90, 10, True, None, None), (3, 5, 30, True, (95, 4), None), (4, 60, 95, True, None, (96, 8)), (5, 60, 50, True, None, None), (6, 5, 95, True, None, None)]
    made += [(7, 3, 90, False, None, None), (8, 40, 50, False, (30, 39), (51, 70)), (9, 50, 40, False, None, None), (10, 1, 100, True, None, None)]
    want = {}
    for i, start, end, circular, left, right in made:
        if start > end:
            end += 100
        reach = [start, end]  # elements stand where their end of the segment is, before 1 or after 100 too
        for tn, at in ((left, start), (right, end)):
            reach += [min((x - 100, x, x + 100), key=lambda y: abs(y - at)) if circular else x for x in tn or ()]
        flank = int((max(reach) - min(reach)) * 0.2)
        window = range(min(reach) - flank, max(reach) + flank + 1)
        want[i] = sorted({(x - 1) % 100 + 1 for x in window}) if circular else [x for x in window if 1 <= x <= 100]
    want[9] = []  # inverted on a linear scaffold
    rows = spark.createDataFrame([("s", "c", *r, 100) for r in made], "sample string, scaf string, cand_id long, start long, end long, is_circular boolean, left_tn struct<start:long,end:long>, right_tn struct<start:long,end:long>, length long")
    cov = spark.createDataFrame([("s", "c", p, p % 7, 2) for p in range(1, 101)], "sample string, scaf string, pos long, iso int, anc int")
    scaf = rows.select("sample", "cand_id", F.lit(2.0).alias("iso_scaf_avg"), F.lit(4.0).alias("anc_scaf_avg"))
    got = coverage.coverage_profile(rows, cov, scaf, block=16).collect()
    assert {i: sorted(r.pos for r in got if r.cand_id == i) for i in want} == want
    assert all((r.iso_norm, r.anc_norm, r.ratio) == (r.pos % 7 / 2, 0.5, r.pos % 7) for r in got)


def test_the_profile_has_every_order(spark):
    from junctionflow.plans import proof

    d = "/root/testdata/sf0.001"
    rows = proof.v_candidate_of_every_order(spark, d).collect()
    orders = [r.o_orderkey for r in proof.table(spark, d, "orders").collect()]
    assert sorted(r.cand_id for r in rows) == sorted(orders) and all(1 <= r.start <= r.length and 1 <= r.end <= r.length for r in rows)
    assert {r.cand_id for r in proof.v11_coverage_profile(spark, d).select("cand_id").distinct().collect()} == set(orders)


def test_seed_matching_against_brute_force(spark):
    import random

    rng = random.Random(3)
    target = "".join(rng.choice("ACGT") for _ in range(300))
    made = []
    for i in range(60):
        at, read = rng.randrange(200), None
        read = list(target[at : at + 100])
        for _ in range(i % 6):
            read[rng.randrange(100)] = rng.choice("ACGT")
        made.append((i, "".join(read)))
    want = {(i, p, sum(a != b for a, b in zip(r, target[p : p + 100], strict=True))) for i, r in made for p in range(201)}
    want = {w for w in want if w[2] <= 3}
    hits = reads.match_reads(spark.createDataFrame(made, "read_id long, seq string"), spark.createDataFrame([("t", target)], "target string, seq string"), 100)
    assert {(r.read_id, r.start, r.mismatches) for r in hits.filter("NOT is_reverse").collect()} == want


def test_reads_down_to_the_shortest_admitted_are_matched(spark):
    import random

    rng = random.Random(4)
    texts = {"t": "".join(rng.choice("ACGT") for _ in range(700))}
    texts |= {"u": texts["t"][300:520] + "ACGT" * 30, "v": texts["t"], "w": "ACG"}
    made = [(0, texts["t"][500:589]), (1, "ACGT" * 24)]
    for i in range(2, 90):
        n, at = 90 + i % 12, rng.randrange(590)
        read = list(texts["t"][at : at + n])
        for p in rng.sample(range(n), i % 5):
            read[p] = "CGTA"["ACGT".index(read[p])]
        made.append((i, "".join(read)))
    made.append((90, made[5][1]))
    turned = lambda r: r[::-1].translate(str.maketrans("ACGT", "TGCA"))
    made = [(i, turned(r) if i % 3 == 0 else r) for i, r in made]
    want = set()
    for i, r in made:
        for back, q in ((False, r), (True, turned(r))):
            for name, t in texts.items():
                for p in range(len(t) - len(q) + 1) if len(q) >= 90 else ():
                    n = sum(a != b for a, b in zip(q, t[p : p + len(q)], strict=True))
                    if n <= 3:
                        want.add((i, name, back, p, n))
    hits = reads.match_reads(spark.createDataFrame(made, "read_id long, seq string"), spark.createDataFrame(list(texts.items()), "target string, seq string"), 100)
    got = [tuple(h) for h in hits.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {i for i, *_ in want} & {i for i, r in made if len(r) < 100}


def test_latest_status_stream(spark, tmp_path):
    import datetime as dt

    from junctionflow.streaming import status

    rows = spark.createDataFrame([(1, "started", dt.datetime(2024, 1, 1), 1), (1, "completed", dt.datetime(2024, 1, 2), 2), (2, "started", dt.datetime(2024, 1, 1), 3)], "run_id int, state string, ts timestamp, seq long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = status.latest_status_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("latest").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.run_id, r.state) for r in spark.table("latest").collect()} == {(r.run_id, r.state) for r in status.latest_status(rows).collect()} == {(1, "completed"), (2, "started")}


def test_entry_module_imports_without_the_corpus_part():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_mode_of_a_skewed_distribution(spark):
    """Of 1..100 once each and 40 fifty times more, by hand: n = 150, quartiles of the logs, nine bins or more."""
    import math

    import numpy as np

    x = np.log(np.array([*range(1, 101), *[40] * 50], float))
    q1, q3 = np.percentile(x, [25, 75])
    edges = np.linspace(x.min(), x.max(), max(10, int((x.max() - x.min()) / (2 * (q3 - q1) / 150 ** (1 / 3)))))
    k = int(np.histogram(x, edges)[0].argmax())
    rows = spark.createDataFrame([(0, "s", v, 51 if v == 40 else 1) for v in range(1, 101)] + [(0, "flat", 7, 3)], "sample int, scaf string, x int, n long")
    got = {r.scaf: r.average for r in coverage.distribution_mode(rows, ["sample", "scaf"]).collect()}
    assert got["s"] == pytest.approx(math.exp((edges[k] + edges[k + 1]) / 2)) and got["flat"] == pytest.approx(7)


def test_candidates_without_ancestor_coverage_stay(spark):
    histogram = spark.createDataFrame([(0, 1, 5, 0, 3), (0, 2, 6, 2, 1)], "sample int, cand_id int, iso int, anc int, n long")
    scaffolds = spark.createDataFrame([(0, 1, 4.0, 2.0), (0, 2, 4.0, 2.0)], "sample int, cand_id int, iso_scaf_avg double, anc_scaf_avg double")
    rows = coverage.copy_numbers(coverage.amplicon_averages(histogram, scaffolds)).withColumn("chosen_tn", L(1))
    assert {r.cand_id: r.copy_number for r in rows.collect()} == {1: None, 2: 1.5}
    assert {r.cand_id for r in coverage.filter_copy_number(rows).collect()} == {1, 2}


def test_strand_words_and_empty_names(spark):
    made = [("s", 1, 9, w, f, "N/A") for w, f in (("reverse", "IS5"), ("rev", "n/a"), ("+", "IS5"), ("-1", "IS5"))]
    rows = spark.createDataFrame(made, "seqID string, isBegin int, isEnd int, strand string, family string, cluster string")
    assert [(r.tn_name, r.orientation) for r in islocate.normalise_isescan(rows).collect()] == [("IS5", -1), ("unknown", -1), ("IS5", 1), ("IS5", -1)]


def test_word_on_a_covered_fourth_junction(value):
    assert value(classify.flag_amp_amp(F.array(L("ancestral")), L(True))) == ["ancestral", "observed amplicon-amplicon (IS loss)"]


def test_shared_elements_with_both_sides(spark):
    schema = "sample string, num int, scaf2 string, pos2 long, dir2 int, own_tn int, sides array<struct<tn_id:int,side:int,offset:int>>"
    rows = [("s", 1, "c", 500, -1, None, [(2, 1, 3), (1, -1, 0)]), ("s", 2, "c", 1000, 1, None, [(1, 1, -2), (2, -1, 4)])]
    got = junctions.pair_junctions(spark.createDataFrame(rows, schema)).withColumn("chosen_tn", L(2)).withColumn("s", junctions.chosen_tn_sides()).head()
    assert (got.left, got.right, [(m.tn_id, tuple(m.left), tuple(m.right)) for m in got.matches]) == (1000, 500, [(1, (1, -2), (-1, 0)), (2, (-1, 4), (1, 3))])
    assert (tuple(got.s.left), tuple(got.s.right)) == ((-1, 4), (1, 3))


def test_arms_match_element_ends_of_their_own_reference(spark):
    end = "TTTTTTTTTTGACCATGCAATTCGGCTAAGC"
    ends = spark.createDataFrame([("r1", 7, -1, end, 10), ("r2", 8, 1, end, 10), ("r1", 9, 1, "", 10)], "ref string, tn_id int, side int, end_seq string, flank int")
    arms = [("r1", 1, 1, "GACCATGCAATTCGGCTAAGC"), ("r1", 2, 1, "CATGCAATTCGG"), ("r1", 3, 2, "GACCATGCAATTCGTCTAAGC"), ("r2", 4, 1, "TTTTTGACCATGCAATTCGGCTAA"), ("r1", 5, 1, "ACG"), ("r3", 6, 1, "GACCATGCAATTCGGCTAAGC")]
    got = junctions.match_tn_ends(spark.createDataFrame(arms, "ref string, num int, arm int, arm_seq string"), ends).collect()
    # each against a plain search, trimmed by five: 2 is short and 3 differs in its last bases only, 4 starts before the junction
    assert {(r.ref, r.num, r.tn_id, r.offset) for r in got} == {("r1", 1, 7, 0), ("r1", 2, 7, 3), ("r2", 4, 8, -5)}


def test_reference_junctions_match_themselves(spark):
    side = "array<struct<tn_id:int,side:int,offset:int>>"
    schema = f"num int, ref_tn_side struct<tn_id:int,side:int>, scaf1 string, scaf2 string, pos1 int, pos2 int, dir1 int, dir2 int, flanking1 int, flanking2 int, sides1 {side}, sides2 {side}"
    at = ("c", "d", 10, 20, 1, -1, 50, 60)
    good = [(-2, (1, -1), *at, [(1, -1, 0)], [(2, 1, 0)]), (1, None, *at, [], [(2, 1, 0)]), (2, None, *at, [], [])]
    got = {r.num: (r.swapped, r.pos1) for r in junctions.normalise_tn_arm(spark.createDataFrame(good, schema)).collect()}
    assert got == {-2: (False, 10), 1: (True, 20)}
    with pytest.raises(Exception, match="does not match itself"):
        junctions.normalise_tn_arm(spark.createDataFrame([(-2, (1, -1), *at, [(1, -1, 2)], [])], schema)).collect()


def test_synthetic_junctions_of_a_flanked_candidate(spark):
    link = "struct<pair_id:int,left:long,right:long,base_event:string,tn_ids:array<int>>"
    match = "array<struct<tn_id:int,left:struct<side:int,offset:int>,right:struct<side:int,offset:int>>>"
    row = (1, "c", 1000, 2000, (2, 990, 940, "reference-tn", [1]), (3, 2050, 1990, "transposition", [1]), 1, [(1, (1, 2), (-1, -1))])
    linked = spark.createDataFrame([row], f"pair_id int, scaf string, left long, right long, left_link {link}, right_link {link}, chosen_tn int, matches {match}")
    elements = spark.createDataFrame([(1, "d", 5000, 5700)], "tn_id int, scaf string, start long, end long")
    rows = reads.seven_junctions(reads.synthetic_arms(reads.flank_arms(linked, 50), elements, 50)).orderBy("junction").collect()
    assert {r.candidate for r in rows} == {"jc_c_1000-2000_d_4999-5698_L+59L+59_R+0R+49E_50bp"} and all(r.consistent for r in rows)
    ends = [(r.junction_type, r.arm1.start, r.arm1.dir, r.arm2.start, r.arm2.dir, r.chr_pos) for r in rows]
    assert ends == [
        ("CHR_AMP", 940, -1, 1000, 1, 940), ("CHR_TN", 940, -1, 4999, 1, 940), ("AMP_TN", 2000, -1, 4999, 1, 2000), ("AMP_AMP", 2000, -1, 1000, 1, None),
        ("TN_AMP", 5698, -1, 1000, 1, 1000), ("TN_CHR", 5698, -1, 2050, 1, 2050), ("AMP_CHR", 2000, -1, 2001, 1, 2001),
    ]


def test_arms_to_columns_and_back(spark):
    rows = spark.createDataFrame([("c", 5, 1, 10, "d", 7, -1, 20)], "scaf1 string, pos1 long, dir1 int, flanking1 int, scaf2 string, pos2 long, dir2 int, flanking2 int")
    assert coords.from_arms(coords.jc_arms(rows)).select(rows.columns).collect() == rows.collect()
    both = spark.range(1).select(coords.segment_junctions(L("c"), L(10), L(90), L(5), L(6)).alias("j")).head().j
    assert [(j.arm1.start, j.arm1.dir, j.arm1.flank, j.arm2.start, j.arm2.dir, j.arm2.flank) for j in both] == [(10, 1, 5, 9, -1, 6), (90, -1, 5, 91, 1, 6)]


def test_downsampling_by_share_of_the_expected(spark):
    made = [("s", "x", 1, f"{t}{i}", t, i, i + 10) for t, n in (("left", 100), ("spanning", 30), ("paired", 9), ("left_far", 50), ("right", 3)) for i in range(n)]
    typed = spark.createDataFrame(made, f"{alignments.GROUP[0]} string, {alignments.GROUP[1]} string, {alignments.GROUP[2]} int, read_id string, read_type string, start int, end int")
    expected = {t: L(n) for t, n in {"left_far": 10, "left": 50, "left_marginal": 0, "spanning": 25, "right_marginal": 0, "right": 25, "right_far": 10}.items()}
    got = alignments.downsample_hits(typed, expected, 40).groupBy("read_type").count().collect()
    # of 40 reads 20 left, 10 spanning and 10 right: every 5th of 100, every 3rd of 30 and of the 9 paired, all right
    assert {r.read_type: r["count"] for r in got} == {"left": 20, "spanning": 10, "paired": 3, "right": 3}


def test_arm_sequences_from_blocks(spark):
    """Arms over block ends, around the origin, past the end of a linear scaffold, on both strands, by reference."""
    rng = random.Random(2)
    seqs = {("r1", "c"): "".join(rng.choice("ACGT") for _ in range(90)), ("r1", "l"): "".join(rng.choice("ACGT") for _ in range(61)), ("r2", "c"): "".join(rng.choice("ACGT") for _ in range(90))}
    scaffolds = spark.createDataFrame([(r, s, q, s == "c") for (r, s), q in seqs.items()], "ref string, scaf string, seq string, is_circular boolean")
    arms = [(r, (s, start, d, n)) for r, s in seqs for start in (1, 7, 30, 61, 88, -3, 95) for d in (1, -1) for n in (1, 9, 40)]
    rows = spark.createDataFrame(arms, "ref string, arm struct<scaf: string, start: bigint, dir: int, flank: int>")
    got = {(r.ref, tuple(r.arm)): r.arm_seq for r in blocks.arm_sequences(rows.union(rows), scaffolds, 16).collect()}
    flip = str.maketrans("ACGT", "TGCA")
    for r, (s, start, d, n) in arms:
        q, places = seqs[r, s], [start + d * i for i in range(n)]
        want = "".join(q[(p - 1) % len(q)] if s == "c" else q[p - 1] for p in places if s == "c" or 1 <= p <= len(q))
        assert got.get((r, (s, start, d, n)), "") == (want if d == 1 else want.translate(flip)), (r, s, start, d, n)


def test_repetitive_seeds_are_salted(spark):
    """Poly-A reads and targets: the same matches with seeds dealt over salts as by brute force."""
    targets = [(f"t{i}", "A" * (100 + i) + "C" * i) for i in range(6)]
    given = [(i, "A" * 90 if i % 3 else "A" * 89 + "C") for i in range(12)] + [(100, "T" * 91)]
    q = spark.createDataFrame(given, "read_id long, seq string")
    t = spark.createDataFrame(targets, "target string, seq string")
    got = {tuple(r) for r in reads.match_reads(q, t, 99, 3, 10_000, block=32, seed_rows=5).collect()}
    flip = str.maketrans("ACGT", "TGCA")
    want = set()
    for i, s in given:
        for rev, x in ((False, s), (True, s.translate(flip)[::-1])):
            for name, text in targets:
                for p in range(len(text) - len(x) + 1):
                    n = sum(a != b for a, b in zip(x, text[p : p + len(x)], strict=True))
                    if n <= 3:
                        want.add((i, name, rev, p, n))
    assert got == want
    seeds = q.select(F.lit(1).alias("seed"), "read_id")
    words = spark.range(100).select(F.lit(1).alias("seed"), F.col("id").alias("p"))
    a, b = reads.salted_seeds(seeds, words, 5)
    assert a.join(b, ["seed", "salt"]).count() == 13 * 100 and b.groupBy("salt").count().agg(F.max("count")).head()[0] < 20


def test_length_gate_and_its_reasons(spark):
    rows = spark.createDataFrame([("s", "locus-joining", n) for n in (99, 100, 500, 1_000_000, 1_000_001)] + [("s", "transposition", 50), ("t", "reference-tn", 500)], "sample string, base_event string, length long")
    got = {r["sample"]: (r.n_locus_joining, r.n_too_long, r.n_too_short, r.n_kept) for r in coverage.length_gate_counts(rows).collect()}
    assert got == {"s": (5, 1, 1, 3), "t": (0, 0, 0, 0)}
    assert sorted(r.length for r in coverage.length_gate(rows).collect()) == [100, 500, 1_000_000]


def test_count_arithmetic(spark):
    fields = ", ".join(f"{t} long" for t in alignments.READ_TYPES)
    a = spark.createDataFrame([("s", "c", 1, *range(1, 9)), ("s", "c", 2, *[5] * 8)], f"sample string, candidate string, junction int, {fields}")
    b = spark.createDataFrame([("s", "c", 1, *[2] * 8), ("s", "c", 3, *[7] * 8)], f"sample string, candidate string, junction int, {fields}")
    of = lambda df: {r["junction"]: ([r[t] for t in alignments.READ_TYPES], r["total"]) for r in df.collect()}
    assert of(alignments.count_arithmetic(a, b, "+")) == {1: ([3, 4, 5, 6, 7, 8, 9, 10], 52), 2: ([5] * 8, 40), 3: ([7] * 8, 56)}
    assert of(alignments.count_arithmetic(a, b, "/"))[1][0] == [n / 2 for n in range(1, 9)] and of(alignments.count_arithmetic(a, b, "/"))[2] == ([None] * 8, None)
    assert of(alignments.count_arithmetic(a, b, "//"))[1][0] == [n // 2 for n in range(1, 9)]
    assert of(alignments.count_arithmetic(a, 3, "max"))[1][0] == [3, 3, 3, 4, 5, 6, 7, 8]
    assert of(alignments.count_arithmetic(a, 2, "-"))[2] == ([3] * 8, 24)


def test_nearest_gap_over_bins(spark):
    """Bins and groups of bins of small sizes, repeated positions, negative ones, a scaffold that the other set lacks."""
    rng = random.Random(4)
    a, b = ([(rng.choice("xy"), rng.randint(-50, 400)) for _ in range(n)] for n in (120, 12))
    a += [("x", 77)] * 40 + [("z", 5)]
    frame = lambda rows: spark.createDataFrame(rows, "scaf string, pos long")
    want = sorted((s, p, min((abs(p - q) for t, q in b if t == s), default=None)) for s, p in a if s != "z") + [("z", 5, None)]
    for width, group in ((3, 2), (50, 3), (4096, 4096)):
        assert sorted(map(tuple, classify.nearest_position_gap(frame(a), frame(b), width, group).collect())) == want


def test_limits_of_a_profile(spark):
    """Percentiles of the window's values over the scaffold averages, by numpy."""
    import numpy as np

    rng = random.Random(6)
    iso, anc = [rng.randint(0, 60) for _ in range(500)], [rng.randint(5, 20) for _ in range(500)]
    cov = spark.createDataFrame([("s", "c", i + 1, iso[i], anc[i]) for i in range(500)], "sample string, scaf string, pos long, iso int, anc int")
    cands = spark.createDataFrame([("s", "c", 1, 100, 199, 500), ("s", "c", 2, 450, 49, 500), ("s", "c", 3, 1, 480, 500)], "sample string, scaf string, cand_id int, start long, end long, length long")
    scaf = spark.createDataFrame([("s", i, 20.0, 10.0) for i in (1, 2, 3)], "sample string, cand_id int, iso_scaf_avg double, anc_scaf_avg double")
    windows = {1: range(81, 219), 2: [(p - 1) % 500 + 1 for p in range(431, 569)], 3: range(1, 501)}
    for r in coverage.profile_limits(cands, cov, scaf, block=32).collect():
        x, y = ([v[p - 1] / avg for p in windows[r.cand_id]] for v, avg in ((iso, 20), (anc, 10)))
        low, high = min(np.percentile(x, 1), np.percentile(y, 1)), max(np.percentile(x, 99), np.percentile(y, 99))
        assert (r.low, r.high) == pytest.approx((max(low / 1.1, 0.1), high * 1.1))


def test_names_after_colons_and_blanks(spark):
    rows = [("mobile_element", {"mobile_element_type": [t]}, 0, 9, 1) for t in ("insertion sequence:IS1", "insertion sequence : IS2", "Insertion sequence IS3", "transposon:Tn1")]
    df = spark.createDataFrame(rows, "type string, qualifiers map<string, array<string>>, start0 int, end int, strand int").selectExpr("*", "'r' AS ref", "'c' AS scaf")
    assert sorted(r.tn_name for r in islocate.is_features(df).collect()) == ["IS1", "IS2", "IS3"]


def made_coverage(spark, seed: int = 8):
    """Three scaffolds with gaps, zeros and nulls, one of them without coverage, and segments that wrap or lie in a gap; and a made average of each."""
    rng = random.Random(seed)
    cov = [(s, c, p, rng.choice([None, 0, *range(12)]), rng.choice([None, 0, 1, 2, 3])) for s, c, n in (("s", "c", 300), ("s", "d", 90), ("t", "c", 150)) for p in range(1, n + 1) if not 40 <= p < 55]
    cands = [(s, c, i, rng.randint(1, n), rng.randint(1, n), n) for i, (s, c, n) in enumerate([("s", "c", 300)] * 30 + [("s", "d", 90)] * 6 + [("t", "c", 150)] * 6 + [("t", "e", 50)])] + [("s", "c", 90, 42, 50, 300), ("s", "d", 91, 1, 90, 90)]
    return spark.createDataFrame(cov, "sample string, scaf string, pos long, iso int, anc int"), spark.createDataFrame(cands, "sample string, scaf string, cand_id long, start long, end long, length long")


def steps_above_python(df) -> str:
    """The plan down to where Python gets scaffolds and segments."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("MapInArrow")]


@pytest.mark.parametrize("method", ["median", "mean", "mode"])
def test_averages_beside_the_coverage(spark, method):
    """As from histograms that are joined and grouped: over blocks of any size, with candidates dealt over tasks."""
    cov, cands = made_coverage(spark)
    iso, anc = (coverage.scaffold_average(cov.filter(F.col(c).isNotNull()), c, "mean").withColumnRenamed("average", f"{c}_scaf_avg") for c in ("iso", "anc"))
    scaf = cands.select("sample", "scaf", "cand_id").join(iso, ["sample", "scaf"], "left").join(anc, ["sample", "scaf"], "left").drop("scaf")
    near = lambda rows: {(r.sample, r.cand_id): [x and pytest.approx(x) for x in r[2:]] for r in rows}
    names = ["sample", "cand_id", "iso_scaf_avg", "anc_scaf_avg", "iso_amplicon_avg", "anc_amplicon_avg", "avg_norm_cov"]
    want = coverage.amplicon_averages(coverage.amplicon_histogram(cands, cov, 16), scaf, method).select(*names).collect()
    assert len(want) == 45 and 2 <= sum(r.avg_norm_cov is None for r in want) < 10
    for block, most in ((16, 20_000), (7, 4)):
        got = coverage.segment_averages(cands, cov, method, "mean", block, most)
        assert got.columns == names
        assert near(got.collect()) == near(want)


def test_ranges_in_small_steps(monkeypatch):
    import numpy as np

    from junctionflow.functions import ranges

    rng = np.random.default_rng(5)
    x = np.where(rng.random(200) < 0.1, np.nan, rng.integers(0, 9, 200))
    low = rng.integers(0, 200, (30, 2))
    high = np.minimum(low + rng.integers(0, 90, (30, 2)), 200)
    for cells in (10, 40, 1 << 22):
        monkeypatch.setattr(ranges, "CELLS", cells)
        for block in (1, 16, 500):
            values = ranges.Values(x, block)
            parts = [np.concatenate([x[a:b] for a, b in zip(*r, strict=True)]) for r in zip(low, high, strict=True)]
            assert (values.counts(low, high) == [[(p == v).sum() for v in values.distinct] for p in parts]).all()
        for most in (1, 7, 1000):
            owner, at = (np.concatenate(a) for a in zip(*ranges.spread(low[:, 0], high[:, 0], most), strict=True))
            assert [(o, i) for o, (a, b) in enumerate(zip(low[:, 0], high[:, 0], strict=True)) for i in range(a, b)] == list(zip(owner.tolist(), at.tolist(), strict=True))


@pytest.mark.parametrize("name", ["v10_filter_copy_number", "v11_profile_limits", "v4_v9_copy_number", "v6_v7_mean", "v6_v7_mode", "v11_coverage_profile"])
def test_queries_on_segments_shuffle_no_positions(spark, name):
    """What Python makes of a segment beside its scaffold's coverage is not shuffled after that."""
    from junctionflow.plans import proof

    assert "Exchange" not in steps_above_python(proof.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_equal_stretches_share_their_seed():
    """At the same place, whatever stands around them; in steps of any size, of repeated letters too, and none across two texts."""
    import numpy as np
    import pyarrow as pa

    from junctionflow.functions import seeds

    rng = random.Random(9)
    core = "".join(rng.choice("ACGT") for _ in range(60))
    texts = ["A" * 50, core, "G" + core + "TT", "", "ACG", core[:21], core[5:40] * 2]
    for k in (5, 12, 13, 22):
        texts_k = [t for t in texts if len(t) >= k]
        for step in (7, 1 << 20):
            seeds.STEP, was = step, seeds.STEP
            try:
                found = [(int(o), int(p), int(h)) for part in seeds.every_seed(pa.array(["x", *texts])[1:], k) for o, p, h in zip(*part[:3], strict=True)]
                first = [(int(o), int(p), int(h)) for part in seeds.first_seeds(pa.array(texts_k), k, 1) for o, p, h in zip(*part[:3], strict=True)]
            finally:
                seeds.STEP = was
            assert len(found) == len(set(found))
            want, of = set(), {}
            for i, t in enumerate(texts):
                for a in range(len(t) - k + 1):
                    value, place = seeds.least(np.frombuffer(t[a : a + k].encode(), np.uint8), k)
                    assert len(value) == 1 and of.setdefault(t[a : a + k], (value.view(np.int64)[0], place[0])) == (value.view(np.int64)[0], place[0])
                    want.add((i, a + int(place[0]), int(value.view(np.int64)[0])))
            assert set(found) == want
            assert first == [(i, int(of[t[:k]][1]), int(of[t[:k]][0])) for i, t in enumerate(texts_k)]
    many = "".join(rng.choice("ACGT") for _ in range(5000))
    assert sum(len(part[0]) for part in seeds.every_seed(pa.array([many]), 22)) < 5000 / 3


def test_bits_around_seeds(monkeypatch):
    """A read's bits are those of its place in a text but for its mismatches, at the ends of both and in steps of any size; elsewhere they differ."""
    import numpy as np
    import pyarrow as pa

    from junctionflow.functions import seeds

    rng = random.Random(11)
    text = "".join(rng.choice("ACGT") for _ in range(900))
    made = [(p, n, rng.sample(range(n), i % 4)) for i, (p, n) in enumerate((rng.choice((0, 800, rng.randrange(800))), rng.randrange(90, 101)) for _ in range(200))]
    made = [(p, "".join("CGTA"["ACGT".index(c)] if j in differ else c for j, c in enumerate(text[p : p + n]))) for p, n, differ in made]
    for step in (50, 1 << 20):
        monkeypatch.setattr(seeds, "STEP", step)
        words = [w for part in seeds.every_seed(pa.array(["TTT", text]), 22) for w in zip(*map(np.ndarray.tolist, part), strict=True)]
        places, apart = {p: (seed, around) for i, p, seed, around in words if i == 1}, 0
        for i, q, seed, mine, inside in (r for part in seeds.first_seeds(pa.array([r for _, r in made]), 22, 4) for r in zip(*map(np.ndarray.tolist, part), strict=True)):
            at, read = made[i]
            differs = sum(a != b for a, b in zip(read, text[at:], strict=False))
            if places.get(at + q, (None, 0))[0] == seed:
                assert ((mine ^ places[at + q][1]) & inside & ~(-1 << 64)).bit_count() <= differs
            apart += sum(((mine ^ around) & inside & ~(-1 << 64)).bit_count() <= 3 for _, around in list(places.values())[:40])
        assert apart < 400  # of 32,000, the same places among them
