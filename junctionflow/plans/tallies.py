"""Counts, filters and names of junctions, reads and runs over the driver's tables, each beside its SQL; registered with
those of ``proof``, whose views they use."""

from __future__ import annotations

from pyspark.sql import functions as F

from junctionflow.functions import coords
from junctionflow.operators import alignments, classify, coverage, islocate, junctions, reads
from junctionflow.plans.proof import ALN, CHOSEN, PAIRS, TYPED, _kind, best_rows, query, read_counts, table, typed_rows, v_aln, v_chosen, v_pairs, v_tnjc


@query("""WITH big AS (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 14)
SELECT o_custkey AS sample, o_orderkey AS num, o_orderkey * 7919 % 20000 AS pos, NULL AS tn_id FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_custkey NOT IN (SELECT o_custkey FROM big WHERE o_custkey IS NOT NULL)
UNION ALL SELECT NULL, p_partkey, p_size, p_partkey % 9 FROM part""")
def j2_j4_all_junctions(spark, d):
    k = F.col("o_orderkey")
    lines = table(spark, d, "orders").select(F.col("o_custkey").alias("sample"), k.alias("num"), (k * 7919 % 20000).alias("pos"), F.when(F.col("o_orderpriority") == "1-URGENT", "COVERAGE").alias("reject"))
    observed = junctions.reject_filter(junctions.size_guard(lines, 14)[0]).drop("reject")
    reference = table(spark, d, "part").select(F.col("p_partkey").alias("num"), F.col("p_size").cast("long").alias("pos"), (F.col("p_partkey") % 9).alias("tn_id"))
    return junctions.union_junctions(reference, observed).select("sample", "num", "pos", "tn_id")


@query("""WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END AS dir, o_orderkey * 7919 % 20000 + 1 AS pos, o_orderkey % 11 = 0 AS own, o_orderkey % 7 - 3 AS a, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 7 + 1 END AS b FROM orders),
m AS (SELECT *, CASE WHEN own THEN 0 WHEN b IS NULL THEN a ELSE CAST(floor((a + b) / 2) AS BIGINT) END AS mean FROM t)
SELECT k AS num, pos - mean * dir AS pos1, a - mean AS first_offset, b - mean AS second_offset FROM m""")
def j7_recentre_offset(spark, d):
    sides = F.transform("sides", lambda s, i: s.withField("offset", (F.col("num") % 7 - 3 + 4 * i).cast("int")))
    rows = v_tnjc(spark, d).select("num", F.col("pos2").alias("pos1"), F.col("dir2").alias("dir1"), F.when(F.col("own_tn").isNotNull(), F.struct("own_tn")).alias("ref_tn_side"), sides.alias("ref_tn_sides"))
    offset = lambda i: F.get("ref_tn_sides", i)["offset"].cast("long")
    return junctions.recentre_offset(rows).select("num", "pos1", offset(F.lit(0)).alias("first_offset"), offset(F.lit(1)).alias("second_offset"))


@query(f"""WITH {PAIRS}, held AS (SELECT DISTINCT sample, pair_id AS other, unnest([left_num, right_num]) AS num FROM pairs WHERE base_event <> 'locus-joining'),
n AS (SELECT p.sample, p.pair_id, count(*) FILTER (h.num = p.left_num) AS l, count(*) FILTER (h.num = p.right_num) AS r
  FROM pairs p JOIN held h ON p.sample = h.sample AND h.num IN (p.left_num, p.right_num) AND h.other <> p.pair_id GROUP BY ALL)
SELECT sample, pair_id FROM n WHERE l > 1 OR r > 1""")
def j14_flag_multi_link(spark, d):
    return junctions.flag_multi_link(junctions.link_single_locus(v_pairs(spark, d))).select("sample", F.col("pair_id").cast("long"))


NAMES = "names AS (SELECT p_partkey AS tn_id, 'IS' || (p_partkey * 5 % 7) AS tn_name FROM part)"


def v_names(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("tn_id"), F.concat(F.lit("IS"), (F.col("p_partkey") * 5 % 7).cast("string")).alias("tn_name"))


@query(f"""WITH {CHOSEN}, {NAMES}, each AS (SELECT sample, pair_id, unnest(tn_ids) AS tn_id FROM chosen),
listed AS (SELECT sample, pair_id, array_to_string(list_sort(list(DISTINCT tn_name)), ',') AS tn_names FROM each JOIN names USING (tn_id) GROUP BY ALL)
SELECT sample, pair_id, tn_names, tn_name AS chosen_name FROM chosen LEFT JOIN listed USING (sample, pair_id) LEFT JOIN names ON tn = names.tn_id""")
def j18_multi_tn_names(spark, d):
    named = junctions.multi_tn_names(v_chosen(spark, d), v_names(spark, d))
    return named.select("sample", F.col("pair_id").cast("long"), F.array_join("tn_names", ",").alias("tn_names"), "chosen_name")


@query(f"""WITH {PAIRS}, {NAMES}, each AS (SELECT sample, pair_id, unnest(tn_ids) AS tn_id FROM pairs),
listed AS (SELECT sample, pair_id, array_to_string(list_sort(list(DISTINCT tn_name)), ',') AS tn_names FROM each JOIN names USING (tn_id) GROUP BY ALL)
SELECT sample, pair_id, "left" || '-' || "right" AS positions, "right" - "left" AS length, tn_names FROM pairs LEFT JOIN listed USING (sample, pair_id) WHERE base_event = 'transposition'""")
def a7_summary_transpositions(spark, d):
    rows = classify.summary_transpositions(junctions.multi_tn_names(v_pairs(spark, d), v_names(spark, d)))
    return rows.select("sample", F.col("pair_id").cast("long"), "positions", "length", F.array_join("possible_ISs", ",").alias("tn_names"))


@query("SELECT l_orderkey AS pos, l_linenumber AS line, CAST(floor(l_quantity + l_linenumber + 0.5) AS INT) AS cov FROM lineitem")
def v1_total_depth(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("pos"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("double").alias("unique_top_cov"), (F.col("l_linenumber") + 0.5).alias("unique_bot_cov"))
    return coverage.total_depth(rows).select("pos", "line", "cov")


@query(f"""WITH {PAIRS}, c AS (SELECT sample, base_event AS event, CASE WHEN "left" <= "right" THEN "right" - "left" + 1 ELSE "right" - "left" + 20001 END AS n FROM pairs)
SELECT sample, count(*) FILTER (event = 'locus-joining') AS n_locus_joining, count(*) FILTER (event = 'locus-joining' AND n > 15000) AS n_too_long, count(*) FILTER (event = 'locus-joining' AND n < 2000) AS n_too_short,
  count(*) FILTER (event = 'locus-joining' AND n BETWEEN 2000 AND 15000) AS n_kept FROM c GROUP BY sample""")
def v3_length_gate(spark, d):
    rows = v_pairs(spark, d).withColumn("length", junctions.amplicon_length(F.col("left"), F.col("right"), F.lit(20000)))
    return coverage.length_gate_counts(rows, 2000, 15000)


@query("""WITH e AS (SELECT event_id AS read_id, event_id % 5 = 0 AS plain, 292 + event_id * 7 % 17 AS p, 1 + event_id % 4 AS c FROM events)
SELECT read_id, plain OR (abs(p - 300) <= 4 AND abs(p + 3 - 300) <= 4 AND abs(p + 3 + c - 300) <= 4) AS near, plain AS clean FROM e""")
def n3_indels_near_junction(spark, d):
    e = F.col("event_id")
    before = 20 + e % 30
    cigar = F.when(e % 5 == 0, "100M").otherwise(F.concat(before.cast("string"), F.lit("M2I3="), (1 + e % 4).cast("string"), F.lit("D40M")))
    rows = table(spark, d, "events").select(e.alias("read_id"), (292 + e * 7 % 17 - before).alias("start"), alignments.cigar_ops(cigar).alias("ops"))
    near = lambda dist: alignments.indels_near_junction(F.col("ops"), F.col("start"), F.lit(300), dist)
    return rows.select("read_id", near(4).alias("near"), near(-1).alias("clean"))


@query(f"""WITH {ALN} SELECT candidate, junction, read_id, is_reverse, min(start) AS start, max("end") AS "end", CAST(count(*) AS INT) AS n_hits, (min({{'s': start, 'e': "end", 'x': score, 'i': aln_index}})).i AS first_hit FROM aln GROUP BY ALL""")
def n7_combine_hits(spark, d):
    rows = alignments.combine_hits(v_aln(spark, d))
    return rows.select("candidate", "junction", "read_id", "is_reverse", "start", "end", F.size("hits").alias("n_hits"), F.get("hits", 0)["aln_index"].alias("first_hit"))


@query("""SELECT o_orderkey AS run, 10 AS far, n + 1 - 10 AS side, 13 AS marginal, n + 1 - 28 AS spanning, 2 * (2 * n) - n + 1 AS total FROM (SELECT o_orderkey, 100 + o_orderkey % 90 AS n FROM orders)""")
def n12_expected_counts(spark, d):
    n = F.col("n").cast("long")
    want = alignments.expected_counts(n, 2 * n)
    total = sum(want.values(), F.lit(0))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("run"), (100 + F.col("o_orderkey") % 90).alias("n"))
    return rows.select("run", want["left_far"].alias("far"), want["right"].alias("side"), want["left_marginal"].alias("marginal"), want["spanning"].alias("spanning"), total.alias("total"))


@query(f"""WITH {TYPED} SELECT read_id // 70 AS candidate, junction, count(*) FILTER (t = 'paired') AS paired FROM counted GROUP BY ALL HAVING count(*) FILTER (t = 'paired') > 0 AND count(*) FILTER (t = 'spanning') = 0""")
def n14_paired_without_span(spark, d):
    few = typed_rows(spark, d).withColumn("candidate", F.floor(F.col("read_id") / 70))  # ten reads on a junction
    return alignments.warn_paired_without_span(alignments.count_read_types(few)).select("candidate", "junction", "paired")


def _next_candidate(spark, d):
    return read_counts(spark, d).withColumn("candidate", F.col("candidate") + 1)


TWO_TABLES = f"""{TYPED}, b AS (SELECT candidate + 1 AS candidate, * EXCLUDE (candidate) FROM counts)"""


@query(
    f"WITH {TWO_TABLES}, s AS (SELECT coalesce(a.candidate, b.candidate) AS candidate, coalesce(a.junction, b.junction) AS junction, "
    + ", ".join(f'coalesce(a."{t}", 0) - coalesce(b."{t}", 0) AS "{t}"' for t in alignments.READ_TYPES)
    + ' FROM counts a FULL JOIN b ON a.candidate = b.candidate AND a.junction = b.junction) SELECT candidate, junction, "left", spanning, paired, '
    + " + ".join(f'"{t}"' for t in alignments.READ_TYPES)
    + ' AS total, CAST(floor("left" / 3) AS BIGINT) AS third FROM s'
)
def n16_count_arithmetic(spark, d):
    less = alignments.count_arithmetic(read_counts(spark, d), _next_candidate(spark, d), "-")
    third = alignments.count_arithmetic(less, 3, "//").select(*alignments.GROUP, F.col("left").cast("long").alias("third"))
    return less.join(third, alignments.GROUP).select("candidate", "junction", "left", "spanning", "paired", "total", "third")


@query(f"""WITH {ALN}, k AS (SELECT *, {_kind("start", '"end"')} AS kind FROM best WHERE NOT is_reverse),
n AS (SELECT *, count(*) OVER (PARTITION BY candidate, junction, kind) AS n, row_number() OVER (PARTITION BY candidate, junction, kind ORDER BY (start + "end") / 2, read_id) - 1 AS nth FROM k WHERE kind IS NOT NULL AND kind NOT LIKE '%far')
SELECT candidate, junction, read_id, kind AS read_type FROM n WHERE nth % greatest(1, n // CASE kind WHEN 'spanning' THEN 4 WHEN 'left' THEN 7 WHEN 'right' THEN 7 ELSE 1 END) = 0""")
def n18_downsample_hits(spark, d):
    kind = alignments.read_type(F.col("start") + 1, F.col("end"), F.lit(300), 13, F.lit(290))
    typed = best_rows(spark, d).filter(~F.col("is_reverse")).withColumn("read_type", kind).filter("read_type IS NOT NULL")
    return alignments.downsample_hits(typed, alignments.expected_counts(F.lit(120), F.lit(300)), 20).select("candidate", "junction", "read_id", "read_type")


@query(f"""WITH {TYPED} SELECT candidate, string_agg("left" || ',' || spanning || ',' || "right", ';' ORDER BY junction) AS jc_cov FROM counts GROUP BY candidate""")
def n19_junction_vectors(spark, d):
    text = F.array_join(F.transform("jc_cov", lambda a: F.array_join(a.cast("array<string>"), ",")), ";")
    return alignments.jc_cov_vector(read_counts(spark, d)).select("candidate", text.alias("jc_cov"))


@query("SELECT user_id % 50 AS sample, event_type AS type, count(*) AS n FROM events GROUP BY ALL")
def a5_record_type_counts(spark, d):
    rows = table(spark, d, "events").select((F.col("user_id") % 50).alias("sample"), F.col("event_type").alias("type"))
    return classify.record_type_counts(rows).withColumnRenamed("count", "n")


@query(
    f"WITH {TWO_TABLES} SELECT coalesce(a.candidate, b.candidate) AS candidate, coalesce(a.junction, b.junction) AS junction FROM counts a FULL JOIN b ON a.candidate = b.candidate AND a.junction = b.junction WHERE "
    + " OR ".join(f'abs(coalesce(a."{t}", 0) - coalesce(b."{t}", 0)) > 0.5 * greatest(coalesce(a."{t}", 0), coalesce(b."{t}", 0))' for t in ("left", "right", "spanning"))
)
def a10_count_tolerance(spark, d):
    return classify.count_tolerance_check(read_counts(spark, d), _next_candidate(spark, d), ["candidate", "junction"], 0.5)


@query("""WITH s AS (SELECT source AS sample, length(text) AS n FROM documents)
SELECT sample, count(*) AS n_reads, count(*) * max(n) AS total_bases, count(*) * max(n) < 1000000 AS low_depth FROM s WHERE sample IS NOT NULL GROUP BY sample""")
def r3_r4_total_bases(spark, d):
    rows = table(spark, d, "documents").select(F.col("source").alias("sample"), F.col("text").alias("seq"))
    return reads.total_bases(reads.read_length_stats(rows), 1_000_000, reads.count_reads(rows)).select("sample", "n_reads", "total_bases", "low_depth")


@query("""SELECT ref, name AS tn_name, start, row_number() OVER (PARTITION BY ref ORDER BY scaf, start, "end", name) AS tn_id FROM (SELECT p_partkey % 7 AS ref, 'c' || p_partkey % 3 AS scaf, 'IS' || p_partkey AS name, p_partkey * 7919 % 1000 AS start, p_partkey * 7919 % 1000 + p_size AS "end" FROM part)""")
def l2_assign_tn_id(spark, d):
    k = F.col("p_partkey")
    text = lambda head, c: F.concat(F.lit(head), c.cast("string"))
    rows = table(spark, d, "part").select((k % 7).alias("ref"), text("c", k % 3).alias("scaf"), text("IS", k).alias("tn_name"), (k * 7919 % 1000).alias("start"), (k * 7919 % 1000 + F.col("p_size")).alias("end"))
    return islocate.assign_tn_id(rows).select("ref", "tn_name", "start", F.col("tn_id").cast("long"))


@query("""SELECT doc_id, coalesce(CASE WHEN lang = 'en' THEN true WHEN lang = 'de' THEN false END, count(*) OVER (PARTITION BY n_chars) = 1) AS is_circular FROM documents""")
def c13_infer_circularity(spark, d):
    topology = F.when(F.col("lang") == "en", "circular").when(F.col("lang") == "de", "linear")
    rows = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("ref"), topology.alias("topology"))
    return coords.infer_circularity(rows).select("doc_id", "is_circular")
