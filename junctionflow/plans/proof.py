"""The operators over the driver's tables, whole, each beside SQL that gives the same rows.

The tables hold no genomes, so views project them into the data model with expressions that both engines share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctionflow.functions import coords
from junctionflow.operators import alignments, classify, coverage, islocate, junctions, reads
from junctionflow.plans import cohort
from junctionflow.sources import readers
from junctionflow.streaming import status

UPPER, BASE = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGT" * 13
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_scaffold(spark: SparkSession, d: str, least: int = 200) -> DataFrame:
    seq = F.translate(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""), UPPER, BASE)
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("scaf"), F.col("source").alias("ref"), seq.alias("seq"), (F.col("doc_id") % 2 == 0).alias("is_circular"))
    return rows.withColumn("length", F.length("seq")).filter(F.col("length") >= least)


SCAFFOLD = f"""scaffold AS (SELECT *, length(seq) AS length FROM (SELECT doc_id, 'd' || doc_id AS scaf, source AS ref,
  translate(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'), '{UPPER}', '{BASE}') AS seq, doc_id % 2 = 0 AS is_circular FROM documents) WHERE length(seq) >= 200)"""
EVERY_SCAFFOLD = SCAFFOLD.removesuffix(" WHERE length(seq) >= 200)") + ")"


def v_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").withColumns({"sample": F.col("l_suppkey") % 5, "scaf": F.concat(F.lit("s"), F.col("l_suppkey"))})


def v_cov(spark: SparkSession, d: str) -> DataFrame:
    """Each order's lines laid along a scaffold of its customer: sample, scaf, pos, iso, anc."""
    pos = F.expr("row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_shipdate)").cast("long")
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice", "l_partkey", "l_shipdate").withColumn("pos", pos)
    return lines.select((F.col("l_suppkey") % 5).alias("sample"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("scaf"), "pos", (F.col("l_quantity").cast("int") % 50).alias("iso"), F.round(F.col("l_discount") * 100).cast("int").alias("anc"))


COV = """cov AS (SELECT l_suppkey % 5 AS sample, 's' || l_suppkey AS scaf,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_shipdate) AS pos,
  CAST(l_quantity AS INT) % 50 AS iso, CAST(round(l_discount * 100) AS INT) AS anc FROM lineitem)"""


def v_candidate_of_every_order(spark: SparkSession, d: str) -> DataFrame:
    """Segments on the suppliers' scaffolds, one for each order, whose customer number deals it out; some wrap."""
    sizes = v_lines(spark, d).groupBy("sample", "scaf").agg(F.count("*").alias("length"))  # the last position of v_cov
    places = sizes.selectExpr("*", "row_number() OVER (ORDER BY scaf, sample) - 1 AS k", "count(*) OVER () AS n")  # a row for each scaffold
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("cand_id"), "o_custkey").join(F.broadcast(places.agg(F.max("n").alias("n"))))
    start = (F.col("cand_id") * 7919) % F.col("length") + 1
    rows = orders.withColumn("k", F.pmod(F.coalesce("o_custkey", F.lit(0)), F.col("n"))).join(places.drop("n"), "k")
    return rows.select("sample", "scaf", "cand_id", start.alias("start"), ((start - 1 + (F.col("cand_id") * 13) % F.col("length")) % F.col("length") + 1).alias("end"), "length")


EVERY_CANDIDATE = """sizes AS (SELECT sample, scaf, max(pos) AS length FROM cov GROUP BY sample, scaf),
places AS (SELECT *, row_number() OVER (ORDER BY scaf, sample) - 1 AS k, count(*) OVER () AS n FROM sizes),
candidate AS (SELECT sample, scaf, o_orderkey AS cand_id, (o_orderkey * 7919) % length + 1 AS start, ((o_orderkey * 7919) % length + (o_orderkey * 13) % length) % length + 1 AS "end", length
  FROM orders JOIN places ON coalesce(o_custkey, 0) % n = k)"""


@query(f"""WITH {SCAFFOLD}
SELECT scaf, s, e, CASE WHEN is_circular OR s <= e THEN s > e END AS span_origin, CASE WHEN s <= e THEN e - s + 1 WHEN is_circular THEN e - s + length + 1 ELSE -1 END AS seg_len
FROM (SELECT *, CASE WHEN is_circular THEN (doc_id * 37 + 150) % length + 1 ELSE doc_id * 37 % 150 + 1 END AS s, CASE WHEN is_circular THEN (doc_id * 91 + 40) % length + 1 ELSE doc_id * 91 % 150 + 1 END AS e FROM scaffold)""")
def c1_c2_circ_segments(spark, d):
    s = F.when(F.col("is_circular"), F.col("doc_id") * 37 + 151).otherwise(F.col("doc_id") * 37 % 150 + 1)
    e = F.when(F.col("is_circular"), F.col("doc_id") * 91 + 41).otherwise(F.col("doc_id") * 91 % 150 + 1)
    rows = v_scaffold(spark, d).withColumn("n", coords.circ_normalize(s, e, F.lit(1), F.col("length"), F.col("is_circular"))).select("scaf", "n.*", "length", "is_circular")
    return rows.select("scaf", F.col("start").alias("s"), F.col("end").alias("e"), "span_origin", coords.segment_length(F.col("start"), F.col("end"), F.lit(1), F.col("length"), F.col("is_circular")).cast("long").alias("seg_len"))


@query(f"""WITH {SCAFFOLD} SELECT scaf, substr(seq, 3, 58) AS forward, reverse(translate(substr(seq, 3, 58), 'ACGT', 'TGCA')) AS backward,
  CASE WHEN is_circular THEN substr(seq, length - 9, 10) || substr(seq, 1, 20) ELSE '' END AS wrapped FROM scaffold""")
def c3_c4_slices(spark, d):
    c = lambda a, b, o: coords.slice_seq(F.col("seq"), a, b, F.lit(o), F.col("is_circular"))
    return v_scaffold(spark, d).select("scaf", c(F.lit(3), F.lit(60), 1).alias("forward"), c(F.lit(60), F.lit(3), -1).alias("backward"), c(F.col("length") - 9, F.lit(20), 1).alias("wrapped"))


@query(f"""WITH {SCAFFOLD} SELECT scaf, reverse(translate(substr(seq, 51, 30), 'ACGT', 'TGCA')) || substr(seq, 101, 40) AS seq12,
  reverse(translate(substr(seq, 101, 40), 'ACGT', 'TGCA')) || substr(seq, 51, 30) AS seq21 FROM scaffold""")
def c10_junction_sequences(spark, d):
    a, b = coords.arm(F.col("scaf"), F.lit(51), F.lit(1), F.lit(30)), coords.arm(F.col("scaf"), F.lit(101), F.lit(1), F.lit(40))
    seq, circ = F.col("seq"), F.col("is_circular")
    return v_scaffold(spark, d).select("scaf", coords.junction_seq_1to2(seq, a, circ, seq, b, circ).alias("seq12"), coords.junction_seq_2to1(seq, a, circ, seq, b, circ).alias("seq21"))


@query(f"""WITH {EVERY_SCAFFOLD} SELECT ref, scaf, CAST(coalesce(sum(length) OVER (PARTITION BY ref ORDER BY scaf ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS range_start,
  CAST(sum(length) OVER (PARTITION BY ref ORDER BY scaf) AS BIGINT) AS range_end FROM scaffold""")
def c11_scaffold_ranges(spark, d):
    return coords.scaffold_ranges(v_scaffold(spark, d, 0).select("ref", "scaf", "length")).select("ref", "scaf", F.col("range_start").cast("long"), F.col("range_end").cast("long"))


@query(f"WITH {EVERY_SCAFFOLD} SELECT ref, CAST(sum(length) AS BIGINT) AS genome_length FROM scaffold GROUP BY ref")
def c12_genome_length(spark, d):
    return coords.genome_length(v_scaffold(spark, d, 0))


@query("""WITH h AS (SELECT l_orderkey AS query, 't' || l_partkey AS subject, l_linenumber * 100 + l_partkey % 130 AS qstart, l_linenumber * 100 + l_partkey % 130 + 40 + l_suppkey % 60 AS qend,
  l_suppkey % 7 * 10 + 5 AS sstart, l_suppkey % 7 * 10 + 5 + (CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE -1 END) * (35 + l_suppkey % 60) AS send, l_partkey % 100 AS bitscore,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS hit_id FROM lineitem),
dd AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY query, qstart, qend ORDER BY hit_id) = 1),
s AS (SELECT dd.*, CASE WHEN p_partkey IS NULL THEN 0 ELSE 60 + p_size % 40 END AS subject_length FROM dd LEFT JOIN part ON subject = 't' || p_partkey),
n AS (SELECT *, CASE WHEN qstart - lag(qend) OVER o > 0 OR lag(qend) OVER o IS NULL THEN 1 ELSE 0 END AS new FROM s WINDOW o AS (PARTITION BY query ORDER BY qstart, bitscore, hit_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY query ORDER BY qstart, bitscore, hit_id ROWS UNBOUNDED PRECEDING) AS hit_group FROM n),
b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY query, hit_group ORDER BY abs((qend - qstart) - subject_length), qstart, bitscore, hit_id) = 1)
SELECT query, subject, CAST(qstart AS BIGINT) AS qstart, CAST(hit_group AS BIGINT) AS hit_group, CASE WHEN sstart > send THEN -1 ELSE 1 END AS orientation FROM b WHERE subject_length > 0 AND abs(sstart - send) / subject_length > 0.9""")
def l3_l8_elements_from_hits(spark, d):
    i = F.expr("row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)")
    q = F.col("l_linenumber") * 100 + F.col("l_partkey") % 130
    s = F.col("l_suppkey") % 7 * 10 + 5
    hits = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("query"), F.concat(F.lit("t"), "l_partkey").alias("subject"), q.alias("qstart"), (q + 40 + F.col("l_suppkey") % 60).alias("qend"), s.alias("sstart"), (s + F.when(F.col("l_partkey") % 2 == 0, 1).otherwise(-1) * (35 + F.col("l_suppkey") % 60)).alias("send"), (F.col("l_partkey") % 100).alias("bitscore"), i.alias("hit_id"))
    subjects = table(spark, d, "part").select(F.concat(F.lit("t"), "p_partkey").alias("subject"), (60 + F.col("p_size") % 40).alias("length"))
    return islocate.elements_from_hits(hits, subjects).select("query", "subject", F.col("qstart").cast("long"), F.col("hit_group").cast("long"), "orientation")


def _elements(spark, d, shift: int) -> DataFrame:
    k = F.col("p_partkey")
    start = (k * 7919) % 50_000_000 + (k * shift) % 83
    return table(spark, d, "part").filter(f"{shift} = 0 OR p_size <> 7").select(k.cast("long").alias("tn_id"), F.concat(F.lit("IS"), (k * (1 + shift) % 9).cast("string")).alias("tn_name"), (F.lit("c")).alias("scaf"), start.cast("long").alias("start"), (start + 700 + k % 500 + (k * shift) % 29).cast("long").alias("end"))


@query("""WITH a AS (SELECT CAST(p_partkey AS BIGINT) AS id, 'IS' || (p_partkey % 9) AS name, (p_partkey * 7919) % 50000000 AS s, (p_partkey * 7919) % 50000000 + 700 + p_partkey % 500 AS e FROM part),
b AS (SELECT CAST(p_partkey AS BIGINT) AS id, 'IS' || (p_partkey * 4 % 9) AS name, (p_partkey * 7919) % 50000000 + p_partkey * 3 % 83 AS s, (p_partkey * 7919) % 50000000 + p_partkey * 3 % 83 + 700 + p_partkey % 500 + p_partkey * 3 % 29 AS e FROM part WHERE p_size <> 7),
p AS (SELECT a.id AS x, b.id AS y, a.name = b.name AS same, b.s - a.s AS ds, b.e - a.e AS de, count(*) OVER (PARTITION BY a.id) AS n FROM a JOIN b ON b.s BETWEEN a.s - 50 AND a.s + 50 AND b.e BETWEEN a.e - 50 AND a.e + 50),
best AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY x ORDER BY same DESC, y) = 1)
SELECT kind, 'c' AS scaf, tn_id, other_id, CAST(ds AS BIGINT) AS start_delta, CAST(de AS BIGINT) AS end_delta FROM (
SELECT 'not found' AS kind, id AS tn_id, NULL AS other_id, NULL AS ds, NULL AS de FROM a WHERE id NOT IN (SELECT x FROM p)
UNION ALL SELECT 'not found in first', NULL, id, NULL, NULL FROM b WHERE id NOT IN (SELECT y FROM p)
UNION ALL SELECT 'multiple', x, y, ds, de FROM best WHERE n > 1 UNION ALL SELECT 'name', x, y, ds, de FROM best WHERE NOT same UNION ALL SELECT 'ends', x, y, ds, de FROM best WHERE ds <> 0 OR de <> 0)""")
def l10_compare_locations(spark, d):
    return islocate.compare_locations(_elements(spark, d, 0), _elements(spark, d, 3))


@query("""WITH m AS (SELECT p_partkey AS k, 'r' || p_size % 3 AS ref, unnest([{'m': 'genbank', 'x': 0}, {'m': 'isfinder', 'x': 3}, {'m': 'isescan', 'x': 5}]) AS v, p_size FROM part),
f AS (SELECT CAST(k AS BIGINT) AS id, ref, v.m AS method, 'IS' || (k * (1 + v.x) % 9) AS name, (k * 7919) % 50000000 + k * v.x % 83 AS s, (k * 7919) % 50000000 + k * v.x % 83 + 700 + k % 500 + k * v.x % 29 AS e FROM m WHERE v.x = 0 OR p_size <> 7),
a AS (SELECT id, ref, name, s, e, unnest(['isescan', 'isfinder']) AS method FROM f WHERE method = 'genbank'), b AS (SELECT * FROM f WHERE method <> 'genbank'),
p AS (SELECT a.ref, a.method, a.id AS x, b.id AS y, a.name = b.name AS same, b.s - a.s AS ds, b.e - a.e AS de, count(*) OVER (PARTITION BY a.ref, a.method, a.id) AS n
  FROM a JOIN b ON a.ref = b.ref AND a.method = b.method AND b.s BETWEEN a.s - 50 AND a.s + 50 AND b.e BETWEEN a.e - 50 AND a.e + 50),
best AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY ref, method, x ORDER BY same DESC, y) = 1)
SELECT ref, method, kind, 'c' AS scaf, tn_id, other_id, CAST(ds AS BIGINT) AS start_delta, CAST(de AS BIGINT) AS end_delta FROM (
SELECT ref, method, 'not found' AS kind, id AS tn_id, NULL AS other_id, NULL AS ds, NULL AS de FROM a WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.ref = a.ref AND p.method = a.method AND x = id)
UNION ALL SELECT ref, method, 'not found in first', NULL, id, NULL, NULL FROM b WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.ref = b.ref AND p.method = b.method AND y = id)
UNION ALL SELECT ref, method, 'multiple', x, y, ds, de FROM best WHERE n > 1 UNION ALL SELECT ref, method, 'name', x, y, ds, de FROM best WHERE NOT same UNION ALL SELECT ref, method, 'ends', x, y, ds, de FROM best WHERE ds <> 0 OR de <> 0)""")
def l11_compare_methods(spark, d):
    sizes = table(spark, d, "part").select(F.col("p_partkey").cast("long").alias("tn_id"), F.concat(F.lit("r"), F.col("p_size") % 3).alias("ref"))
    found = None
    for method, shift in (("genbank", 0), ("isfinder", 3), ("isescan", 5)):
        rows = _elements(spark, d, shift).withColumn("method", F.lit(method))
        found = rows if found is None else found.unionByName(rows)
    return islocate.select_method_result(found.join(sizes, "tn_id"), "genbank", ["isfinder", "isescan"])[1]


@query("""SELECT CAST(tn AS BIGINT) AS tn_id, CAST(-2 * tn - (CASE WHEN side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS num, side, CASE WHEN side = 1 THEN e ELSE s END AS pos1, -side AS dir1,
  CASE WHEN side = 1 THEN e + 1 ELSE s - 1 END AS pos2, side AS dir2, CAST(e - s + 1 AS INT) AS flanking1
FROM (SELECT p_partkey AS tn, (p_partkey * 7919) % 50000000 AS s, (p_partkey * 7919) % 50000000 + 700 + p_partkey % 500 AS e, unnest([-1, 1]) AS side FROM part)""")
def j1_reference_junctions(spark, d):
    return junctions.reference_junctions(_elements(spark, d, 0)).select(F.col("ref_tn_side.tn_id").alias("tn_id"), "num", F.col("ref_tn_side.side").alias("side"), "pos1", "dir1", "pos2", "dir2", "flanking1")


def v_tnjc(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    first = F.struct((1 + c % 4).cast("long").alias("tn_id"), F.when(F.floor(k / 2) % 2 == 0, -1).otherwise(1).alias("side"))
    second = F.struct((1 + (c + 1) % 4).cast("long").alias("tn_id"), F.when(F.floor(k / 2) % 2 == 0, -1).otherwise(1).alias("side"))
    sides = F.when(k % 5 == 0, F.array(first, second)).otherwise(F.array(first))
    return table(spark, d, "orders").select(c.alias("sample"), k.alias("num"), F.lit("c").alias("scaf2"), ((k * 7919) % 20000 + 1).alias("pos2"), F.when(k % 2 == 0, 1).otherwise(-1).alias("dir2"), F.when(k % 11 == 0, (1 + c % 4).cast("long")).alias("own_tn"), F.transform(sides, lambda x: x.withField("offset", k % 7 - 3)).alias("sides"))


def v_pairs(spark: SparkSession, d: str) -> DataFrame:
    return junctions.pair_junctions(v_tnjc(spark, d)).withColumn("base_event", junctions.base_event(1000))


PAIRS = """t AS (SELECT o_custkey AS sample, o_orderkey AS num, (o_orderkey * 7919) % 20000 + 1 AS pos2, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END AS dir2,
  CASE WHEN o_orderkey % 11 = 0 THEN 1 + o_custkey % 4 END AS own, CASE WHEN o_orderkey // 2 % 2 = 0 THEN -1 ELSE 1 END AS side,
  CASE WHEN o_orderkey % 5 = 0 THEN [1 + o_custkey % 4, 1 + (o_custkey + 1) % 4] ELSE [1 + o_custkey % 4] END AS tns,
  row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderkey * 7919) % 20000 + 1, o_orderkey) AS k FROM orders),
j AS (SELECT a.sample, a.k AS ka, b.k AS kb, CASE WHEN a.dir2 = 1 THEN a.num ELSE b.num END AS left_num, CASE WHEN a.dir2 = 1 THEN b.num ELSE a.num END AS right_num,
  CASE WHEN a.dir2 = 1 THEN a.pos2 ELSE b.pos2 END AS "left", CASE WHEN a.dir2 = 1 THEN b.pos2 ELSE a.pos2 END AS "right", CASE WHEN a.dir2 = 1 THEN a.own ELSE b.own END AS left_own,
  CASE WHEN a.dir2 = 1 THEN b.own ELSE a.own END AS right_own, list_sort(list_intersect(a.tns, b.tns)) AS tn_ids, a.own AS oa, b.own AS ob
  FROM t a JOIN t b ON a.sample = b.sample AND a.k < b.k AND a.dir2 = -b.dir2 AND a.side = -b.side),
pairs AS (SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY ka, kb) AS pair_id, left_num, right_num, "left", "right", left_own, right_own, tn_ids,
  CASE WHEN left_own = right_own THEN 'reference-tn' WHEN abs("right" - "left") < 1000 AND left_own IS NULL AND right_own IS NULL THEN 'transposition' ELSE 'locus-joining' END AS base_event
  FROM j WHERE len(tn_ids) > 0 AND (oa IS NULL OR list_contains(tn_ids, oa)) AND (ob IS NULL OR list_contains(tn_ids, ob)))"""


@query(f"""WITH {PAIRS} SELECT sample, pair_id, left_num, right_num, "left", "right", base_event, array_to_string(tn_ids, ',') AS tns, CAST(coalesce(left_own, right_own, tn_ids[1]) AS BIGINT) AS chosen,
  CASE WHEN "left" <= "right" THEN "right" - "left" + 1 ELSE "right" - "left" + 20001 END AS length FROM pairs""")
def j9_j12_pair_junctions(spark, d):
    return v_pairs(spark, d).select("sample", F.col("pair_id").cast("long"), "left_num", "right_num", "left", "right", "base_event", F.array_join(F.col("tn_ids").cast("array<string>"), ",").alias("tns"), junctions.chosen_tn().alias("chosen"), junctions.amplicon_length(F.col("left"), F.col("right"), F.lit(20000)).alias("length"))


@query(f"""WITH {PAIRS}, held AS (SELECT DISTINCT sample, pair_id AS other, unnest([left_num, right_num]) AS num FROM pairs WHERE base_event <> 'locus-joining'),
l AS (SELECT p.sample, p.pair_id, count(*) AS n, min(other) AS o FROM pairs p JOIN held h ON p.sample = h.sample AND p.left_num = h.num AND other <> pair_id GROUP BY ALL),
r AS (SELECT p.sample, p.pair_id, count(*) AS n, min(other) AS o FROM pairs p JOIN held h ON p.sample = h.sample AND p.right_num = h.num AND other <> pair_id GROUP BY ALL)
SELECT p.sample, p.pair_id, CAST(coalesce(l.n, 0) AS INT) AS n_left, CAST(coalesce(r.n, 0) AS INT) AS n_right, l.o AS first_left, CASE WHEN base_event <> 'locus-joining' THEN base_event
  WHEN l.n > 0 AND r.n > 0 THEN 'flanked' WHEN l.n > 0 THEN 'hemi-flanked left' WHEN r.n > 0 THEN 'hemi-flanked right' ELSE 'unflanked' END AS architecture
FROM pairs p LEFT JOIN l USING (sample, pair_id) LEFT JOIN r USING (sample, pair_id)""")
def j13_j15_link_single_locus(spark, d):
    linked = junctions.link_single_locus(v_pairs(spark, d))
    return linked.select("sample", F.col("pair_id").cast("long"), F.size("left_links").alias("n_left"), F.size("right_links").alias("n_right"), F.get("left_links", 0).cast("long").alias("first_left"), junctions.raw_architecture().alias("architecture"))


def v_chosen(spark: SparkSession, d: str) -> DataFrame:
    """Linked pairs with their chosen element, those that have one."""
    return junctions.link_single_locus(v_pairs(spark, d)).withColumn("chosen_tn", junctions.chosen_tn(linked=True)).filter("chosen_tn IS NOT NULL")


def _first_link(side: str) -> str:
    return f"""SELECT p.sample, p.pair_id, h.other, h.tns, h."left", h."right", h.event FROM pairs p JOIN held h ON p.sample = h.sample AND p.{side}_num = h.num AND h.other <> p.pair_id
  QUALIFY row_number() OVER (PARTITION BY p.sample, p.pair_id ORDER BY h.other) = 1"""


CHOSEN = f"""{PAIRS}, held AS (SELECT DISTINCT sample, pair_id AS other, tn_ids AS tns, "left", "right", base_event AS event, unnest([left_num, right_num]) AS num FROM pairs WHERE base_event <> 'locus-joining'),
l AS ({_first_link("left")}), r AS ({_first_link("right")}),
chosen AS (SELECT * FROM (SELECT p.*, CAST(coalesce(left_own, right_own, list_sort(list_intersect(list_intersect(tn_ids, coalesce(l.tns, tn_ids)), coalesce(r.tns, tn_ids)))[1]) AS BIGINT) AS tn,
  CASE WHEN left_num // 2 % 2 = 0 THEN -1 ELSE 1 END AS side_l, left_num % 7 - 3 AS off_l, CASE WHEN right_num // 2 % 2 = 0 THEN -1 ELSE 1 END AS side_r, right_num % 7 - 3 AS off_r,
  l."right" AS link_l, r."left" AS link_r, l.event AS event_l, r.event AS event_r
  FROM pairs p LEFT JOIN l ON p.sample = l.sample AND p.pair_id = l.pair_id LEFT JOIN r ON p.sample = r.sample AND p.pair_id = r.pair_id) WHERE tn IS NOT NULL)"""


@query(f"WITH {CHOSEN} SELECT sample, pair_id, tn AS chosen, side_l AS left_side, off_l AS left_offset, side_r AS right_side, off_r AS right_offset FROM chosen")
def j10_j17_chosen_sides(spark, d):
    s = F.col("s")
    rows = v_chosen(spark, d).withColumn("s", junctions.chosen_tn_sides())
    return rows.select("sample", F.col("pair_id").cast("long"), F.col("chosen_tn").alias("chosen"), s["left"]["side"].alias("left_side"), s["left"]["offset"].alias("left_offset"), s["right"]["side"].alias("right_side"), s["right"]["offset"].alias("right_offset"))


@query(f"""WITH {CHOSEN}, e AS (SELECT p_partkey AS tn, (p_partkey * 7919) % 50000000 AS s, (p_partkey * 7919) % 50000000 + 700 + p_partkey % 500 AS e FROM part),
a AS (SELECT c.*, CASE WHEN side_l = -1 THEN s + off_l ELSE e - off_l END AS tr, CASE WHEN side_r = -1 THEN s + off_r ELSE e - off_r END AS tl,
  coalesce(link_l, "left" - 1) AS cl_tn, CASE WHEN event_l = 'reference-tn' THEN link_l ELSE "left" - 1 END AS cl, coalesce(link_r, "right" + 1) AS cr_tn, CASE WHEN event_r = 'reference-tn' THEN link_r ELSE "right" + 1 END AS cr
  FROM chosen c JOIN e USING (tn)),
n AS (SELECT *, 'jc_c_' || "left" || '-' || "right" || '_c_' || CASE WHEN side_l = -1 THEN tr || '-' || tl ELSE tl || '-' || tr END ||
  printf('_L%+d', CAST("left" - 1 - cl AS BIGINT)) || printf('L%+d', CAST("left" - 1 - cl_tn AS BIGINT)) || printf('_R%+d', CAST(cr - "right" - 1 AS BIGINT)) || printf('R%+d', CAST(cr_tn - "right" - 1 AS BIGINT)) ||
  CASE WHEN side_l = -1 THEN 'S' ELSE 'E' END || '_30bp' AS candidate FROM a),
k AS (SELECT n.*, j FROM n CROSS JOIN range(1, 8) AS x(j))
SELECT sample, pair_id, candidate, true AS consistent, CAST(j AS INT) AS junction,
  CAST(CASE j WHEN 1 THEN cl WHEN 2 THEN cl_tn WHEN 3 THEN "right" WHEN 4 THEN "right" WHEN 5 THEN tr WHEN 6 THEN tr ELSE "right" END AS BIGINT) AS pos1,
  CAST(CASE j WHEN 5 THEN -side_l WHEN 6 THEN -side_l ELSE -1 END AS INT) AS dir1,
  CAST(CASE j WHEN 1 THEN "left" WHEN 2 THEN tl WHEN 3 THEN tl WHEN 4 THEN "left" WHEN 5 THEN "left" WHEN 6 THEN cr_tn ELSE cr END AS BIGINT) AS pos2,
  CAST(CASE j WHEN 2 THEN -side_r WHEN 3 THEN -side_r ELSE 1 END AS INT) AS dir2,
  CAST(CASE j WHEN 1 THEN cl WHEN 2 THEN cl_tn WHEN 3 THEN "right" WHEN 4 THEN NULL WHEN 5 THEN "left" WHEN 6 THEN cr_tn ELSE cr END AS BIGINT) AS chr_pos FROM k""")
def y1_y5_synthetic_junctions(spark, d):
    rows = reads.seven_junctions(reads.synthetic_arms(reads.flank_arms(v_chosen(spark, d), 30), _elements(spark, d, 0), 30))
    return rows.select("sample", F.col("pair_id").cast("long"), "candidate", "consistent", "junction", F.col("arm1.start").alias("pos1"), F.col("arm1.dir").alias("dir1"), F.col("arm2.start").alias("pos2"), F.col("arm2.dir").alias("dir2"), "chr_pos")


@query(f"WITH {COV} SELECT sample, scaf, CAST(median(iso) AS DOUBLE) AS average FROM cov GROUP BY sample, scaf")
def v2_scaffold_median(spark, d):
    return coverage.scaffold_average(v_cov(spark, d), "iso")


@query(f"WITH {COV} SELECT sample, scaf, round(avg(iso), 6) AS average FROM cov GROUP BY sample, scaf")
def v2_scaffold_mean(spark, d):
    return coverage.scaffold_average(v_cov(spark, d), "iso", "mean").withColumn("average", F.round("average", 6))


@query(f"""WITH {COV}, logs AS (SELECT sample, scaf, ln(iso) AS y FROM cov WHERE iso > 0),
stats AS (SELECT sample, scaf, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3, min(y) AS low, max(y) AS high, count(*) AS total FROM logs GROUP BY ALL),
bins AS (SELECT *, greatest(10, CASE WHEN q3 > q1 THEN floor((high - low) / (2 * (q3 - q1) / pow(total, 1.0 / 3))) ELSE least(50, floor(sqrt(total))) END) - 1 AS n FROM stats),
placed AS (SELECT sample, scaf, low, (high - low) / n AS step, CASE WHEN high > low THEN least(floor((y - low) / ((high - low) / n)), n - 1) ELSE 0 END AS bin FROM logs JOIN bins USING (sample, scaf)),
counts AS (SELECT sample, scaf, low, step, bin, count(*) AS n FROM placed GROUP BY sample, scaf, low, step, bin),
fullest AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY sample, scaf ORDER BY n DESC, bin) = 1)
SELECT sample, scaf, round(exp(low + (bin + 0.5) * step), 6) AS average FROM fullest""")
def v8_scaffold_mode(spark, d):
    return coverage.scaffold_average(v_cov(spark, d), "iso", "mode").withColumn("average", F.round("average", 6))


def copy_number_rows(spark: SparkSession, d: str, cands: DataFrame | None = None, method: str = "median") -> DataFrame:
    cands = v_candidate_of_every_order(spark, d).filter("scaf IS NOT NULL") if cands is None else cands
    return coverage.copy_numbers(coverage.segment_averages(cands, v_cov(spark, d), method, block=64))


AVERAGES = f"""WITH {COV}, {EVERY_CANDIDATE}, scafs AS (SELECT sample, scaf, median(iso) AS si, median(anc) AS sa FROM cov GROUP BY sample, scaf),
rows AS (SELECT c.sample, cand_id, iso, anc, si, sa FROM candidate c JOIN cov v ON c.scaf = v.scaf AND c.sample = v.sample AND (CASE WHEN start <= "end" THEN pos BETWEEN start AND "end" ELSE pos >= start OR pos <= "end" END)
  JOIN scafs s ON s.scaf = c.scaf AND s.sample = c.sample WHERE anc > 0),
found AS (SELECT sample, cand_id, median(iso) AS ai, median(anc) AS aa, median((iso / anc) / (si / sa)) AS cn FROM rows GROUP BY ALL),
averages AS (SELECT c.sample, c.cand_id, si, sa, ai, aa, cn FROM candidate c JOIN scafs s ON s.scaf = c.scaf AND s.sample = c.sample LEFT JOIN found f ON f.sample = c.sample AND f.cand_id = c.cand_id)"""


@query(f"{AVERAGES} SELECT sample, cand_id, round(ai, 6) AS iso_amplicon_avg, round(aa, 6) AS anc_amplicon_avg, round(ai / si, 6) AS iso_norm, round(cn, 6) AS copy_number FROM averages")
def v4_v9_copy_number(spark, d):
    return copy_number_rows(spark, d).select("sample", "cand_id", *[F.round(c, 6).alias(c) for c in ("iso_amplicon_avg", "anc_amplicon_avg", "iso_norm", "copy_number")])


@query(f"{AVERAGES} SELECT sample, cand_id, round(cn, 6) AS copy_number FROM averages WHERE cand_id % 7 <> 0 AND (cn IS NULL OR NOT (round(cn, 6) >= 0.3 AND round(cn, 6) < 1.5))")
def v10_filter_copy_number(spark, d):
    rows = copy_number_rows(spark, d).withColumn("copy_number", F.round("copy_number", 6)).withColumn("chosen_tn", F.when(F.col("cand_id") % 7 != 0, 1))
    return coverage.filter_copy_number(rows).select("sample", "cand_id", "copy_number")


POSITIONS = f"""WITH {COV}, {EVERY_CANDIDATE}, scafs AS (SELECT sample, scaf, avg(iso) AS si, avg(anc) AS sa FROM cov GROUP BY sample, scaf),
rows AS (SELECT c.sample, cand_id, iso, anc, si, sa FROM candidate c JOIN cov v ON c.scaf = v.scaf AND c.sample = v.sample AND (CASE WHEN start <= "end" THEN pos BETWEEN start AND "end" ELSE pos >= start OR pos <= "end" END)
  JOIN scafs s ON s.scaf = c.scaf AND s.sample = c.sample WHERE anc > 0)"""


@query(f"""{POSITIONS}, found AS (SELECT sample, cand_id, avg(iso) AS ai, avg(anc) AS aa, avg((iso / anc) / (si / sa)) AS cn FROM rows GROUP BY ALL)
SELECT c.sample, c.cand_id, round(ai, 6) AS iso_amplicon_avg, round(aa, 6) AS anc_amplicon_avg, round(cn, 6) AS copy_number
FROM candidate c LEFT JOIN found f ON f.sample = c.sample AND f.cand_id = c.cand_id""")
def v6_v7_mean(spark, d):
    rows = copy_number_rows(spark, d, v_candidate_of_every_order(spark, d), "mean")
    return rows.select("sample", "cand_id", *[F.round(c, 6).alias(c) for c in ("iso_amplicon_avg", "anc_amplicon_avg")], F.round("avg_norm_cov", 6).alias("copy_number"))


@query(f"""{POSITIONS}, logs AS (SELECT sample, cand_id, 'i' AS v, ln(iso) AS y FROM rows WHERE iso > 0 UNION ALL SELECT sample, cand_id, 'a', ln(anc) FROM rows
  UNION ALL SELECT sample, cand_id, 'r', ln((iso / anc) / (si / sa)) FROM rows WHERE iso > 0),
stats AS (SELECT sample, cand_id, v, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3, min(y) AS low, max(y) AS high, count(*) AS total FROM logs GROUP BY ALL),
bins AS (SELECT *, greatest(10, CASE WHEN q3 > q1 THEN floor((high - low) / (2 * (q3 - q1) / pow(total, 1.0 / 3))) ELSE least(50, floor(sqrt(total))) END) - 1 AS n FROM stats),
placed AS (SELECT sample, cand_id, v, low, (high - low) / n AS step, CASE WHEN high > low THEN least(floor(round((y - low) / ((high - low) / n), 9)), n - 1) ELSE 0 END AS bin FROM logs JOIN bins USING (sample, cand_id, v)),
counts AS (SELECT sample, cand_id, v, low, step, bin, count(*) AS n FROM placed GROUP BY ALL),
fullest AS (SELECT *, round(exp(low + (bin + 0.5) * step), 6) AS mode FROM counts QUALIFY row_number() OVER (PARTITION BY sample, cand_id, v ORDER BY n DESC, bin) = 1)
SELECT c.sample, c.cand_id, max(mode) FILTER (v = 'i') AS iso_amplicon_avg, max(mode) FILTER (v = 'a') AS anc_amplicon_avg, max(mode) FILTER (v = 'r') AS copy_number
FROM candidate c LEFT JOIN fullest f ON f.sample = c.sample AND f.cand_id = c.cand_id GROUP BY c.sample, c.cand_id""")
def v6_v7_mode(spark, d):
    rows = coverage.segment_averages(v_candidate_of_every_order(spark, d), v_cov(spark, d), "mode", "mean", block=64)  # modes of segments over means of scaffolds
    return rows.select("sample", "cand_id", *[F.round(c, 6).alias(c) for c in ("iso_amplicon_avg", "anc_amplicon_avg")], F.round("avg_norm_cov", 6).alias("copy_number"))


@query(f"""WITH {COV}, {EVERY_CANDIDATE}, scafs AS (SELECT sample, scaf, median(iso) AS si, median(anc) AS sa FROM cov GROUP BY sample, scaf),
w AS (SELECT *, CASE WHEN start > "end" THEN "end" + length ELSE "end" END - start AS span FROM candidate),
x AS (SELECT *, start - floor(span * 0.2) AS first, start + span + floor(span * 0.2) AS last FROM w),
rows AS (SELECT x.sample, cand_id, iso, anc, si, sa FROM x JOIN cov v ON x.scaf = v.scaf AND x.sample = v.sample AND (last - first + 1 >= length OR ((pos - first) % length + length) % length <= last - first)
  JOIN scafs s ON s.scaf = x.scaf AND s.sample = x.sample),
e AS (SELECT sample, cand_id, quantile_cont(iso, 0.01) / si AS i1, quantile_cont(iso, 0.99) / si AS i99, quantile_cont(anc, 0.01) / sa AS a1, quantile_cont(anc, 0.99) / sa AS a99 FROM rows GROUP BY sample, cand_id, si, sa)
SELECT sample, cand_id, round(greatest(least(i1, a1) / 1.1, 0.1), 6) AS low, round(greatest(i99, a99) * 1.1, 6) AS high FROM e""")
def v11_profile_limits(spark, d):
    limits = coverage.profile_limits(v_candidate_of_every_order(spark, d), v_cov(spark, d), None, block=64)
    return limits.select("sample", "cand_id", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query()
def v11_coverage_profile(spark, d):
    cands = v_candidate_of_every_order(spark, d)
    # every third candidate has a reference element before its left end, around the origin where it must
    ends = [F.pmod(F.col("start") - by - 1, F.col("length")) + 1 for by in (40 + F.col("cand_id") % 60, F.lit(1))]
    cands = cands.withColumn("left_tn", F.when(F.col("cand_id") % 3 == 0, F.struct(ends[0].alias("start"), ends[1].alias("end"))))
    return coverage.coverage_profile(cands, v_cov(spark, d), None)


@query("""SELECT source AS sample, count(*) AS n_reads, CAST(min(length(text)) AS INT) AS min_len, CAST(max(length(text)) AS INT) AS max_len, round(avg(length(text)), 6) AS mean_len,
  min(length(text)) > 0 AND max(length(text)) / min(length(text)) < 1.05 AS uniform FROM documents GROUP BY source""")
def r1_r2_read_length_stats(spark, d):
    return reads.read_length_stats(table(spark, d, "documents").select(F.col("source").alias("sample"), F.col("text").alias("seq"))).withColumn("mean_len", F.round("mean_len", 6))


@query("""SELECT o_orderkey AS run, CAST(CASE WHEN abs(i - a) <= a // 10 THEN 2 * a ELSE 2 * i END AS BIGINT) AS iso_arm, CAST(2 * a AS BIGINT) AS anc_arm, CAST(floor(i / 1.1) AS INT) AS min_query FROM (SELECT o_orderkey, 100 + o_orderkey % 90 AS i, 100 + o_custkey % 90 AS a FROM orders)""")
def r5_r6_arm_lengths(spark, d):
    i, a = 100 + F.col("o_orderkey") % 90, 100 + F.col("o_custkey") % 90
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("run"), reads.arm_lengths(i, a).alias("x"), reads.min_query_length(i).alias("min_query")).select("run", F.col("x.iso_arm").cast("long").alias("iso_arm"), F.col("x.anc_arm").cast("long").alias("anc_arm"), "min_query")


@query(f"""WITH {SCAFFOLD}, arms AS (SELECT scaf, unnest([1, 2, 3, 4, 5, 6, 7]) AS junction, seq FROM scaffold),
parts AS (SELECT *, reverse(translate(substr(seq, 81, 20), 'ACGT', 'TGCA')) AS chr_left, substr(seq, 101, 20) AS amp_left, reverse(translate(substr(seq, 131, 20), 'ACGT', 'TGCA')) AS amp_right,
  substr(seq, 151, 20) AS chr_right, substr(seq, 11, 20) AS tn_start, reverse(translate(substr(seq, 31, 20), 'ACGT', 'TGCA')) AS tn_end FROM arms),
picked AS (SELECT scaf, junction, CASE WHEN junction <= 2 THEN chr_left WHEN junction IN (3, 4, 7) THEN amp_right ELSE tn_end END AS a,
  CASE WHEN junction IN (1, 4, 5) THEN amp_left WHEN junction IN (2, 3) THEN tn_start ELSE chr_right END AS b FROM parts)
SELECT scaf, junction, reverse(translate(a, 'ACGT', 'TGCA')) || b AS seq FROM picked""")
def y3_y4_junction_sequences(spark, d):
    sc = v_scaffold(spark, d)
    a = lambda p, s: coords.arm(F.col("scaf"), F.lit(p), F.lit(s), F.lit(20))
    cands = sc.select("scaf", a(100, -1).alias("chr_left"), a(101, 1).alias("amp_left"), a(150, -1).alias("amp_right"), a(151, 1).alias("chr_right"), a(11, 1).alias("tn_start"), a(50, -1).alias("tn_end"))
    return reads.junction_sequences(reads.seven_junctions(cands), sc).select(F.col("arm1.scaf").alias("scaf"), "junction", "seq")


def v_read(spark: SparkSession, d: str) -> DataFrame:
    """Reads of 91 to 100 letters along each whole scaffold, one from every hundredth letter and the last up to the end,
    with none to four letters substituted (the length of the scaffold where that is less)."""
    n = lambda i: 91 + (F.col("doc_id") + i) % 10
    cut = lambda i: F.substring(F.col("seq"), F.greatest(F.lit(1), F.least(i * 100, F.col("length") - n(i)) + 1).cast("int"), n(i).cast("int"))
    rows = v_scaffold(spark, d, 1).select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / 100).cast("int")), cut)).alias("i", "read"))
    parts, at = [], 1
    for k, p in enumerate((7, 29, 51, 73)):
        one = F.substring("read", p, 1)
        parts += [F.substring("read", at, p - at), F.when(F.col("i") % 5 > k, F.translate(one, "ACGT", "CGTA")).otherwise(one)]
        at = p + 1
    return rows.select((F.col("doc_id").cast("long") * (1 << 32) + F.col("i")).alias("read_id"), F.concat(*parts, F.expr(f"substring(read, {at})")).alias("seq"))


@query()
def y6_match_reads(spark, d):
    return reads.match_reads(v_read(spark, d), v_scaffold(spark, d, 0).select(F.col("scaf").alias("target"), "seq"), 100)


def v_aln(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    rows = table(spark, d, "events")
    start = e * 37 % 500
    return rows.select(F.lit("x").alias("sample"), F.floor(e / 3003).alias("candidate"), (F.floor(e / 3) % 7 + 1).alias("junction"), F.floor(e / 3).alias("read_id"), (e % 3 % 2 == 1).alias("is_reverse"), start.alias("start"), (start + 90 + e * 13 % 70).alias("end"), (-(e % 31)).alias("score"), (e % 5).alias("mismatches"), e.alias("aln_index"), F.when(F.col("event_type") == "error", 4).otherwise(0).alias("flag"), F.lit("100M").alias("cigar"))


ALN = """aln AS (SELECT event_id // 3003 AS candidate, event_id // 3 % 7 + 1 AS junction, event_id // 3 AS read_id, event_id % 3 % 2 = 1 AS is_reverse, event_id * 37 % 500 AS start,
  event_id * 37 % 500 + 90 + event_id * 13 % 70 AS "end", -(event_id % 31) AS score, event_id % 5 AS mismatches, event_id AS aln_index, event_type <> 'error' AS mapped FROM events),
passed AS (SELECT * FROM aln WHERE mapped AND "end" - start >= 120 / 1.1 AND "end" - start <= 120 * 1.1 AND score >= -25 AND mismatches <= 3),
best AS (SELECT * FROM passed QUALIFY row_number() OVER (PARTITION BY candidate, junction, read_id, is_reverse ORDER BY score DESC, aln_index) = 1)"""
PAIRED = f"""{ALN}, two AS (SELECT candidate, junction, read_id, count(*) AS n, max(CASE WHEN NOT is_reverse THEN start END) AS fs, max(CASE WHEN NOT is_reverse THEN "end" END) AS fe, max(CASE WHEN is_reverse THEN start END) AS rs, max(CASE WHEN is_reverse THEN "end" END) AS re FROM best GROUP BY ALL),
mates AS (SELECT candidate, junction, read_id, n, n = 2 AND NOT fs < re AS swapped, CASE WHEN (n = 2 AND NOT fs < re) OR fs IS NULL THEN rs ELSE fs END AS s1, CASE WHEN (n = 2 AND NOT fs < re) OR fe IS NULL THEN re ELSE fe END AS e1,
  CASE WHEN n = 2 THEN CASE WHEN NOT fs < re THEN fs ELSE rs END END AS s2, CASE WHEN n = 2 THEN CASE WHEN NOT fs < re THEN fe ELSE re END END AS e2 FROM two)"""


def _kind(s: str, e: str) -> str:
    left, right = f"(300 - ({s} + 1) + 1)", f"({e} - 300)"
    return f"""CASE WHEN {s} IS NULL THEN NULL WHEN {right} <= 0 THEN CASE WHEN {left} > 290 THEN 'left_far' ELSE 'left' END WHEN {left} <= 0 THEN CASE WHEN {right} > 290 THEN 'right_far' ELSE 'right' END
  WHEN {left} >= 13 AND {right} >= 13 THEN 'spanning' WHEN {left} >= 13 THEN 'left_marginal' WHEN {right} >= 13 THEN 'right_marginal' END"""


TYPED = f"""{PAIRED}, kinds AS (SELECT *, {_kind("s1", "e1")} AS a, {_kind("s2", "e2")} AS b FROM mates),
counted AS (SELECT candidate, junction, read_id, unnest(CASE WHEN a IS NULL AND b IS NULL THEN [] WHEN b IS NULL THEN [a] WHEN a IS NULL THEN [b] WHEN a = b THEN [a]
  WHEN a IN ('left', 'left_far') AND b IN ('left', 'left_far') THEN [b] WHEN a IN ('right', 'right_far') AND b IN ('right', 'right_far') THEN [a]
  WHEN a IN ('left', 'left_far') AND b IN ('right', 'right_far') THEN [a, b, 'paired']
  WHEN a IN ('left', 'left_far') AND b IN ('spanning', 'left_marginal', 'right_marginal') OR a IN ('spanning', 'left_marginal', 'right_marginal') AND b IN ('right', 'right_far') THEN [a, b] ELSE [] END) AS t FROM kinds),
counts AS (SELECT candidate, junction, {", ".join(f"count(*) FILTER (t = '{t}') AS {t}" if t not in ("left", "right") else f'count(*) FILTER (t = {chr(39)}{t}{chr(39)}) AS "{t}"' for t in alignments.READ_TYPES)} FROM counted GROUP BY ALL)"""


def best_rows(spark, d):
    return alignments.best_hit(alignments.filter_hits(v_aln(spark, d), 120))


@query(f'WITH {ALN} SELECT candidate, junction, read_id, is_reverse, aln_index, start, "end" FROM best')
def n1_n6_best_hits(spark, d):
    return best_rows(spark, d).select("candidate", "junction", "read_id", "is_reverse", "aln_index", "start", "end")


@query(f"WITH {PAIRED} SELECT candidate, junction, read_id, n AS n_mates, swapped, s1 AS first_start, e1 AS first_end, s2 AS second_start, e2 AS second_end, e1 - s2 AS overlap FROM mates")
def n8_link_pairs(spark, d):
    return alignments.link_pairs(best_rows(spark, d)).drop("sample")


@query(f"""WITH {ALN}, s AS (SELECT candidate, junction, read_id, count(*) AS hits FROM aln GROUP BY ALL),
p AS (SELECT candidate, junction, read_id, is_reverse, count(*) AS n FROM passed GROUP BY ALL),
b AS (SELECT b.*, p.n FROM best b JOIN p USING (candidate, junction, read_id, is_reverse)),
r AS (SELECT s.*, coalesce(f.n, 0) AS nf, coalesce(v.n, 0) AS nr, f.start AS fs, f."end" AS fe, v.start AS rs, v."end" AS re FROM s
  LEFT JOIN (SELECT * FROM b WHERE NOT is_reverse) f USING (candidate, junction, read_id) LEFT JOIN (SELECT * FROM b WHERE is_reverse) v USING (candidate, junction, read_id))
SELECT candidate, CAST(sum(hits) AS BIGINT) AS n_hits, CAST(sum(nf + nr) AS BIGINT) AS n_passed, CAST(sum(nf) AS BIGINT) AS n_forward, CAST(sum(nr) AS BIGINT) AS n_reverse,
  count(*) FILTER (nf > 0) AS n_forward_strands, count(*) FILTER (nf > 1) AS n_forward_multi, count(*) FILTER (nr > 0) AS n_reverse_strands, count(*) FILTER (nr > 1) AS n_reverse_multi,
  count(*) FILTER (nf > 0 OR nr > 0) AS n_reads, count(*) FILTER (nf > 0 AND nr > 0 AND fs < re) AS n_normal_pairs, count(*) FILTER (nf > 0 AND nr > 0 AND NOT fs < re) AS n_swapped_pairs,
  round(avg(fe - rs) FILTER (nf > 0 AND nr > 0 AND fs < re), 6) AS normal_overlap, round(avg(re - fs) FILTER (nf > 0 AND nr > 0 AND NOT fs < re), 6) AS swapped_overlap FROM r GROUP BY candidate""")
def n15_alignment_stats(spark, d):
    n = F.col("end") - F.col("start")
    passed = (F.col("flag") == 0) & (n >= 120 / 1.1) & (n <= 120 * 1.1) & (F.col("score") >= -25) & (F.col("mismatches") <= 3)
    return alignments.alignment_stats(v_aln(spark, d), passed).drop("sample").withColumns({c: F.round(c, 6) for c in ("normal_overlap", "swapped_overlap")})


@query("""WITH e AS (SELECT event_id AS read_id, event_id * 37 % 500 AS start, 20 + event_id % 30 AS a, 1 + event_id % 3 AS b, 1 + event_id % 4 AS c FROM events),
o AS (SELECT read_id, start + x.at - 300 AS f, x.kind AS kind, x.len AS len FROM (SELECT *, unnest([{'kind': 'match', 'at': 0, 'len': a}, {'kind': 'mismatch', 'at': a, 'len': b}, {'kind': 'match', 'at': a + b, 'len': 10},
  {'kind': 'insertion', 'at': a + b + 10, 'len': 0}, {'kind': 'deletion', 'at': a + b + 10, 'len': c}, {'kind': 'match', 'at': a + b + 10 + c, 'len': 30}]) AS x FROM e))
SELECT read_id, kind, CAST(f AS DOUBLE) AS "from", CAST(f + len AS DOUBLE) AS "to" FROM o
UNION ALL SELECT read_id, 'snp', f + i + 0.5, f + i + 0.5 FROM (SELECT *, unnest(range(0, len)) AS i FROM o WHERE kind = 'mismatch')""")
def n17_alignment_segments(spark, d):
    e = F.col("event_id")
    cigar = F.concat((20 + e % 30).cast("string"), F.lit("M"), (1 + e % 3).cast("string"), F.lit("X10=2I"), (1 + e % 4).cast("string"), F.lit("D30="))
    hits = table(spark, d, "events").select(F.lit("x").alias("sample"), F.lit(0).alias("candidate"), F.lit(1).alias("junction"), e.alias("read_id"), (e * 37 % 500).alias("start"), cigar.alias("cigar"))
    return alignments.alignment_segments(hits, F.lit(300)).select("read_id", "kind", "from", "to")


def typed_rows(spark, d):
    mates = alignments.link_pairs(best_rows(spark, d))
    kind = lambda p: F.when(F.col(f"{p}_start").isNotNull(), alignments.read_type(F.col(f"{p}_start") + 1, F.col(f"{p}_end"), F.lit(300), 13, F.lit(290)))
    return mates.select(*alignments.GROUP, "read_id", F.explode(alignments.pair_read_types(kind("first"), kind("second"))).alias("read_type"))


def read_counts(spark, d):
    return alignments.count_read_types(typed_rows(spark, d))


@query(f"WITH {TYPED} SELECT * FROM counts")
def n9_n11_read_type_counts(spark, d):
    return read_counts(spark, d).drop("sample")


CALLS = f"""{TYPED}, x AS (SELECT *, least("left", "right") * (123 / 141) AS expected, sqrt(least("left", "right") * (123 / 141) * (123 / 141) + spanning) AS err FROM counts),
calls AS (SELECT candidate, junction, CASE WHEN spanning * 1.4 >= expected - 3 * err AND NOT (spanning <= 5 OR spanning <= 0.01 * expected) THEN true
  WHEN NOT spanning * 1.4 >= expected - 3 * err AND (spanning <= 5 OR spanning <= 0.01 * expected) THEN false END AS call FROM x)"""


def calls(spark, d):
    return read_counts(spark, d).withColumn("call", alignments.call_junction(F.col("left"), F.col("right"), F.col("spanning"), F.lit(123 / 141)))


@query(f"WITH {CALLS} SELECT * FROM calls")
def n13_call_junction(spark, d):
    return calls(spark, d).select("candidate", "junction", "call")


BITS = "CASE bits " + " ".join(f"WHEN '{b}' THEN '{n}'" for b, n, *_ in classify.ARCHITECTURES) + " ELSE 'unresolved' END"


@query(f"""WITH e AS (SELECT event_id // 64 AS candidate, event_id % 64 % 8 AS j, event_id FROM events), b AS (SELECT DISTINCT candidate, j FROM e WHERE j > 0),
k AS (SELECT o_orderkey AS candidate, {"|| ".join(f"(CASE WHEN (o_orderkey * 7 + o_custkey) // {2**i} % 2 = 1 THEN '1' ELSE '0' END) " for i in range(6))} AS bits FROM orders) SELECT candidate, {BITS} AS architecture FROM k""")
def a1_architecture(spark, d):
    v = F.col("o_orderkey") * 7 + F.col("o_custkey")
    rows = F.array(*[F.struct(F.lit(n).alias("junction"), (F.floor(v / 2**i) % 2 == 1).alias("call")) for i, n in enumerate(classify.NUMBERS)])
    return classify.architecture(table(spark, d, "orders").select(F.col("o_orderkey").alias("candidate"), F.explode(rows).alias("c")).select("candidate", "c.*"), ["candidate"])


@query("""WITH n AS (SELECT o_orderkey AS k, ['flanked', 'hemi-flanked left', 'hemi-flanked right', 'unflanked', 'hemi-flanked left singleton', 'hemi-flanked right singleton', 'amplicon-only', 'transposition'] AS x, o_orderkey % 8 AS i, (o_orderkey * 3 + o_custkey) % 8 AS a FROM orders),
f AS (SELECT k, x[i + 1] AS iso, x[a + 1] AS anc, [true, false, true, false, false, true, false, NULL] AS l, [true, true, false, false, true, false, false, NULL] AS r, [false, false, false, false, true, true, true, NULL] AS s, i, a FROM n)
SELECT k, iso, anc, CASE WHEN iso = anc THEN 'ancestral' ELSE concat_ws('; ', CASE WHEN l[i + 1] AND NOT l[a + 1] THEN 'de novo left' WHEN NOT l[i + 1] AND l[a + 1] THEN 'lost left' END,
 CASE WHEN r[i + 1] AND NOT r[a + 1] THEN 'de novo right' WHEN NOT r[i + 1] AND r[a + 1] THEN 'lost right' END, CASE WHEN s[i + 1] AND NOT s[a + 1] THEN 'to singleton' WHEN NOT s[i + 1] AND s[a + 1] THEN 'from singleton' END) END AS descriptors FROM f""")
def a2_compare_iso_anc(spark, d):
    names = F.array(*[F.lit(r[1]) for r in classify.ARCHITECTURES])
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.get(names, (F.col("o_orderkey") % 8).cast("int")).alias("iso"), F.get(names, ((F.col("o_orderkey") * 3 + F.col("o_custkey")) % 8).cast("int")).alias("anc"))
    return rows.select("k", "iso", "anc", F.array_join(classify.compare_iso_anc(F.col("iso"), F.col("anc")), "; ").alias("descriptors"))


@query("""SELECT c AS category, count(o_orderstatus) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) v(c) LEFT JOIN orders ON o_orderstatus = c GROUP BY c UNION ALL SELECT 'total', count(*) FROM orders""")
def a4_category_counts(spark, d):
    return classify.category_counts(table(spark, d, "orders"), "o_orderstatus", ["F", "O", "P", "X"])


@query("""WITH a AS (SELECT o_orderkey AS k, o_custkey AS p, ['IS' || o_orderkey % 5, 'IS' || o_custkey % 3] AS n FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_orderkey AS k, o_custkey AS p, ['IS' || o_orderkey % 4] AS n FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(a.k, b.k) AS pos1, coalesce(a.p, b.p) AS pos2, CASE WHEN b.n IS NULL THEN 'only left' WHEN a.n IS NULL THEN 'only right' ELSE 'matched' END AS state,
  array_to_string(list_sort(list_distinct(list_filter(coalesce(a.n, []), lambda x: NOT list_contains(coalesce(b.n, []), x)))), ',') AS only_a, array_to_string(list_sort(list_distinct(list_filter(coalesce(b.n, []), lambda x: NOT list_contains(coalesce(a.n, []), x)))), ',') AS only_b
FROM a FULL JOIN b ON a.k = b.k AND a.p = b.p""")
def a8_compare_call_sets(spark, d):
    o = table(spark, d, "orders")
    name = lambda c, m: F.concat(F.lit("IS"), (F.col(c) % m).cast("string"))
    rows = lambda w, names: o.filter(w).select(F.lit("c").alias("scaf"), F.col("o_orderkey").alias("pos1"), F.col("o_custkey").alias("pos2"), F.lit(False).alias("span_origin"), names.alias("names"))
    out = classify.compare_call_sets(rows("o_orderstatus <> 'P'", F.array(name("o_orderkey", 5), name("o_custkey", 3))), rows("o_orderstatus <> 'F'", F.array(name("o_orderkey", 4))))
    return out.select("pos1", "pos2", "state", F.array_join("only_a", ",").alias("only_a"), F.array_join("only_b", ",").alias("only_b"))


@query("""WITH l AS (SELECT event_id AS r, ['left', 'span', 'right'][event_id % 3 + 1] AS x, ['left', 'span', 'right'][(event_id * 7 + user_id) % 3 + 1] AS y, event_type AS t FROM events),
a AS (SELECT r, x FROM l WHERE t <> 'error'), b AS (SELECT r, y FROM l WHERE t <> 'view' AND t <> 'click')
SELECT coalesce(x, 'none') AS label_a, coalesce(y, 'none') AS label_b, count(*) AS n FROM a FULL JOIN b USING (r) GROUP BY ALL""")
def a9_read_label_confusion(spark, d):
    e = table(spark, d, "events")
    pick = lambda i: F.get(F.array(F.lit("left"), F.lit("span"), F.lit("right")), i.cast("int"))
    rows = lambda w, i: e.filter(w).select(F.col("event_id").alias("read_id"), F.lit(1).alias("junction"), pick(i).alias("label"))
    return classify.read_label_confusion(rows("event_type <> 'error'", F.col("event_id") % 3), rows("event_type NOT IN ('view', 'click')", (F.col("event_id") * 7 + F.col("user_id")) % 3))


@query("""WITH l AS (SELECT event_id AS r, ['left', 'span', 'right'][event_id % 3 + 1] AS x, ['left', 'span', 'right'][(event_id * 7 + user_id) % 3 + 1] AS y, event_type AS t FROM events),
a AS (SELECT r, x FROM l WHERE t <> 'error'), b AS (SELECT r, y FROM l WHERE t <> 'view' AND t <> 'click')
SELECT r AS read_id, coalesce(x, 'none') AS label_a, coalesce(y, 'none') AS label_b FROM a FULL JOIN b USING (r) WHERE coalesce(x, 'none') <> coalesce(y, 'none')""")
def a9_disagreements(spark, d):
    e = table(spark, d, "events")
    pick = lambda i: F.get(F.array(F.lit("left"), F.lit("span"), F.lit("right")), i.cast("int"))
    rows = lambda w, i: e.filter(w).select(F.col("event_id").alias("read_id"), F.lit(1).alias("junction"), pick(i).alias("label"))
    out = classify.read_label_disagreements(rows("event_type <> 'error'", F.col("event_id") % 3), rows("event_type NOT IN ('view', 'click')", (F.col("event_id") * 7 + F.col("user_id")) % 3))
    return out.select("read_id", "label_a", "label_b")


@query("""WITH a AS (SELECT l_suppkey AS scaf, l_partkey * 31 % 100003 AS pos FROM lineitem), b AS (SELECT DISTINCT o_custkey % 100 + 1 AS scaf, o_orderkey * 7919 % 100003 AS pos FROM orders),
n AS (SELECT a.scaf, a.pos, p.pos AS before FROM a ASOF LEFT JOIN b p ON a.scaf = p.scaf AND a.pos >= p.pos), m AS (SELECT n.*, q.pos AS after FROM n ASOF LEFT JOIN b q ON n.scaf = q.scaf AND n.pos <= q.pos)
SELECT scaf, pos, least(pos - before, after - pos) AS gap FROM m""")
def a11_nearest_position_gap(spark, d):
    a = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("scaf"), (F.col("l_partkey") * 31 % 100003).alias("pos"))
    b = table(spark, d, "orders").select((F.col("o_custkey") % 100 + 1).alias("scaf"), (F.col("o_orderkey") * 7919 % 100003).alias("pos")).distinct()
    return classify.nearest_position_gap(a, b)


@query("""WITH a AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_quantity < 30), b AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_quantity > 10)
SELECT k, n, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT k, n, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def a12_alignment_set_diff(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_quantity")
    return classify.alignment_set_diff(rows.filter("l_quantity < 30").drop("l_quantity"), rows.filter("l_quantity > 10").drop("l_quantity"))


def v_run(spark: SparkSession, d: str) -> DataFrame:
    state = F.get(F.array(*[F.lit(s) for s in status.STATES]), (F.col("event_id") % 4).cast("int"))
    return table(spark, d, "events").select(F.col("user_id").alias("run_id"), state.alias("state"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"))


RUN = "run AS (SELECT user_id AS run_id, ['started', 'completed', 'terminated', 'failed'][event_id % 4 + 1] AS state, event_id % 4 AS rank, ts, event_id AS seq FROM events)"


@query(f"WITH {RUN} SELECT run_id, state, epoch_us(ts) AS us FROM run QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, rank DESC, seq DESC) = 1")
def a14_latest_status(spark, d):
    return status.latest_status(v_run(spark, d)).select("run_id", "state", F.unix_micros("ts").alias("us"))


@query(f"""WITH {RUN} SELECT run_id, epoch_us(max(ts) FILTER (state <> 'started')) // 1000000 - epoch_us(min(ts) FILTER (state = 'started')) // 1000000 AS duration_sec,
  max(CASE WHEN state = 'completed' THEN 0 WHEN state <> 'started' THEN 1 END) AS exit_code FROM run GROUP BY run_id""")
def a13_run_durations(spark, d):
    return status.run_durations(v_run(spark, d)).select("run_id", "duration_sec", "exit_code")


@query("""WITH runs AS (SELECT 'o' || o_orderkey AS sample, CASE WHEN o_orderkey % 3 > 0 THEN 'o' || (o_orderkey - o_orderkey % 3) END AS anc, 'd' || o_custkey AS ref FROM orders),
refs AS (SELECT DISTINCT 'd' || doc_id AS ref FROM documents), size AS (SELECT 'o' || l_orderkey AS sample, count(*) AS n FROM lineitem GROUP BY 1),
cov AS (SELECT DISTINCT 'o' || l_orderkey AS sample FROM lineitem WHERE l_quantity > 10), rd AS (SELECT DISTINCT 'o' || l_orderkey AS sample FROM lineitem WHERE l_discount > 0.02),
x AS (SELECT r.*, n, concat_ws('; ', CASE WHEN f.ref IS NULL THEN 'reference not found' END, CASE WHEN n IS NULL THEN 'no junction file' END, CASE WHEN c.sample IS NULL THEN 'no coverage' END, CASE WHEN d.sample IS NULL THEN 'no reads' END,
  CASE WHEN anc IS NOT NULL AND ca.sample IS NULL THEN 'no coverage of the ancestor' END, CASE WHEN anc IS NOT NULL AND da.sample IS NULL THEN 'no reads of the ancestor' END) AS wrong
  FROM runs r LEFT JOIN refs f ON f.ref = r.ref LEFT JOIN size s ON s.sample = r.sample LEFT JOIN cov c ON c.sample = r.sample LEFT JOIN rd d ON d.sample = r.sample LEFT JOIN cov ca ON ca.sample = r.anc LEFT JOIN rd da ON da.sample = r.anc)
SELECT sample, anc, ref, CASE WHEN wrong <> '' THEN 'failed' WHEN n > 4 THEN 'terminated' ELSE 'started' END AS state, CASE WHEN wrong <> '' OR n > 4 THEN 1 END AS exit_code,
  CASE WHEN wrong <> '' THEN wrong WHEN n > 4 THEN 'junction file of ' || n || ' lines' END AS error FROM x""")
def a13_admit_runs(spark, d):
    name = lambda c: F.concat(F.lit("o"), c).alias("sample")
    k = F.col("o_orderkey")
    runs = table(spark, d, "orders").select(name(k), F.when(k % 3 > 0, F.concat(F.lit("o"), k - k % 3)).alias("anc"), F.concat(F.lit("d"), "o_custkey").alias("ref"))
    refs = table(spark, d, "documents").select(F.concat(F.lit("d"), "doc_id").alias("ref"))
    lines = table(spark, d, "lineitem")
    key = name(F.col("l_orderkey"))
    return cohort.admit_runs(runs, refs, lines.select(key), lines.filter("l_quantity > 10").select(key), lines.filter("l_discount > 0.02").select(key), 4).select("sample", "anc", "ref", "state", "exit_code", "error")


@query("""WITH s AS (SELECT o_orderkey AS run, CASE WHEN o_orderkey % 9 <> 0 THEN 'r' || o_custkey END AS ref_name, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS path, o_custkey % 3 <> 0 AS ncbi,
  coalesce(CASE o_custkey % 5 WHEN 0 THEN 'isescan' WHEN 1 THEN 'blast' WHEN 2 THEN 'isfinder' END, 'genbank') AS method, CASE WHEN o_orderkey % 2 = 0 THEN 'isescan' ELSE 'isfinder' END AS compared,
  coalesce(CASE o_orderkey % 4 WHEN 0 THEN 'mean' WHEN 1 THEN 'best' END, 'median') AS average FROM orders)
SELECT run, method, average, concat_ws('; ', CASE WHEN ref_name IS NULL THEN 'ref_name is required' END, CASE WHEN path IS NULL THEN 'iso_fastq_path is required' END,
  CASE WHEN method = 'blast' THEN 'unknown detection method' END, CASE WHEN method = compared THEN 'detection method among the compared' END,
  CASE WHEN NOT ncbi AND method = 'genbank' THEN 'local genomes need isfinder or isescan' END, CASE WHEN average = 'best' THEN 'unknown average method' END) AS errors FROM s""")
def p9_p10_run_parameters(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    sheet = table(spark, d, "orders").select(
        k.alias("run"), F.when(k % 9 != 0, F.concat(F.lit("r"), c)).alias("ref_name"), F.when(k % 13 != 0, F.col("o_orderpriority")).alias("iso_fastq_path"), (c % 3 != 0).alias("ncbi"),
        F.when(c % 5 == 0, "isescan").when(c % 5 == 1, "blast").when(c % 5 == 2, "isfinder").alias("is_detection_method"),
        F.array(F.when(k % 2 == 0, "isescan").otherwise("isfinder")).alias("run_comparison_methods"), F.when(k % 4 == 0, "mean").when(k % 4 == 1, "best").alias("average_method"),
    )
    runs = readers.merge_params(sheet, {"is_detection_method": "isfinder", "average_method": "median", "ref_path": "x"}, {"is_detection_method": "genbank", "average_method": None})
    return readers.validate_params(runs).select("run", F.col("is_detection_method").alias("method"), F.col("average_method").alias("average"), F.array_join("errors", "; ").alias("errors"))
