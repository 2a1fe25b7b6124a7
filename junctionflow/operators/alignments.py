"""Reads over synthetic junctions: hit filters, best hits, mates, read types, counts and calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

READ_TYPES = ["left_far", "left", "left_marginal", "spanning", "paired", "right_marginal", "right", "right_far"]
GROUP = ["sample", "candidate", "junction"]


def cigar_ops(cigar: Column) -> Column:
    """array<struct(op, len, ref)>: ref is the 0-based reference offset at which the operation starts."""
    ops = F.transform(F.regexp_extract_all(cigar, F.lit(r"\d+[MIDNSHP=X]"), F.lit(0)), lambda x: F.struct(F.right(x, F.lit(1)).alias("op"), F.regexp_extract(x, r"\d+", 0).cast("int").alias("len")))
    used = lambda o: F.when(o["op"].isin("M", "D", "N", "=", "X"), o["len"]).otherwise(0)
    return F.transform(ops, lambda o, i: F.struct(o["op"].alias("op"), o["len"].alias("len"), F.aggregate(F.slice(ops, F.lit(1), i), F.lit(0), lambda n, p: n + used(p)).alias("ref")))


def cigar_ref_length(cigar: Column) -> Column:
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0), lambda n, x: n + x.cast("int"))


def filter_hits(hits: DataFrame, read_length: int | None, tolerance: float | None = 0.1, min_score: int | None = -25, max_mismatch: int | None = 3, extra: Column | None = None) -> DataFrame:
    """Hits of allowed operations, mapped, not supplementary, of about the read's length, scored well enough. A null
    threshold is off; ``extra`` is any further predicate."""
    keep = (F.col("cigar").rlike("^(\\d+[MID=X])+$")) & (F.col("flag").bitwiseAND(F.lit(4 | 2048)) == 0)
    if read_length is not None and tolerance is not None:
        n = F.col("end") - F.col("start")
        keep &= (n >= read_length / (1 + tolerance)) & (n <= read_length * (1 + tolerance))
    if min_score is not None:
        keep &= F.col("score") >= min_score
    if max_mismatch is not None:
        keep &= F.col("mismatches") <= max_mismatch
    return hits.filter(keep if extra is None else keep & extra)


def indels_near_junction(ops: Column, start: Column, arm: Column, dist: int | None = 4) -> Column:
    """True when every insertion, and both ends of every deletion, lie within dist of the junction; -1 allows none."""
    indels = F.filter(ops, lambda o: o["op"].isin("I", "D"))
    if dist is None:
        return F.lit(True)
    near = lambda p: F.abs(p - arm) <= dist
    ok = F.forall(indels, lambda o: near(start + o["ref"]) & ((o["op"] == "I") | near(start + o["ref"] + o["len"])))
    return F.size(indels) == 0 if dist < 0 else (F.size(indels) == 0) | ok


def resolve_m(ops: Column, query: Column, reference: Column) -> Column:
    """Operations with M told apart into = and X, base by base, neighbours merged; query and reference are aligned
    strings of the hit without its indels' bases."""
    bases = lambda o: F.transform(F.sequence(F.lit(1), o["len"]), lambda k: F.struct(F.when(F.upper(F.substring(query, o["ref"] + k, F.lit(1))) == F.upper(F.substring(reference, o["ref"] + k, F.lit(1))), "=").otherwise("X").alias("op"), F.lit(1).alias("len")))
    return merge_cigar(F.flatten(F.transform(ops, lambda o: F.when(o["op"] == "M", bases(o)).otherwise(F.array(F.struct(o["op"].alias("op"), o["len"].alias("len")))))))


def merge_cigar(ops: Column) -> Column:
    """Neighbours of one operation become one."""
    empty = F.array().cast("array<struct<op:string,len:int>>")
    last = lambda a: F.element_at(a, -1)

    def step(a: Column, o: Column) -> Column:
        joined = F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(o["op"].alias("op"), (last(a)["len"] + o["len"]).alias("len"))))
        return F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["op"] == o["op"]), joined).otherwise(F.concat(a, F.array(F.struct(o["op"].alias("op"), o["len"].alias("len")))))

    return F.aggregate(ops, empty, step)


def best_hit(hits: DataFrame) -> DataFrame:
    """Per junction, read and strand the hit of most score, the first in order on a tie."""
    order = Window.partitionBy(*GROUP, "read_id", "is_reverse").orderBy(F.desc("score"), "aln_index")
    return hits.withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k")


def combine_hits(hits: DataFrame) -> DataFrame:
    one = F.struct("start", "end", "score", "aln_index")
    return hits.groupBy(*GROUP, "read_id", "is_reverse").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_list(one)).alias("hits"))


def link_pairs(best: DataFrame) -> DataFrame:
    """A row per junction and read: first_* and second_* in slot order, n_mates, swapped; second_* null without a mate.
    Mates are swapped when the forward one does not start before the reverse one ends."""
    pick = lambda rev, c: F.max(F.when(F.col("is_reverse") == rev, F.col(c)))
    rows = best.groupBy(*GROUP, "read_id").agg(*[pick(r, c).alias(f"{p}_{c}") for r, p in ((False, "f"), (True, "r")) for c in ("start", "end")], F.count("*").alias("n_mates"))
    swapped = (F.col("n_mates") == 2) & ~(F.col("f_start") < F.col("r_end"))
    rows = rows.withColumn("swapped", swapped)
    slot = lambda a, b: F.when(F.col("swapped") | F.col(a).isNull(), F.col(b)).otherwise(F.col(a))
    second = lambda a, b: F.when(F.col("n_mates") == 2, F.when(F.col("swapped"), F.col(a)).otherwise(F.col(b)))
    rows = rows.withColumns({"first_start": slot("f_start", "r_start"), "first_end": slot("f_end", "r_end"), "second_start": second("f_start", "r_start"), "second_end": second("f_end", "r_end")})
    return rows.withColumn("overlap", F.col("first_end") - F.col("second_start")).drop("f_start", "f_end", "r_start", "r_end")


def read_type(start: Column, end: Column, arm: Column, overlap: int = 13, max_dist: Column | None = None) -> Column:
    """1-based inclusive start and end against a junction between arm and arm + 1; null when both margins are short."""
    far = arm if max_dist is None else max_dist
    left, right = arm - start + 1, end - arm  # bases on either side
    return (
        F.when(right <= 0, F.when(left > far, "left_far").otherwise("left")).when(left <= 0, F.when(right > far, "right_far").otherwise("right"))
        .when((left >= overlap) & (right >= overlap), "spanning").when((left >= overlap) & (right < overlap), "left_marginal").when((right >= overlap) & (left < overlap), "right_marginal")
    )


def pair_read_types(first: Column, second: Column) -> Column:
    """The read types that a read counts for, from its mates' types in slot order."""
    side = lambda t, s: F.coalesce(t.startswith(s) & ~t.endswith("marginal"), F.lit(False))
    middle = lambda t: F.coalesce(t.isin("spanning", "left_marginal", "right_marginal"), F.lit(False))
    void = F.array().cast("array<string>")
    return (
        F.when(second.isNull() & first.isNull(), void).when(second.isNull(), F.array(first)).when(first.isNull(), F.array(second)).when(first == second, F.array(first))
        .when(side(first, "left") & side(second, "left"), F.array(second)).when(side(first, "right") & side(second, "right"), F.array(first))
        .when(side(first, "left") & side(second, "right"), F.array(first, second, F.lit("paired")))
        .when((side(first, "left") & middle(second)) | (middle(first) & side(second, "right")), F.array(first, second)).otherwise(void)
    )


def count_read_types(typed: DataFrame, junctions: DataFrame | None = None) -> DataFrame:
    """Counts of each read type per junction from rows with read_type; junctions without reads get zeros."""
    counts = typed.groupBy(*GROUP).agg(*[F.count_if(F.col("read_type") == t).alias(t) for t in READ_TYPES])
    return counts if junctions is None else junctions.select(*GROUP).distinct().join(counts, GROUP, "left").fillna(0, READ_TYPES)


def expected_counts(length: Column, arm: Column, overlap: int = 13, max_dist: int = -10) -> dict[str, Column]:
    """Uniformly placed reads by type; they add up to 2 arm - length + 1."""
    far = F.lit(-max_dist) if max_dist < 0 else arm - max_dist
    side = arm - length + 1 - far
    return {"left_far": far, "left": side, "left_marginal": F.lit(overlap), "spanning": length + 1 - 2 * overlap - 2 + 0 * arm, "right_marginal": F.lit(overlap), "right": side, "right_far": far}


def call_junction(left: Column, right: Column, spanning: Column, ratio: Column, factor: float = 1.4, errors: float = 3, few: int = 5, share: float = 0.01) -> Column:
    """True: covered, false: not, null: ambiguous. The expected spanning count is min(left, right) times ratio."""
    expected = F.least(left, right) * ratio
    # errors of the expected and the seen count add up in squares
    error = F.sqrt(F.least(left, right) * ratio * ratio + spanning)
    enough, zero = spanning * factor >= expected - errors * error, (spanning <= few) | (spanning <= share * expected)
    return F.when(enough & ~zero, True).when(~enough & zero, False)


def warn_paired_without_span(counts: DataFrame) -> DataFrame:
    return counts.filter("paired > 0 AND spanning = 0")


def alignment_stats(hits: DataFrame, passed: Column) -> DataFrame:
    """A row per sample and candidate: hits, those that pass by strand, reads' strands with any and with several of them (a strand
    is a read on a junction in one direction), reads and those with both mates, normal and swapped, and the mean overlap of
    mates, by their best hits. Levels are hit, strand, read and candidate, each an aggregate of the one before."""
    where = F.struct(F.col("start").alias("start"), F.col("end").alias("end"))
    best = F.min_by(F.when(passed, where), F.when(passed, F.struct((-F.col("score")).alias("s"), F.col("aln_index").alias("i"))))
    strands = hits.groupBy(*GROUP, "read_id", "is_reverse").agg(F.count("*").alias("hits"), F.count_if(passed).alias("n"), best.alias("best"))
    of = lambda reverse, value: F.max(F.when(F.col("is_reverse") == reverse, value))
    each = [x for r, d in ((False, "f"), (True, "r")) for x in (F.coalesce(of(r, F.col("n")), F.lit(0)).alias(f"n_{d}"), of(r, F.col("best")).alias(f"best_{d}"))]
    reads = strands.groupBy(*GROUP, "read_id").agg(F.sum("hits").alias("hits"), *each)
    pair, forward, reverse = (F.col("n_f") > 0) & (F.col("n_r") > 0), F.col("best_f"), F.col("best_r")
    normal = pair & (forward["start"] < reverse["end"])
    swapped = pair & ~(forward["start"] < reverse["end"])
    total = lambda c: F.sum(c).cast("long")
    return reads.groupBy("sample", "candidate").agg(
        total("hits").alias("n_hits"), total(F.col("n_f") + F.col("n_r")).alias("n_passed"), total("n_f").alias("n_forward"), total("n_r").alias("n_reverse"),
        F.count_if(F.col("n_f") > 0).alias("n_forward_strands"), F.count_if(F.col("n_f") > 1).alias("n_forward_multi"), F.count_if(F.col("n_r") > 0).alias("n_reverse_strands"), F.count_if(F.col("n_r") > 1).alias("n_reverse_multi"),
        F.count_if((F.col("n_f") > 0) | (F.col("n_r") > 0)).alias("n_reads"), F.count_if(normal).alias("n_normal_pairs"), F.count_if(swapped).alias("n_swapped_pairs"),
        F.avg(F.when(normal, forward["end"] - reverse["start"])).alias("normal_overlap"), F.avg(F.when(swapped, reverse["end"] - forward["start"])).alias("swapped_overlap"),
    )


def count_arithmetic(counts: DataFrame, other: DataFrame | float, how: str) -> DataFrame:
    """Element-wise + - * / // max of two count tables with the same keys, or of one with a number, and the total. A junction
    that one table lacks counts as zeros there; division by zero gives null."""
    ops = {"+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "/": F.try_divide, "//": lambda a, b: F.floor(F.try_divide(a, b)), "max": F.greatest}
    if isinstance(other, DataFrame):
        both = counts.alias("a").join(other.alias("b"), GROUP, "full_outer")
        each = [ops[how](F.coalesce(f"a.{t}", F.lit(0)), F.coalesce(f"b.{t}", F.lit(0))).alias(t) for t in READ_TYPES]
    else:
        both, each = counts, [ops[how](F.col(t), F.lit(other)).alias(t) for t in READ_TYPES]
    out = both.select(*GROUP, *each)
    return out.withColumn("total", sum((F.col(t) for t in READ_TYPES[1:]), F.col(READ_TYPES[0])))


def alignment_segments(hits: DataFrame, arm: Column) -> DataFrame:
    """Rows to plot, in coordinates around the junction: kind, from, to of each operation (match, mismatch, deletion; insertion
    at one place), and a snp in the middle of each mismatched base."""
    names = F.create_map(*[F.lit(x) for x in ("M", "match", "=", "match", "X", "mismatch", "D", "deletion", "I", "insertion")])
    ops = hits.select(*GROUP, "read_id", "start", arm.alias("_arm"), F.explode(cigar_ops(F.col("cigar"))).alias("o"))
    at = (F.col("start") + F.col("o.ref") - F.col("_arm")).cast("double")
    segment = lambda kind, a, b: F.struct(kind.alias("kind"), a.alias("from"), b.alias("to"))
    own = F.array(segment(names[F.col("o.op")], at, F.when(F.col("o.op") == "I", at).otherwise(at + F.col("o.len"))))
    bases = F.transform(F.sequence(F.lit(0), F.col("o.len") - 1), lambda i: segment(F.lit("snp"), at + i + 0.5, at + i + 0.5))
    each = F.when(F.col("o.op") == "X", F.concat(own, bases)).otherwise(own)
    return ops.select(*GROUP, "read_id", F.explode(each).alias("s")).select(*GROUP, "read_id", "s.*")


def downsample_hits(typed: DataFrame, expected: dict[str, Column], max_reads: int = 200) -> DataFrame:
    """Every k-th hit by middle position, far types left out. k = max(1, count div the type's share of max_reads), shares
    being those of the ``expected`` counts (expected_counts); paired hits take k of the spanning ones."""
    near = {t: e for t, e in expected.items() if not t.endswith("far")}
    total = sum(near.values(), F.lit(0))
    count = lambda t: F.count_if(F.col("read_type") == t).over(Window.partitionBy(*GROUP))
    k = {t: F.greatest(F.lit(1), F.floor(count(t) / F.greatest(F.lit(1), F.floor(e * max_reads / total)))) for t, e in near.items()}
    k["paired"] = k["spanning"]
    step = F.coalesce(*[F.when(F.col("read_type") == t, n) for t, n in k.items()])
    nth = F.row_number().over(Window.partitionBy(*GROUP, "read_type").orderBy((F.col("start") + F.col("end")) / 2, "read_id"))
    rows = typed.filter(~F.col("read_type").endswith("far")).withColumn("_step", step).withColumn("_n", nth)
    return rows.filter(F.pmod(F.col("_n") - 1, F.col("_step")) == 0).drop("_step", "_n")


def jc_cov_vector(counts: DataFrame, keys: Sequence[str] = ("sample", "candidate")) -> DataFrame:
    """(left, spanning, right) of the junction types in order."""
    rows = F.array_sort(F.collect_list(F.struct("junction", "left", "spanning", "right")))
    return counts.groupBy(*keys).agg(F.transform(rows, lambda r: F.array(r["left"], r["spanning"], r["right"])).alias("jc_cov"))
