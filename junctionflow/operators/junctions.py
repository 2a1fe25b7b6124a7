"""Junctions: those of reference elements, matching to element ends, pairing into candidates, linking of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from junctionflow.functions import coords


def reference_junctions(ref_tn: DataFrame, out_span: int = 100, in_span: int | None = None) -> DataFrame:
    """Two junctions for each element (tn_id, scaf, start, end): num -2 id at its start, -2 id - 1 at its end.
    Arm 1 lies in the element, arm 2 outside."""
    left, right = F.least("start", "end"), F.greatest("start", "end")
    inside = F.lit(in_span) if in_span is not None else right - left + 1
    side = lambda num, s, pos, d: F.struct(num.alias("num"), F.lit(s).alias("side"), pos.alias("pos1"), F.lit(d).alias("dir1"), (pos - d).alias("pos2"), F.lit(-d).alias("dir2"))
    both = F.explode(F.array(side(-2 * F.col("tn_id"), -1, left, 1), side(-2 * F.col("tn_id") - 1, 1, right, -1))).alias("j")
    kept = [c for c in ref_tn.columns if c in ("sample", "ref")]
    return ref_tn.select(*kept, "tn_id", "scaf", inside.cast("int").alias("inside"), both).select(
        *kept, "j.num", F.struct("tn_id", "j.side").alias("ref_tn_side"), F.col("scaf").alias("scaf1"), "j.pos1", "j.dir1", F.col("inside").alias("flanking1"),
        F.col("scaf").alias("scaf2"), "j.pos2", "j.dir2", F.lit(out_span).alias("flanking2"),
    )


def reject_filter(junctions: DataFrame, enabled: bool = True) -> DataFrame:
    return junctions.filter(F.col("reject").isNull()) if enabled else junctions


def size_guard(lines: DataFrame, max_lines: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(lines of the samples within the limit, samples over it with their status); blank lines and comments count."""
    over = lines.groupBy("sample").agg(F.count("*").alias("n_lines")).filter(F.col("n_lines") > max_lines).withColumn("status", F.lit("terminated"))
    return lines.join(over.select("sample"), "sample", "left_anti"), over


def union_junctions(reference: DataFrame, observed: DataFrame) -> DataFrame:
    return reference.unionByName(observed, allowMissingColumns=True)


def match_tn_ends(junctions: DataFrame, ref_ends: DataFrame, max_dist: int = 10, trim: int = 5, seed: int = 16) -> DataFrame:
    """(num, arm, tn_id, side, offset): arms (num, arm, arm_seq) whose trimmed sequence occurs in an element end's
    sequence (tn_id, side, end_seq, flank) within max_dist of the junction; the first occurrence alone is looked at, and
    trimmed arms of no bases match nothing. Columns sample and ref keep cohorts apart where both tables have them.

    Joined by the arm's first bases (all of a short arm), which an end can hold only at the places near its junction."""
    apart = [c for c in ("sample", "ref") if c in junctions.columns and c in ref_ends.columns]
    named = [c for c in ("sample", "ref") if c in junctions.columns]
    arms = junctions.withColumn("_s", F.substring(F.col("arm_seq"), F.lit(1), F.length("arm_seq") - trim)).filter(F.length("_s") > 0).withColumn("_key", F.substring("_s", 1, seed))
    first, last = F.greatest(F.col("flank") - max_dist, F.lit(0)), F.least(F.col("flank") + max_dist, F.length("end_seq") - 1)
    places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    starts = F.flatten(F.transform(places, lambda i: F.transform(F.sequence(F.lit(1), F.lit(seed)), lambda n: F.substring(F.col("end_seq"), i + 1, n))))
    ends = ref_ends.select(*apart, "tn_id", "side", "end_seq", "flank", F.explode(F.array_distinct(starts)).alias("_key"))
    at = F.expr("instr(end_seq, _s)") - 1
    return arms.join(ends, [*apart, "_key"]).filter(at >= 0).withColumn("offset", at - F.col("flank")).filter(F.abs("offset") <= max_dist).select(*named, "num", "arm", "tn_id", "side", "offset")


def normalise_tn_arm(junctions: DataFrame) -> DataFrame:
    """Observed junctions (sides1, sides2: matches of each arm) with the element on arm 1: none dropped, only arm 2
    swapped, both read as arm 1. Reference junctions (ref_tn_side not null) stay as they are; one whose arm 1 does not
    match its own end once, without offset, is an error."""
    of_reference = F.col("ref_tn_side").isNotNull() if "ref_tn_side" in junctions.columns else F.lit(False)
    one, two = of_reference | (F.size("sides1") > 0), F.size("sides2") > 0
    rows = junctions
    if "ref_tn_side" in junctions.columns:
        itself = F.size(F.filter("sides1", lambda s: (s["tn_id"] == F.col("ref_tn_side.tn_id")) & (s["side"] == F.col("ref_tn_side.side")) & (s["offset"] == 0)))
        missed = F.raise_error(F.format_string("reference junction %d does not match itself", F.col("num"))).cast("boolean")
        rows = rows.filter(F.when(of_reference & (itself != 1), missed).otherwise(F.lit(True)))
    kept = rows.filter(one | two).withColumn("swapped", ~one)
    pairs = [("scaf1", "scaf2"), ("pos1", "pos2"), ("dir1", "dir2"), ("flanking1", "flanking2")]
    swap = lambda a, b: F.when(F.col("swapped"), F.col(b)).otherwise(F.col(a))
    return kept.withColumns({a: swap(a, b) for a, b in pairs} | {b: swap(b, a) for a, b in pairs} | {"ref_tn_sides": swap("sides1", "sides2")}).drop("sides1", "sides2")


def recentre_offset(tnjc: DataFrame) -> DataFrame:
    """The floored mean offset of observed junctions goes from the offsets into pos1."""
    total = F.aggregate("ref_tn_sides", F.lit(0).cast("long"), lambda n, s: n + s["offset"])
    mean = F.when(F.col("ref_tn_side").isNull(), F.floor(total / F.size("ref_tn_sides"))).otherwise(F.lit(0)).cast("int")
    moved = F.transform("ref_tn_sides", lambda s: s.withField("offset", (s["offset"] - F.col("_mean")).cast("int")))
    return tnjc.withColumn("_mean", mean).withColumn("pos1", F.col("pos1") - F.col("_mean") * F.col("dir1")).withColumn("ref_tn_sides", moved).drop("_mean")


def pair_junctions(tnjc: DataFrame) -> DataFrame:
    """Candidates: pairs of junctions (sample, num, scaf2, pos2, dir2, own_tn, sides array<struct<tn_id,side[,offset]>>) on
    one scaffold, looking at each other or away, that share an element on opposite sides. A reference junction's own
    element must be among the shared. An equi-join on the shared element; pair_id in the order of both junctions.
    matches lists the shared elements with the left and the right junction's side and offset, in the order of their lists."""
    nth = Window.partitionBy("sample").orderBy("scaf2", "pos2", "num")
    rows = tnjc.withColumn("at", F.row_number().over(nth))
    offset = F.col("s.offset") if "offset" in rows.schema["sides"].dataType.elementType.names else F.lit(0)
    sides = rows.select("sample", "scaf2", "num", "at", "pos2", "dir2", "own_tn", F.posexplode("sides").alias("nth", "s")).select("*", F.col("s.tn_id").alias("tn_id"), F.col("s.side").alias("side"), offset.alias("offset")).drop("s")
    i, j = (sides.select("sample", "scaf2", "tn_id", *[F.col(c).alias(f"{c}_{x}") for c in ("num", "at", "pos2", "dir2", "own_tn", "side", "offset", "nth")]) for x in "ij")
    pairs = i.join(j, ["sample", "scaf2", "tn_id"]).filter("at_i < at_j AND dir2_i = -dir2_j AND side_i = -side_j")
    keys = ["sample", "scaf2", "at_i", "at_j", "num_i", "num_j", "pos2_i", "pos2_j", "dir2_i", "own_tn_i", "own_tn_j"]
    side_of = lambda x: F.struct(F.col(f"side_{x}").alias("side"), F.col(f"offset_{x}").alias("offset"))
    match = F.struct(*[F.when(F.col("dir2_i") == 1, x).otherwise(y).alias(name) for name, x, y in (("l", F.col("nth_i"), F.col("nth_j")), ("r", F.col("nth_j"), F.col("nth_i")))], "tn_id", *[F.when(F.col("dir2_i") == 1, side_of(x)).otherwise(side_of(y)).alias(name) for name, x, y in (("left", "i", "j"), ("right", "j", "i"))])
    found = pairs.groupBy(*keys).agg(F.array_sort(F.collect_set("tn_id")).alias("tn_ids"), F.array_sort(F.collect_list(match)).alias("matches"))
    found = found.withColumn("matches", F.transform("matches", lambda m: F.struct(m["tn_id"].alias("tn_id"), m["left"].alias("left"), m["right"].alias("right"))))
    owned = [F.col(c).isNull() | F.array_contains("tn_ids", F.col(c)) for c in ("own_tn_i", "own_tn_j")]
    found = found.filter(owned[0] & owned[1])
    left = F.col("dir2_i") == 1
    pick = lambda c: (F.when(left, F.col(f"{c}_i")).otherwise(F.col(f"{c}_j")), F.when(left, F.col(f"{c}_j")).otherwise(F.col(f"{c}_i")))
    (ln, rn), (lp, rp), (lo, ro) = pick("num"), pick("pos2"), pick("own_tn")
    return found.select(
        "sample", F.row_number().over(Window.partitionBy("sample").orderBy("at_i", "at_j")).alias("pair_id"), F.col("scaf2").alias("scaf"),
        ln.alias("left_num"), rn.alias("right_num"), lp.alias("left"), rp.alias("right"), lo.alias("left_own"), ro.alias("right_own"), "tn_ids", "matches",
    )


def base_event(threshold: int = 100) -> Column:
    near = F.abs(F.col("right") - F.col("left")) < threshold
    return F.when(F.col("left_own") == F.col("right_own"), "reference-tn").when(near & F.col("left_own").isNull() & F.col("right_own").isNull(), "transposition").otherwise("locus-joining")


def amplicon_length(left: Column, right: Column, length: Column) -> Column:
    return coords.segment_length(left, right, F.lit(1), length, F.lit(True))


def link_single_locus(pairs: DataFrame) -> DataFrame:
    """pairs with left_links and right_links: other single-locus pairs that hold the same junction, in pair order; and
    left_link and right_link, the first of them: struct(pair_id, left, right, base_event, tn_ids), null without links."""
    single = pairs.filter(F.col("base_event") != "locus-joining")
    held = single.select("sample", F.struct("pair_id", "left", "right", "base_event", "tn_ids").alias("other"), F.explode(F.array_distinct(F.array("left_num", "right_num"))).alias("num"))
    out = pairs
    for side in ("left", "right"):
        hits = pairs.select("sample", "pair_id", F.col(f"{side}_num").alias("num")).join(held, ["sample", "num"]).filter(F.col("pair_id") != F.col("other.pair_id"))
        linked = hits.groupBy("sample", "pair_id").agg(F.array_sort(F.collect_list("other.pair_id")).alias(f"{side}_links"), F.min_by("other", "other.pair_id").alias(f"{side}_link"))
        out = out.join(linked, ["sample", "pair_id"], "left")
    void = F.array().cast("array<int>")
    return out.withColumns({c: F.coalesce(c, void) for c in ("left_links", "right_links")})


def flag_multi_link(linked: DataFrame) -> DataFrame:
    return linked.filter("size(left_links) > 1 OR size(right_links) > 1")


def raw_architecture() -> Column:
    left, right = F.size("left_links") > 0, F.size("right_links") > 0
    joined = F.when(left & right, "flanked").when(left, "hemi-flanked left").when(right, "hemi-flanked right").otherwise("unflanked")
    return F.when(F.col("base_event") == "locus-joining", joined).otherwise(F.col("base_event"))


def chosen_tn(linked: bool = False) -> Column:
    """The reference side's element, the left one's if both; else the least of the shared elements. On a ``linked`` table
    (link_single_locus) these are the pair's own that its first linked pairs on both sides have too; null if there is none."""
    shared = F.col("tn_ids")
    for c in ("left_link", "right_link") if linked else ():
        shared = F.when(F.col(c).isNull(), shared).otherwise(F.array_intersect(shared, F.col(f"{c}.tn_ids")))
    return F.coalesce("left_own", "right_own", F.array_min(shared))


def chosen_tn_sides(chosen: str = "chosen_tn") -> Column:
    """struct(tn_id, left, right) of the chosen element's first match; null where none is chosen."""
    return F.get(F.filter("matches", lambda m: m["tn_id"] == F.col(chosen)), F.lit(0))


def multi_tn_names(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """pairs with tn_names, of all their elements, and chosen_name, of the chosen one where the table has chosen_tn; names are
    (tn_id, tn_name), and ref where elements are numbered by reference."""
    apart = [c for c in ("sample", "ref") if c in names.columns and c in pairs.columns]
    each = pairs.select("sample", "pair_id", *[c for c in apart if c != "sample"], F.explode("tn_ids").alias("tn_id")).join(names, [*apart, "tn_id"])
    out = pairs.join(each.groupBy("sample", "pair_id").agg(F.array_sort(F.collect_set("tn_name")).alias("tn_names")), ["sample", "pair_id"], "left")
    if "chosen_tn" in pairs.columns:
        out = out.join(names.select(*apart, F.col("tn_id").alias("chosen_tn"), F.col("tn_name").alias("chosen_name")), [*apart, "chosen_tn"], "left")
    return out
