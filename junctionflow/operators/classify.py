"""Architectures from junction calls, what changed since the ancestor, and comparison of call sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Calls of junction types 1, 2, 3, 5, 6, 7 by architecture; flanked left, flanked right, singleton (fixed values: the
#: flags of the half-flanked ones name the other side than the pattern does).
ARCHITECTURES = [
    ("011110", "flanked", True, True, False),
    ("011101", "hemi-flanked left", False, True, False),
    ("101110", "hemi-flanked right", True, False, False),
    ("101101", "unflanked", False, False, False),
    ("010101", "hemi-flanked left singleton", False, True, True),
    ("101010", "hemi-flanked right singleton", True, False, True),
    ("100001", "amplicon-only", False, False, True),
    ("010010", "transposition", None, None, None),
]
NUMBERS = [1, 2, 3, 5, 6, 7]
#: The word on a covered junction of type 4 (fixed value).
AMP_AMP = "observed amplicon-amplicon (IS loss)"


def architecture(calls: DataFrame, keys: list[str]) -> DataFrame:
    """keys, architecture from rows (junction 1..7, call); an ambiguous or missing call leaves it unresolved."""
    bit = lambda n: F.max(F.when(F.col("junction") == n, F.col("call").cast("int").cast("string")))
    bits = calls.groupBy(*keys).agg(F.concat(*[bit(n) for n in NUMBERS]).alias("bits"))
    names = F.create_map(*[F.lit(x) for row in ARCHITECTURES for x in row[:2]])
    return bits.select(*keys, F.coalesce(F.try_element_at(names, F.coalesce("bits", F.lit(""))), F.lit("unresolved")).alias("architecture"))


def _flag(arch: Column, i: int) -> Column:
    told = [(r[1], r[i]) for r in ARCHITECTURES if r[i] is not None]
    return F.try_element_at(F.create_map(*[F.lit(x) for row in told for x in row]), arch)


def compare_iso_anc(iso: Column, anc: Column) -> Column:
    """The list of event descriptors."""
    out = []
    for i, gain, loss in ((2, "de novo left", "lost left"), (3, "de novo right", "lost right"), (4, "to singleton", "from singleton")):
        a, b = _flag(iso, i), _flag(anc, i)
        out.append(F.when(a & ~b, gain).when(~a & b, loss))
    return F.when(iso == anc, F.array(F.lit("ancestral"))).otherwise(F.array_compact(F.array(*out)))


def flag_amp_amp(descriptors: Column, call4: Column) -> Column:
    """Descriptors, with a word on a covered junction of type 4."""
    return F.when(F.coalesce(call4, F.lit(False)), F.concat(descriptors, F.array(F.lit(AMP_AMP)))).otherwise(descriptors)


def category_counts(rows: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """category, n for each of the fixed categories, zeros too, and their total; other values fail."""
    known = F.explode(F.array(*[F.lit(c) for c in [*categories, "total"]])).alias("category")
    frame = rows.sparkSession.range(1).select(known)
    counts = rows.withColumn("category", F.when(F.col(column).isin(categories), F.col(column)).otherwise(F.raise_error(F.concat(F.lit("unexpected category: "), F.coalesce(column, F.lit("null"))))))
    each = counts.rollup("category").agg(F.count("*").alias("n")).select(F.coalesce("category", F.lit("total")).alias("category"), "n")
    return frame.join(F.broadcast(each), "category", "left").fillna(0, ["n"])


def record_type_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sample", "type").count()


def summary_amplicons(rows: DataFrame) -> DataFrame:
    """A row for each classified candidate, as the summary has it (of junctions.multi_tn_names)."""
    return rows.select(
        "sample", "pair_id", F.concat_ws("-", "left", "right").alias("positions"), "span_origin", "length", F.col("tn_names").alias("possible_ISs"), F.col("chosen_name").alias("chosen_IS"),
        F.round("copy_number", 1).alias("copy_number"), "architecture", F.col("anc_architecture").alias("ancestor_architecture"), "descriptors",
        F.col("left_own").isNotNull().alias("left_is_ref_tn"), F.col("right_own").isNotNull().alias("right_is_ref_tn"),
    )


def summary_transpositions(linked: DataFrame) -> DataFrame:
    """The transpositions of the unfiltered pairs; their lengths may be negative."""
    return linked.filter("base_event = 'transposition'").select("sample", "pair_id", F.concat_ws("-", "left", "right").alias("positions"), (F.col("right") - F.col("left")).alias("length"), F.col("tn_names").alias("possible_ISs"))


def compare_call_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """key, state (matched, only left, only right), and element names that only one side has, on (scaf, pos1, pos2, span_origin)."""
    keys = ["scaf", "pos1", "pos2", "span_origin"]
    both = a.select(*keys, F.col("names").alias("a")).join(b.select(*keys, F.col("names").alias("b")), keys, "full_outer")
    state = F.when(F.col("b").isNull(), "only left").when(F.col("a").isNull(), "only right").otherwise("matched")
    void = F.array().cast("array<string>")
    less = lambda x, y: F.array_sort(F.array_except(F.coalesce(x, void), F.coalesce(y, void)))
    return both.select(*keys, state.alias("state"), less(F.col("a"), F.col("b")).alias("only_a"), less(F.col("b"), F.col("a")).alias("only_b"))


def read_label_confusion(a: DataFrame, b: DataFrame) -> DataFrame:
    """label_a, label_b, n over reads (read_id, junction, label); none where a labelling lacks the read."""
    both = a.select("read_id", "junction", F.col("label").alias("label_a")).join(b.select("read_id", "junction", F.col("label").alias("label_b")), ["read_id", "junction"], "full_outer").fillna("none", ["label_a", "label_b"])
    return both.groupBy("label_a", "label_b").agg(F.count("*").alias("n"))


def read_label_disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """read_id, junction, label_a, label_b of the reads that two labellings tell apart; none where one lacks the read."""
    both = a.select("read_id", "junction", F.col("label").alias("label_a")).join(b.select("read_id", "junction", F.col("label").alias("label_b")), ["read_id", "junction"], "full_outer")
    return both.fillna("none", ["label_a", "label_b"]).filter("label_a <> label_b")


def count_tolerance_check(a: DataFrame, b: DataFrame, keys: list[str], share: float = 0.1) -> DataFrame:
    """Junctions whose left, right or spanning counts differ by more than a share of the larger."""
    both = a.alias("a").join(b.alias("b"), keys, "full_outer")
    pair = lambda c: (F.coalesce(f"a.{c}", F.lit(0)), F.coalesce(f"b.{c}", F.lit(0)))
    off = [F.abs(x - y) > share * F.greatest(x, y) for x, y in map(pair, ("left", "right", "spanning"))]
    return both.filter(off[0] | off[1] | off[2]).select(*keys)


def nearest_position_gap(a: DataFrame, b: DataFrame, width: int = 4096, group: int = 4096) -> DataFrame:
    """scaf, pos, gap: the distance from each position of a to the nearest of b on its scaffold; null if there is none.

    Positions are told apart by bins of ``width``; a bin gets the last position of b before it and the first after it by a
    scan on two levels, within groups of bins and over the groups, so no window holds a scaffold."""
    number = F.floor(F.col("pos") / width)
    mine, theirs = (x.groupBy("scaf", "pos").agg(F.lit(True).alias(n)) for x, n in ((a, "mine"), (b, "theirs")))
    every = mine.join(theirs, ["scaf", "pos"], "full_outer").withColumn("_bin", number)
    other = F.when(F.col("theirs"), F.col("pos"))
    bins = every.groupBy("scaf", "_bin").agg(F.min(other).alias("first"), F.max(other).alias("last")).withColumn("_group", F.floor(F.col("_bin") / group))
    groups = bins.groupBy("scaf", "_group").agg(F.min("first").alias("first"), F.max("last").alias("last"))

    def carried(rows: DataFrame, key: list[str], by: str, name: str) -> DataFrame:
        w = Window.partitionBy(*key).orderBy(by)
        before = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
        return rows.withColumns({f"_before_{name}": before, f"_after_{name}": F.min("first").over(w.rowsBetween(1, Window.unboundedFollowing))})

    outer = carried(groups, ["scaf"], "_group", "group").drop("first", "last")
    inner = carried(bins, ["scaf", "_group"], "_bin", "bin").join(outer, ["scaf", "_group"])
    inner = inner.select("scaf", "_bin", F.coalesce("_before_bin", "_before_group").alias("_before_all"), F.coalesce("_after_bin", "_after_group").alias("_after_all"))
    order = Window.partitionBy("scaf", "_bin").orderBy("pos")
    rows = every.withColumns({"_before": F.last(other, True).over(order.rowsBetween(Window.unboundedPreceding, 0)), "_after": F.first(other, True).over(order.rowsBetween(0, Window.unboundedFollowing))}).filter("mine").join(inner, ["scaf", "_bin"])
    gap = F.least(F.col("pos") - F.coalesce("_before", "_before_all"), F.coalesce("_after", "_after_all") - F.col("pos"))
    gaps = rows.select("scaf", "pos", gap.alias("gap"))
    return a.select("scaf", "pos").join(gaps, ["scaf", "pos"])  # a position that many rows have is one row of gaps


def alignment_set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one set that the other lacks, with the side they stand on; repeats count."""
    cols = sorted(a.columns)
    return a.select(cols).exceptAll(b.select(cols)).withColumn("side", F.lit("left")).unionByName(b.select(cols).exceptAll(a.select(cols)).withColumn("side", F.lit("right")))
