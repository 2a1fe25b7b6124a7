"""Circular-genome coordinates and sequences as column expressions: 1-based, inclusive, with orientation +1 or -1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: IUPAC complements (fixed values).
BASES, COMPLEMENTS = "ACGTUNRYKMBVDHSWacgtunrykmbvdhsw", "TGCAANYRMKVBHDSWtgcaanyrmkvbhdsw"


def circ_normalize(start: Column, end: Column, orientation: Column, length: Column, circular: Column) -> Column:
    """struct(start, end, span_origin): circular positions modulo the length; null flag for an inverted linear segment."""
    s, e = F.when(circular, F.pmod(start - 1, length) + 1).otherwise(start), F.when(circular, F.pmod(end - 1, length) + 1).otherwise(end)
    inverted = F.when(orientation >= 0, s > e).otherwise(s < e)
    return F.struct(s.alias("start"), e.alias("end"), F.when(circular | ~inverted, inverted).alias("span_origin"))


def segment_length(start: Column, end: Column, orientation: Column, length: Column, circular: Column) -> Column:
    """Inclusive length, around the origin where it must; -1 if invalid."""
    forward = F.when(orientation >= 0, end - start).otherwise(start - end)
    return F.when(forward >= 0, forward + 1).when(circular, forward + length + 1).otherwise(F.lit(-1))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, BASES, COMPLEMENTS))


def slice_seq(seq: Column, start: Column, end: Column, orientation: Column, circular: Column) -> Column:
    """The segment's bases: two pieces around the origin, none if invalid, reverse-complemented on the reverse strand."""
    left, right = F.when(orientation >= 0, start).otherwise(end), F.when(orientation >= 0, end).otherwise(start)
    n = F.length(seq)
    one = F.substring(seq, left.cast("int"), (right - left + 1).cast("int"))
    two = F.concat(F.substring(seq, left.cast("int"), (n - left + 1).cast("int")), F.substring(seq, F.lit(1), right.cast("int")))
    forward = F.when(left <= right, one).when(circular, two).otherwise(F.lit(""))
    return F.when(orientation >= 0, forward).otherwise(reverse_complement(forward))


def linear_pieces(start: Column, end: Column, length: Column) -> Column:
    """array of struct(first, last): a forward segment as one piece, or two when it spans the origin."""
    piece = lambda a, b: F.struct(a.cast("long").alias("first"), b.cast("long").alias("last"))
    return F.when(start <= end, F.array(piece(start, end))).otherwise(F.array(piece(start, length), piece(F.lit(1), end)))


def arm(scaf: Column, start: Column, direction: Column, flank: Column) -> Column:
    return F.struct(scaf.alias("scaf"), start.cast("long").alias("start"), direction.cast("int").alias("dir"), flank.cast("int").alias("flank"))


def arm_end(a: Column) -> Column:
    return a["start"] + (a["flank"] - 1) * a["dir"]


def arm_shift(a: Column, by: Column) -> Column:
    return arm(a["scaf"], a["start"] + by * a["dir"], a["dir"], a["flank"])


def arm_distance(a: Column, b: Column) -> Column:
    """Signed distance from a to b along a's direction; null across scaffolds or directions."""
    return F.when((a["scaf"] == b["scaf"]) & (a["dir"] == b["dir"]), (b["start"] - a["start"]) * a["dir"])


def arm_mirror(a: Column, flank: Column | None = None) -> Column:
    """The adjacent arm that looks the other way."""
    return arm(a["scaf"], a["start"] - a["dir"], -a["dir"], a["flank"] if flank is None else flank)


def inward_arms(scaf: Column, left: Column, right: Column, flank: Column, right_flank: Column | None = None) -> tuple[Column, Column]:
    """Arms from both ends into a forward segment; ``right_flank`` where its right arm has another length."""
    return arm(scaf, left, F.lit(1), flank), arm(scaf, right, F.lit(-1), flank if right_flank is None else right_flank)


def outward_arms(scaf: Column, left: Column, right: Column, flank: Column, right_flank: Column | None = None) -> tuple[Column, Column]:
    return tuple(arm_mirror(a) for a in inward_arms(scaf, left, right, flank, right_flank))


def segment_junctions(scaf: Column, left: Column, right: Column, inside: Column, outside: Column) -> Column:
    """array of two struct(arm1, arm2), one for each end of a forward segment: arm 1 looks in, arm 2 out."""
    ends = zip(inward_arms(scaf, left, right, inside), outward_arms(scaf, left, right, outside), strict=True)
    return F.array(*[F.struct(a.alias("arm1"), b.alias("arm2")) for a, b in ends])


def jc_arms(df: DataFrame) -> DataFrame:
    """Junction rows with arm1 and arm2, structs made of their columns."""
    return df.withColumns({f"arm{n}": arm(F.col(f"scaf{n}"), F.col(f"pos{n}"), F.col(f"dir{n}"), F.col(f"flanking{n}")) for n in (1, 2)})


def from_arms(df: DataFrame) -> DataFrame:
    """Rows with arm1 and arm2 as junction rows; the inverse of ``jc_arms``."""
    fields = {"scaf": "scaf", "pos": "start", "dir": "dir", "flanking": "flank"}
    return df.withColumns({f"{c}{n}": F.col(f"arm{n}.{f}") for n in (1, 2) for c, f in fields.items()}).drop("arm1", "arm2")


def arm_seq(seq: Column, a: Column, circular: Column) -> Column:
    """The arm's bases, read away from the junction."""
    n = F.length(seq)
    end = arm_end(a)
    return slice_seq(seq, F.when(circular, F.pmod(a["start"] - 1, n) + 1).otherwise(a["start"]), F.when(circular, F.pmod(end - 1, n) + 1).otherwise(end), a["dir"], circular)


def junction_seq_1to2(seq1: Column, a1: Column, circular1: Column, seq2: Column, a2: Column, circular2: Column) -> Column:
    return F.concat(reverse_complement(arm_seq(seq1, a1, circular1)), arm_seq(seq2, a2, circular2))


def junction_seq_2to1(seq1: Column, a1: Column, circular1: Column, seq2: Column, a2: Column, circular2: Column) -> Column:
    return junction_seq_1to2(seq2, a2, circular2, seq1, a1, circular1)


def swap_sides(df: DataFrame) -> DataFrame:
    """Junction rows with arms 1 and 2 exchanged; other columns stay."""
    pairs = [("scaf1", "scaf2"), ("pos1", "pos2"), ("dir1", "dir2"), ("flanking1", "flanking2")]
    return df.withColumns({a: F.col(b) for a, b in pairs} | {b: F.col(a) for a, b in pairs})


def segment_sides(orientation: Column, start: Column, end: Column) -> Column:
    """struct(left, right) of an oriented segment."""
    return F.struct(F.when(orientation >= 0, start).otherwise(end).alias("left"), F.when(orientation >= 0, end).otherwise(start).alias("right"))


def segment_ends(orientation: Column, left: Column, right: Column) -> Column:
    """struct(start, end) of the segment with these sides; the inverse of ``segment_sides``."""
    sides = segment_sides(orientation, left, right)
    return F.struct(sides["left"].alias("start"), sides["right"].alias("end"))


def scaffold_ranges(scaffolds: DataFrame) -> DataFrame:
    """scaffolds (ref, scaf, length) with range_start, range_end: 0-based ranges on the concatenated genome."""
    before = F.sum("length").over(Window.partitionBy("ref").orderBy("scaf").rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(before, F.lit(0))
    return scaffolds.withColumn("range_start", start).withColumn("range_end", start + F.col("length"))


def genome_length(scaffolds: DataFrame) -> DataFrame:
    return scaffolds.groupBy("ref").agg(F.sum("length").alias("genome_length"))


def infer_circularity(scaffolds: DataFrame) -> DataFrame:
    """is_circular from the given topology, or from being the only record of a reference."""
    alone = F.count("*").over(Window.partitionBy("ref")) == 1
    return scaffolds.withColumn("is_circular", F.coalesce(F.col("topology") == "circular", alone))


def candidate_name(key: Column) -> Column:
    """Text that names a candidate's junctions one to one, from the struct of reads.synthetic_arms."""
    side = F.when(key["start_at_left"], "S").otherwise("E")
    return F.format_string(
        "jc_%s_%d-%d_%s_%d-%d_L%+dL%+d_R%+dR%+d%s_%dbp", key["amp_scaf"], key["amp_left"], key["amp_right"], key["tn_scaf"], key["tn_start"], key["tn_end"],
        key["chr_left"], key["chr_left_tn"], key["chr_right"], key["chr_right_tn"], side, key["flank"],
    )
