"""Per-base coverage, averages over scaffolds and candidate segments, copy numbers.

Coverage stays distributed: rows (sample, scaf, pos, iso, anc). Candidates go once to where the coverage of their scaffold
goes (``beside_coverage``), and what is asked of their segments is answered there: a segment has many times the rows of its
candidate, which are never shuffled. Inside a scaffold, whole blocks contribute their value histogram, only the blocks at a
segment's ends are looked into, and robust averages are taken from the histograms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from junctionflow.functions import coords, ranges

KEYS = ["sample", "scaf"]
#: Candidates of a scaffold above which they are dealt over tasks, each with the scaffold's coverage.
CANDIDATES = 20_000
#: Rows of a profile that a batch holds.
PROFILE_ROWS = 1 << 17


def total_depth(rows: DataFrame) -> DataFrame:
    return rows.withColumn("cov", (F.col("unique_top_cov") + F.col("unique_bot_cov")).cast("int"))


def median_of(value: str, times: str = "n") -> Column:
    return F.expr(f"percentile({value}, 0.5, {times})")


def mean_of(value: str, times: str = "n") -> Column:
    return F.try_divide(F.sum(F.col(value) * F.col(times)), F.sum(times).cast("double"))


def scaffold_average(coverage: DataFrame, value: str, method: str = "median") -> DataFrame:
    """sample, scaf, average of all positions, zeros included, from the histogram of values."""
    counts = coverage.groupBy(*KEYS, value).agg(F.count("*").alias("n"))
    if method == "mode":
        return distribution_mode(counts.withColumnRenamed(value, "x"), KEYS)
    return counts.groupBy(*KEYS).agg((median_of(value) if method == "median" else mean_of(value)).alias("average"))


def distribution_mode(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, average: the mode of positive values x (n times each): log scale, edges by the Freedman-Diaconis rule (without
    spread by the square root rule, 50 at most), ten at least, the middle of the fullest bin, the first on a tie. A value at an edge, by nine digits, is in the bin above."""
    logs = counts.filter("x > 0").withColumn("y", F.log("x"))
    stats = logs.groupBy(*keys).agg(
        F.expr("percentile(y, 0.25, n)").alias("q1"), F.expr("percentile(y, 0.75, n)").alias("q3"), F.min("y").alias("low"), F.max("y").alias("high"), F.sum("n").alias("total")
    )
    width = 2 * (F.col("q3") - F.col("q1")) / F.pow("total", F.lit(1 / 3))
    edges = F.when(width > 0, F.floor((F.col("high") - F.col("low")) / width)).otherwise(F.least(F.lit(50), F.floor(F.sqrt("total"))))
    bins = F.greatest(edges, F.lit(10)) - 1  # that many edges make one bin less
    placed = logs.join(stats, keys).withColumn("bins", bins).withColumn("step", (F.col("high") - F.col("low")) / F.col("bins"))
    number = F.when(F.col("step") > 0, F.least(F.floor(F.round((F.col("y") - F.col("low")) / F.col("step"), 9)), F.col("bins") - 1)).otherwise(0)
    filled = placed.withColumn("bin", number).groupBy(*keys, "bin", "low", "step").agg(F.sum("n").alias("filled"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("filled"), "bin"))
    return filled.withColumn("_k", first).filter("_k = 1").select(*keys, F.exp(F.col("low") + (F.col("bin") + 0.5) * F.col("step")).alias("average"))


def length_reason(low: int = 100, high: int = 1_000_000) -> Column:
    """Why a candidate (base_event, length) has no coverage averages: not locus-joining, too long, too short; null if it has."""
    return F.when(F.col("base_event") != "locus-joining", "not locus-joining").when(F.col("length") > high, "too long").when(F.col("length") < low, "too short")


def length_gate(candidates: DataFrame, low: int = 100, high: int = 1_000_000) -> DataFrame:
    return candidates.filter(length_reason(low, high).isNull())


def length_gate_counts(candidates: DataFrame, low: int = 100, high: int = 1_000_000) -> DataFrame:
    """sample, n_locus_joining, n_too_long, n_too_short, n_kept."""
    reason = length_reason(low, high)
    counted = {"n_locus_joining": F.col("base_event") == "locus-joining", "n_too_long": reason == "too long", "n_too_short": reason == "too short", "n_kept": reason.isNull()}
    return candidates.groupBy("sample").agg(*[F.count_if(c).alias(n) for n, c in counted.items()])


def amplicon_histogram(candidates: DataFrame, coverage: DataFrame, block: int = 4096) -> DataFrame:
    """sample, cand_id, iso, anc, n: how often each pair of values occurs in each candidate's segment.

    candidates: sample, scaf, cand_id, start, end, length (of the scaffold); a segment may wrap around the origin.
    """
    piece = F.explode(coords.linear_pieces(F.col("start"), F.col("end"), F.col("length")))
    return piece_histogram(candidates.select(*KEYS, "cand_id", piece.alias("p")).select(*KEYS, "cand_id", "p.first", "p.last"), coverage, block)


def piece_histogram(pieces: DataFrame, coverage: DataFrame, block: int) -> DataFrame:
    """The same over linear pieces (sample, scaf, cand_id, first, last)."""
    number = lambda c: F.floor((F.col(c) - 1) / block)
    touched = pieces.withColumn("block", F.explode(F.sequence(number("first"), number("last"))))
    inside = (F.col("first") <= F.col("block") * block + 1) & (F.col("last") >= (F.col("block") + 1) * block)
    touched = touched.withColumn("whole", inside)
    blocked = coverage.withColumn("block", number("pos"))
    counts = blocked.groupBy(*KEYS, "block", "iso", "anc").agg(F.count("*").alias("n"))
    whole = touched.filter("whole").join(counts, [*KEYS, "block"]).select("sample", "cand_id", "iso", "anc", "n")
    ends = touched.filter("NOT whole").join(blocked, [*KEYS, "block"]).filter("pos BETWEEN first AND last").select("sample", "cand_id", "iso", "anc", F.lit(1).cast("long").alias("n"))
    return whole.unionByName(ends).groupBy("sample", "cand_id", "iso", "anc").agg(F.sum("n").alias("n"))


def mask_zero(histogram: DataFrame) -> DataFrame:
    """Positions count where the ancestor has coverage, or the isolate where there is no ancestor."""
    return histogram.filter(F.coalesce("anc", "iso") > 0)


def amplicon_averages(histogram: DataFrame, scaffolds: DataFrame, method: str = "median") -> DataFrame:
    """sample, cand_id, iso_scaf_avg, anc_scaf_avg, iso_amplicon_avg, anc_amplicon_avg, avg_norm_cov, by ``method`` (median, mean
    or mode) over the positions that count. scaffolds: sample, cand_id, iso_scaf_avg, anc_scaf_avg. A candidate without such a
    position has nulls. Modes are those of distribution_mode, over positive values."""
    keys = ["sample", "cand_id"]
    rows = mask_zero(histogram).join(scaffolds, keys)
    scale = F.try_divide(F.col("iso_scaf_avg"), F.col("anc_scaf_avg"))
    rows = rows.withColumn("ratio", F.try_divide(F.try_divide(F.col("iso").cast("double"), F.col("anc")), scale))
    values = {"iso": "iso_amplicon_avg", "anc": "anc_amplicon_avg", "ratio": "avg_norm_cov"}
    if method == "mode":
        out = scaffolds
        for value, name in values.items():
            counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("x")).agg(F.sum("n").alias("n"))
            out = out.join(distribution_mode(counts, keys).withColumnRenamed("average", name), keys, "left")
        return out
    # a mean over the positions that have the value: ratios may be null
    one = median_of if method == "median" else lambda v: F.try_divide(F.sum(F.col(v) * F.col("n")), F.sum(F.when(F.col(v).isNotNull(), F.col("n"))).cast("double"))
    found = rows.groupBy(*keys).agg(*[one(v).alias(n) for v, n in values.items()])
    return scaffolds.join(found, keys, "left")


class Scaffold:
    """Coverage of one scaffold, by position: pos, iso and anc (NaN: null); 24 bytes a position."""

    def __init__(self, pos: np.ndarray, iso: np.ndarray, anc: np.ndarray):
        self.pos, self.iso, self.anc, self.kept = pos, iso, anc, {}

    def once(self, name: str, make: Callable):
        """What ``make`` gave at the first call with this name."""
        if name not in self.kept:
            self.kept[name] = make()
        return self.kept[name]

    def masked(self) -> Scaffold:
        """The positions that count, as mask_zero has it."""

        def make() -> Scaffold:
            counts = np.where(np.isnan(self.anc), self.iso, self.anc) > 0
            return Scaffold(self.pos[counts], self.iso[counts], self.anc[counts])

        return self.once("masked", make)

    def values(self, name: str, block: int) -> ranges.Values:
        """Of iso, anc, or their ratio."""

        def make() -> ranges.Values:
            return ranges.Values(getattr(self, name) if name != "ratio" else np.divide(self.iso, self.anc, out=np.full(len(self.pos), np.nan), where=self.anc != 0), block)

        return self.once(name, make)

    def average(self, name: str, method: str) -> float:
        def make() -> float:
            distinct, n = np.unique(getattr(self, name)[~np.isnan(getattr(self, name))], return_counts=True)
            return float(ranges.AVERAGES[method](distinct, n[None, :])[0])

        return self.once(f"average {name}", make)

    def between(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index ranges of pieces."""
        low = np.searchsorted(self.pos, first, "left")
        return low, np.maximum(low, np.searchsorted(self.pos, last, "right"))


def beside_coverage(candidates: DataFrame, coverage: DataFrame, work: Callable[..., Iterator], schema: str, scaffold_method: str | None, most: int = CANDIDATES) -> DataFrame:
    """sample, cand_id and what ``work`` makes of each candidate beside its scaffold.

    candidates: sample, scaf, cand_id, pieces (array of no, one or two struct(first, last)), with iso_scaf_avg and
    anc_scaf_avg unless ``scaffold_method`` says how to take them from the scaffold's coverage. ``work`` gets a Scaffold,
    first and last of the pieces (two columns, an empty piece where there is none), and both averages, and yields (numbers of
    candidates, values of schema's columns, NaN for null). Coverage and candidates are shuffled once, by scaffold, and no result is. Where a scaffold
    has more than ``most`` candidates, they are dealt over several tasks.
    """
    out_type = StructType([candidates.schema["sample"], candidates.schema["cand_id"], *StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(out_type)
    many = candidates.groupBy(*KEYS).agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    many = F.broadcast(many.select(*KEYS, F.ceil(F.col("_n") / most).cast("int").alias("_parts")))
    parts, none, whole = F.coalesce("_parts", F.lit(1)), F.lit(None), lambda c: F.coalesce(c, F.lit(0)).cast("long")
    piece = lambda i, name: F.get("pieces", F.lit(i))[name]
    averages = [F.col(c).cast("double") if scaffold_method is None else none.cast("double") for c in ("iso_scaf_avg", "anc_scaf_avg")]
    asked = candidates.join(many, KEYS, "left").select(
        *KEYS, F.pmod(F.xxhash64("cand_id"), parts).cast("int").alias("_part"), F.lit(True).alias("_asked"), F.coalesce(piece(0, "first"), F.lit(1)).cast("long").alias("_first"),
        averages[0].alias("_iso"), averages[1].alias("_anc"), "cand_id", whole(piece(0, "last")).alias("_last"), F.coalesce(piece(1, "first"), F.lit(1)).cast("long").alias("_first2"), whole(piece(1, "last")).alias("_last2"),
    )
    given = coverage.filter(F.col("sample").isNotNull() & F.col("scaf").isNotNull()).join(many, KEYS, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        *KEYS, "_part", F.lit(False).alias("_asked"), F.col("pos").cast("long").alias("_first"), F.col("iso").cast("double").alias("_iso"), F.col("anc").cast("double").alias("_anc"),
        none.cast(candidates.schema["cand_id"].dataType).alias("cand_id"), *[none.cast("long").alias(c) for c in ("_last", "_first2", "_last2")],
    )
    # the hash orders scaffolds at once; where two share one, the keys follow
    place = F.xxhash64(*KEYS, "_part")
    rows = given.union(asked).withColumn("_place", place).repartition("_place").sortWithinPartitions("_place", *KEYS, "_part", "_asked", "_first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, scaffold = None, [], None
        for batch in batches:
            keys = [batch.column(c) for c in (*KEYS, "_part", "_asked")]
            changed = np.ones(len(batch), bool)
            changed[1:] = np.any([pc.fill_null(pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)), True).to_numpy(zero_copy_only=False) for k in keys], axis=0)
            starts = np.flatnonzero(changed)
            number, iso, anc, last, first2, last2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_first", "_iso", "_anc", "_last", "_first2", "_last2"))
            for a, b in zip(starts, np.append(starts[1:], len(batch)), strict=True):
                *key, is_asked = (k[a].as_py() for k in keys)
                if key != held:
                    held, parts, scaffold = key, [], None
                if not is_asked:
                    parts.append((number[a:b], iso[a:b], anc[a:b]))
                    continue
                if scaffold is None:
                    scaffold = Scaffold(*(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3)))
                    parts = []
                if scaffold_method is None:
                    over = iso[a:b], anc[a:b]
                else:
                    over = tuple(np.full(b - a, scaffold.average(c, scaffold_method)) for c in ("iso", "anc"))
                first, to = (np.stack([x[a:b], y[a:b]], axis=1).astype(np.int64) for x, y in ((number, first2), (last, last2)))
                for owner, values in work(scaffold, first, to, *over):
                    at = pa.array(owner + a)
                    made = [pa.array(v, f.type, from_pandas=True) for v, f in zip(values, list(arrow)[2:], strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("sample").take(at), batch.column("cand_id").take(at), *made], schema=arrow)

    return rows.mapInArrow(run, out_type)


def over(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x / y, NaN where y is zero."""
    return np.divide(x, y, out=np.full(len(x), np.nan), where=y != 0)


def segment_pieces(candidates: DataFrame) -> DataFrame:
    """Candidates (start, end, length of the scaffold; a segment may wrap around the origin) with pieces."""
    return candidates.withColumn("pieces", coords.linear_pieces(F.col("start"), F.col("end"), F.col("length")))


def segment_averages(candidates: DataFrame, coverage: DataFrame, method: str = "median", scaffold_method: str | None = None, block: int = 4096, most: int = CANDIDATES) -> DataFrame:
    """The columns of amplicon_averages, for candidates (sample, scaf, cand_id, start, end, length) and coverage, and the same
    values: averages by ``method``, of scaffolds by ``scaffold_method`` (the same where it is not given) over positions that have a value."""
    average = ranges.AVERAGES[method]

    def work(scaffold: Scaffold, first: np.ndarray, last: np.ndarray, iso_avg: np.ndarray, anc_avg: np.ndarray):
        used, scale = scaffold.masked(), over(iso_avg, anc_avg)
        values = {name: used.values(name, block) for name in ("iso", "anc", "ratio")}
        step = min(v.rows_at_once() for v in values.values())
        for a in range(0, len(first), step):
            low, high = used.between(first[a : a + step], last[a : a + step])
            found = {name: average(values[name].distinct, values[name].counts(low, high)) for name in ("iso", "anc")}
            # of one scaffold, all the same
            ratios, by = values["ratio"], scale[a]
            norm = average(ratios.distinct / by, ratios.counts(low, high)) if by > 0 else np.full(len(low), np.nan)
            yield np.arange(a, a + len(low)), [iso_avg[a : a + step], anc_avg[a : a + step], found["iso"], found["anc"], norm]

    schema = "iso_scaf_avg double, anc_scaf_avg double, iso_amplicon_avg double, anc_amplicon_avg double, avg_norm_cov double"
    return beside_coverage(segment_pieces(candidates), coverage, work, schema, scaffold_method or method, most)


def copy_numbers(rows: DataFrame) -> DataFrame:
    iso, anc = F.try_divide("iso_amplicon_avg", "iso_scaf_avg"), F.try_divide("anc_amplicon_avg", "anc_scaf_avg")
    return rows.withColumns({"iso_norm": iso, "anc_norm": anc, "copy_ratio": F.try_divide(iso, anc), "copy_number": F.coalesce(F.col("avg_norm_cov"), iso)})


def filter_copy_number(rows: DataFrame, rep: float = 1.5, deletion: float = 0.3) -> DataFrame:
    """Amplified or deleted candidates with a chosen element; unknown copy numbers stay."""
    cn = F.col("copy_number")
    return rows.filter(F.col("chosen_tn").isNotNull() & ~F.coalesce((cn >= deletion) & (cn < rep), F.lit(False)))


def profile_pieces(candidates: DataFrame, flank_fraction: float = 0.2) -> DataFrame:
    """Candidates with pieces: the window of each as linear pieces.

    It reaches over the segment and the reference elements at its ends (left_tn, right_tn: struct(start, end), where the
    columns are there and not null), and ``flank_fraction`` of that beyond. Without is_circular all scaffolds are
    circular: there the window goes around the origin, an element counts on the side of the origin where its end of the
    segment is, and a window as long as the scaffold is the scaffold once. On linear scaffolds the window is clipped, and
    an inverted segment has none.
    """
    start, end, length = F.col("start"), F.col("end"), F.col("length")
    circular = F.col("is_circular") if "is_circular" in candidates.columns else F.lit(True)
    reach = [start, F.when(circular & (start > end), end + length).otherwise(end)]  # beyond the length where it wraps
    for tn, at in zip(("left_tn", "right_tn"), list(reach), strict=True):
        if tn in candidates.columns:
            reach += [F.when(circular, x - length * F.round((x - at) / length).cast("long")).otherwise(x) for x in (F.col(tn)["start"], F.col(tn)["end"])]
    rows = candidates.filter(circular | (start <= end)).withColumns({"_low": F.least(*reach), "_high": F.greatest(*reach)})
    flank = F.floor((F.col("_high") - F.col("_low")) * flank_fraction)
    rows = rows.withColumns({"_first": F.col("_low") - flank, "_last": F.col("_high") + flank})
    whole = F.col("_last") - F.col("_first") + 1 >= length
    around = lambda x: F.pmod(x - 1, length) + 1
    clipped = coords.linear_pieces(F.greatest(F.lit(1), "_first"), F.least("_last", length), length)
    pieces = F.when(~circular, clipped).when(whole, coords.linear_pieces(F.lit(1), length, length)).otherwise(coords.linear_pieces(around(F.col("_first")), around(F.col("_last")), length))
    return rows.withColumn("pieces", pieces).drop("_low", "_high", "_first", "_last")


def profile_candidates(candidates: DataFrame, scaffolds: DataFrame | None, flank_fraction: float) -> DataFrame:
    """Candidates with their window's pieces, and with averages where scaffolds (sample, cand_id, iso_scaf_avg, anc_scaf_avg) has them."""
    wide = profile_pieces(candidates, flank_fraction)
    return wide if scaffolds is None else wide.join(scaffolds, ["sample", "cand_id"])


def coverage_profile(candidates: DataFrame, coverage: DataFrame, scaffolds: DataFrame | None, flank_fraction: float = 0.2, block: int = PROFILE_ROWS, most: int = CANDIDATES) -> DataFrame:
    """Rows to plot: positions of each candidate's window, values over the scaffold average, and their ratio, about ``block`` at
    a time. scaffolds: sample, cand_id, iso_scaf_avg, anc_scaf_avg; without them, medians of the scaffolds' coverage."""

    def work(scaffold: Scaffold, first: np.ndarray, last: np.ndarray, iso_avg: np.ndarray, anc_avg: np.ndarray):
        low, high = scaffold.between(first.ravel(), last.ravel())
        for owner, at in ranges.spread(low, high, block):
            for a in range(0, len(at), block):
                who, here = owner[a : a + block] // 2, at[a : a + block]
                iso, anc = over(scaffold.iso[here], iso_avg[who]), over(scaffold.anc[here], anc_avg[who])
                yield who, [scaffold.pos[here], iso, anc, over(iso, anc)]

    return beside_coverage(profile_candidates(candidates, scaffolds, flank_fraction), coverage, work, "pos long, iso_norm double, anc_norm double, ratio double", "median" if scaffolds is None else None, most)


def profile_limits(candidates: DataFrame, coverage: DataFrame, scaffolds: DataFrame | None, flank_fraction: float = 0.2, block: int = 4096, most: int = CANDIDATES) -> DataFrame:
    """sample, cand_id, low, high: limits for both samples' values over their scaffold averages (as in coverage_profile) in the candidate's window, the
    least first and the greatest 99th percentile with a margin of a tenth, low at least 0.1. From value histograms of blocks;
    positions are looked at in the blocks at the window's ends alone."""

    def work(scaffold: Scaffold, first: np.ndarray, last: np.ndarray, iso_avg: np.ndarray, anc_avg: np.ndarray):
        values = {name: scaffold.values(name, block) for name in ("iso", "anc")}
        step = min(v.rows_at_once() for v in values.values())
        for a in range(0, len(first), step):
            low, high = scaffold.between(first[a : a + step], last[a : a + step])
            covered = np.flatnonzero((high > low).any(axis=1))
            found = []
            for name, by in (("iso", iso_avg), ("anc", anc_avg)):
                found.append([over(x, by[a + covered]) for x in ranges.percentiles(values[name].distinct, values[name].counts(low[covered], high[covered]), (0.01, 0.99))])
            yield a + covered, [np.fmin(found[0][0], found[1][0]), np.fmax(found[0][1], found[1][1])]  # nulls are left out

    found = beside_coverage(profile_candidates(candidates, scaffolds, flank_fraction), coverage, work, "low double, high double", "median" if scaffolds is None else None, most)
    return found.select("sample", "cand_id", F.greatest(F.col("low") / 1.1, F.lit(0.1)).alias("low"), (F.col("high") * 1.1).alias("high"))
