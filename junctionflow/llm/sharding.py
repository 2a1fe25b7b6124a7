"""Sharding by minimax contiguous partition, with DataFrame functions only.

Equal texts form atomic groups. Groups stand in the order of the 64-bit hash of their text, and 16 shards take
neighbouring runs of groups such that the largest shard is as small as it can be. The smallest feasible capacity is
found by binary search with a greedy check over the ordered group sizes, and within it the cuts are as even as they can. The check works on sums over bins of the hash
(2^16 rows at most); where a cut falls into a bin, that bin alone is opened into finer bins, down to single groups, so
the result is the exact optimum while the driver never sees more than a bounded number of sums.

A null text has no bytes and shares a group with other nulls; empty texts form a group too. Ties and repeated rows are
kept apart by their slots. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from junctionflow.llm.common import documents, materialise

SHARDS = 16
#: Bits of the hash by which a bin is opened, and rows that share a slot counter.
BIN_BITS, SLOT_ROWS = 16, 20_000


@dataclass(frozen=True)
class Atom:
    """Neighbouring groups that share the first ``bits`` bits of their key; ``whole`` if it is one group."""

    first_key: int
    size: int
    bits: int
    whole: bool


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, key."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("key"))


def capacity(sums: list[int], shards: int, loose: list[bool] | None = None) -> tuple[int, list[int], set[int]]:
    """Smallest capacity, the indices that start shards 1, 2, ..., and the loose atoms that were cut. Loose atoms may
    be cut anywhere. ``sums``: prefix sums of the atoms, from 0."""
    last = len(sums) - 1
    loose = loose or [False] * last

    def greedy(most: int) -> tuple[list[int], set[int]] | None:
        at, starts, cut = 0, [], set()
        for shard in range(shards):
            if at + most >= sums[-1]:
                return starts, cut
            i = bisect_right(sums, at + most) - 1  # the first atom that does not fit whole
            if loose[i]:
                cut.add(i)
                at += most
            elif sums[i] <= at:
                return None
            else:
                at = sums[i]
            starts.append(i)
        return None

    low, high = 0, sums[-1]
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if greedy(middle) is not None else (middle + 1, high)
    starts, cut = greedy(low) or ([], set())
    return low, starts, cut


def even_cuts(sums: list[int], shards: int, most: int) -> list[int]:
    """The indices that start shards 1, 2, ...: as near to equal sizes as groups allow, no shard over ``most``."""
    last = at = len(sums) - 1
    earliest = [0] * shards  # where a shard may start at the earliest for the rest to fit
    for k in range(shards - 1, 0, -1):
        at = earliest[k] = bisect_left(sums, sums[at] - most, 0, at)
    at, starts = 0, []
    for k in range(1, shards):
        low, high = max(earliest[k], at), bisect_right(sums, sums[at] + most) - 1
        share = sums[at] + (sums[last] - sums[at]) / (shards - k + 1)
        i = bisect_left(sums, share, low, high)
        at = i - 1 if i > low and share - sums[i - 1] <= sums[i] - share else i
        starts.append(at)
    return [i for i in starts if i < last]


def cut_keys(groups: DataFrame, shards: int = SHARDS, bin_bits: int = BIN_BITS) -> list[int]:
    """The first key of each shard but shard 0, for groups (key, size) with one row for each key."""

    def sums(where: Column, bits: int) -> list[Atom]:
        rows = groups.filter(where).groupBy(F.shiftright("key", 64 - bits).alias("bin")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy("bin").collect()
        return [Atom(r.bin << (64 - bits), r.size, bits, r.n == 1 or bits >= 64) for r in rows]

    atoms = sums(F.lit(True), bin_bits)
    while atoms:
        prefix = [0]
        for a in atoms:
            prefix.append(prefix[-1] + a.size)
        best, _, _ = capacity(prefix, shards)
        least, _, opened = capacity(prefix, shards, [not a.whole for a in atoms])
        if least == best:
            return [atoms[i].first_key for i in even_cuts(prefix, shards, best)]
        finer: dict[int, list[Atom]] = {}
        for bits in {atoms[i].bits for i in opened}:
            these = {atoms[i].first_key >> (64 - bits): i for i in opened if atoms[i].bits == bits}
            for a in sums(F.shiftright("key", 64 - bits).isin(list(these)), min(64, bits + bin_bits)):
                finer.setdefault(these[a.first_key >> (64 - bits)], []).append(a)
        atoms = [b for i, a in enumerate(atoms) for b in finer.get(i, [a])]
    return []


def assign(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """rows with shard and slot. Slots count through sub-buckets of a shard, so that no task holds a whole shard."""
    shard = F.lit(0)
    for key in cuts:
        shard = shard + (F.col("key") >= F.lit(key)).cast("int")
    buckets = min(4096, max(4, rows.count() // (SHARDS * SLOT_ROWS)))
    placed = rows.withColumn("shard", shard).withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "key"), F.lit(buckets)).cast("int"))
    counts = placed.groupBy("shard", "_bucket").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("shard", "_bucket", F.coalesce(before, F.lit(0)).alias("_first"))  # 4096 x shards rows at most
    nth = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("doc_id", "key")) - 1
    return placed.withColumn("_nth", nth).join(F.broadcast(first), ["shard", "_bucket"]).withColumn("slot", (F.col("_first") + F.col("_nth")).cast("long"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot."""
    rows = materialise(sized(docs))
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("size")))
    return assign(rows, cut_keys(groups, shards)).select("doc_id", "size", "text_crc32", "shard", "slot")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
