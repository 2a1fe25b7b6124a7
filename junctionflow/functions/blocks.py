"""A block store of sequences: windows are joined to the blocks that they touch, never to a whole scaffold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from junctionflow.functions import coords

#: Bases in a block.
BLOCK = 4096


def apart_by(*tables: DataFrame) -> list[str]:
    """The reference, where all tables have it."""
    return ["ref"] if all("ref" in t.columns for t in tables) else []


def sequence_blocks(scaffolds: DataFrame, block: int = BLOCK) -> DataFrame:
    """[ref,] scaf, block, bases: each scaffold (scaf, seq) cut into blocks from number 0 on."""
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / block).cast("int")), lambda i: F.substring(F.col("seq"), (i * block + 1).cast("int"), F.lit(block)))
    return scaffolds.filter(F.length("seq") > 0).select(*apart_by(scaffolds), "scaf", F.posexplode(pieces).alias("block", "bases"))


def window_sequences(windows: DataFrame, blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """windows (key, scaf [, ref], part, first, last: 1-based) as key, bases: the bases of a key's windows in the order of
    their parts. Windows that touch no block give no row."""
    number = lambda c: F.floor((F.col(c) - 1) / block).cast("int")
    touched = windows.withColumn("block", F.explode(F.sequence(number("first"), number("last"))))
    at = F.greatest(F.col("first") - F.col("block") * block, F.lit(1))
    piece = F.substring(F.col("bases"), at.cast("int"), (F.col("last") - F.col("block") * block - at + 1).cast("int"))
    rows = touched.join(blocks, [*apart_by(windows, blocks), "scaf", "block"]).select("key", F.struct("part", "block", piece.alias("bases")).alias("x"))
    return rows.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bases"]), "").alias("bases"))


def arm_sequences(arms: DataFrame, scaffolds: DataFrame, block: int = BLOCK) -> DataFrame:
    """[ref,] arm, arm_seq of the distinct arms (structs of coords.arm): the bases read away from the junction, around the
    origin of circular scaffolds; linear scaffolds end where they end."""
    apart = apart_by(arms, scaffolds)
    sizes = scaffolds.select(*apart, F.col("scaf").alias("_scaf"), F.length("seq").cast("long").alias("_n"), "is_circular")
    rows = arms.select(*apart, "arm").distinct().withColumn("_scaf", F.col("arm.scaf")).join(sizes, [*apart, "_scaf"]).filter("_n > 0")
    ends = [F.col("arm.start"), coords.arm_end(F.col("arm"))]
    low, high = F.least(*ends), F.greatest(*ends)
    around = lambda x: F.pmod(x - 1, F.col("_n")) + 1
    circular = coords.linear_pieces(around(low), around(high), F.col("_n"))
    clipped = coords.linear_pieces(F.greatest(low, F.lit(1)), F.least(high, F.col("_n")), F.col("_n"))
    pieces = F.when(F.col("is_circular"), circular).when((high >= 1) & (low <= F.col("_n")), clipped).otherwise(F.array().cast("array<struct<first: bigint, last: bigint>>"))
    windows = rows.select(F.struct(*apart, "arm").alias("key"), *apart, F.col("_scaf").alias("scaf"), F.posexplode(pieces).alias("part", "p")).select("key", *apart, "scaf", "part", "p.first", "p.last")
    found = window_sequences(windows, sequence_blocks(scaffolds, block), block)
    seq = F.when(F.col("key.arm.dir") >= 0, F.col("bases")).otherwise(coords.reverse_complement(F.col("bases")))
    return found.select(*[F.col(f"key.{c}").alias(c) for c in apart], F.col("key.arm").alias("arm"), seq.alias("arm_seq"))


def with_arm_sequences(rows: DataFrame, scaffolds: DataFrame, arms: dict[str, str], block: int = BLOCK) -> DataFrame:
    """rows with a sequence column for each arm column that ``arms`` names; rows whose arm has no bases go."""
    apart = apart_by(rows, scaffolds)
    every = None
    for column in arms:
        one = rows.select(*apart, F.col(column).alias("arm"))
        every = one if every is None else every.unionByName(one)
    found = arm_sequences(every, scaffolds, block)
    out = rows
    for column, name in arms.items():
        out = out.join(found.select(*apart, F.col("arm").alias(column), F.col("arm_seq").alias(name)), [*apart, column])
    return out.select(*rows.columns, *arms.values())


def junction_seq(first: Column, second: Column) -> Column:
    """The bases across a junction, from the sequence of the arm it is read along to that of the other."""
    return F.concat(coords.reverse_complement(first), second)
