"""A Merkle manifest of a dataset: leaves of rows, a tree for each group (``lang``), and a tree over the groups' roots.

Leaf places come from bitmaps, without sorting rows. The doc_ids of each group are merged into bitmaps of 64 ids a word
(only words that hold an id are kept), with popcount directories above them: a count for each word, for each 2^16, 2^32
and 2^48 ids. A row's rank in its group is the sum of what its directories have before it, plus the population count of
its word's bits below its own. Each directory is summed under its parent, so no window holds more than 65,536 rows.

Leaves then go into keyed slot arrays, (group, slot div 1024): an array holds its leaves by slot, is reduced ten levels
at once, and hands its root to the next array; a tree over n leaves takes log n / 10 rounds. Paths come down the same
arrays: each gets its own path from the array above, one row per array, and writes its leaves' paths.

Hashes are lowercase hex SHA-256 of the inputs' texts one after another. Null values are written ``-``; a null doc_id
comes first in its group, and a null group before the others. Rows with equal group and doc_id are all leaves, in the
order of their leaf hashes: in words that hold such rows the directories go on with doc_id, 16 bits of the leaf, the leaf
and the task that wrote it, so that a third of all rows may share an id. Rows that are equal throughout change nothing
by their order. A group of one leaf has that leaf for its root, a lone last node of a level is hashed by itself. An
empty table gives no rows. Columns other than the five that are hashed are not read, so their names are free; texts may
be of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from junctionflow.llm.common import Tables, documents, release

#: Levels that an array of slots is reduced at once; it holds so many powers of two of them.
LEVELS = 10
#: The case of tampering that the query tries: one more character in rows whose id's checksum this number divides.
TAMPERED = 7


def _field(value: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(value.cast("string")).cast("string"), F.lit(":"), value.cast("string")), F.lit("-"))


def leaf(n_chars: Column | None = None) -> Column:
    """The hash (binary) of a row of documents; ``n_chars`` instead of its own."""
    values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") if n_chars is None else n_chars, F.col("text")]
    return F.unhex(F.sha2(F.concat(*map(_field, values)).cast("binary"), 256))


def leaves(docs: DataFrame, **payload: Column) -> DataFrame:
    """group, id, named, row, leaf, payload: a row for each document. ``group`` is never null and sorts as lang does."""
    own = docs.select("doc_id", "source", "lang", "n_chars", "text")
    return own.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("group"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.col("doc_id").isNotNull().alias("named"), F.monotonically_increasing_id().alias("row"), leaf().alias("leaf"), F.struct("doc_id", *[c.alias(k) for k, c in payload.items()]).alias("payload"),
    )


def places(counts: DataFrame, within: list[str], levels: list[list[Column | str]]) -> DataFrame:
    """``counts`` (a row for each value, n rows each) with ``place``, the rows of the same ``within`` before it, and
    ``total``, all of them. ``levels`` name the value's parts from coarse to fine: sums are made of the values that share
    all coarser parts, one level below the other."""
    parts = [[f"_{i}_{j}" for j in range(len(level))] for i, level in enumerate(levels)]
    named = counts.select("*", *[(F.col(c) if isinstance(c, str) else c).alias(p) for level, names in zip(levels, parts, strict=True) for c, p in zip(level, names, strict=True)])
    out = None
    for i, names in enumerate(parts):
        above = [*within, *[p for level in parts[:i] for p in level]]
        last = i == len(parts) - 1
        level = named if last else named.groupBy(*above, *names).agg(F.sum("n").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(*above).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        if out is None:
            level = level.withColumn("place", before).withColumn("total", F.sum("n").over(Window.partitionBy(*above)))
        else:
            level = level.withColumn("_before", before).join(out, above).withColumn("place", F.col("place") + F.col("_before")).drop("_before")
        out = level if last else level.drop("n")
    return out.drop(*[p for level in parts for p in level])


def slots(rows: DataFrame, tables: Tables) -> DataFrame:
    """rows of ``leaves`` with ``slot``, the rank of each in its group, and ``total``, the group's leaves."""
    bit = F.col("id").bitwiseAND(63).cast("int")
    word = F.shiftright("id", 6)
    words = tables.write(rows.groupBy("group", word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"), F.count("*").alias("n")))
    directory = tables.write(places(words, ["group"], [[F.shiftright("word", 42)], [F.shiftright("word", 26)], [F.shiftright("word", 10)], ["word"]]))
    found = rows.withColumn("word", word).join(directory.withColumnRenamed("n", "_n"), ["group", "word"])
    alone = F.col("_n") == F.bit_count("bits")
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))))
    single = found.filter(alone).withColumn("slot", F.col("place") + below)
    shared = found.filter(~alone)  # words that hold an id of several rows
    task, key = F.shiftright("row", 33), ["group", "word", "id", "named", "leaf", "task"]
    runs = shared.withColumn("task", task).groupBy(*key).agg(F.count("*").alias("n"))
    runs = places(runs, ["group", "word"], [["id", "named"], [F.substring("leaf", 1, 2)], ["leaf", "task"]])
    runs = runs.select(*key, F.col("place").alias("_run"))
    shared = shared.withColumn("task", task).withColumn("_at", F.row_number().over(Window.partitionBy(*key).orderBy("row")) - 1)
    shared = shared.join(runs, key).withColumn("slot", F.col("place") + F.col("_run") + F.col("_at"))
    names = [*rows.columns, "slot", "total"]
    return single.select(names).unionByName(shared.select(names))


def _h(*nodes: bytes) -> bytes:
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


def _reduced(nodes: list[bytes], total: int, levels: int) -> list[list[bytes]]:
    """The levels of an array, its nodes first; ``total``: the nodes of the whole level that the array is part of."""
    out = [nodes]
    while total > 1 and len(out) <= levels:
        last = out[-1]
        out.append([_h(*last[i : i + 2]) for i in range(0, len(last), 2)])
        total = (total + 1) // 2
    return out


def _in_order(slot: pa.Array, digest: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    order = np.argsort(slot.to_numpy())
    return order, digest.take(pa.array(order)).to_pylist()


def _over_arrays(df: DataFrame, out_type: StructType, per_array: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``per_array(row of one array as an Arrow batch) -> columns of out_type``."""
    arrow = to_arrow_schema(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(per_array(batch.slice(i, 1)), schema=arrow)
        release()

    return df.mapInArrow(run, out_type)


def arrays(nodes: DataFrame, levels: int) -> DataFrame:
    """key, block, total, items, root: slot arrays of nodes (key, slot, total, digest, payload), reduced."""
    packed = nodes.groupBy("key", F.shiftright("slot", levels).alias("block")).agg(F.first("total").alias("total"), F.collect_list(F.struct("slot", "digest", "payload")).alias("items"))

    def per_array(row: pa.RecordBatch) -> list[pa.Array]:
        items = row.column(3).flatten()
        _, digests = _in_order(items.field("slot"), items.field("digest"))
        return [*row.columns, pa.array([_reduced(digests, row.column(2)[0].as_py(), levels)[-1][0]], pa.binary())]

    return _over_arrays(packed, StructType([*packed.schema.fields, *StructType.fromDDL("root binary").fields]), per_array)


def trees(nodes: DataFrame, tables: Tables, levels: int = LEVELS) -> list[DataFrame]:
    """The arrays of all rounds, the leaves' first; the last round has one array for each key, whose root is the key's."""
    out = [tables.write(arrays(nodes, levels))]
    most = out[0].agg(F.max("total")).head()[0] or 0
    while most > 1 << levels:
        most = -(-most >> levels)
        up = F.ceil(F.col("total") / (1 << levels)).cast("long")
        out.append(tables.write(arrays(out[-1].select("key", F.col("block").alias("slot"), up.alias("total"), F.col("root").alias("digest"), F.lit(True).alias("payload")), levels)))
    return out


def paths(rounds: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """key, slot, digest, payload, path and the columns of ``above`` (key, path and others): a row for each leaf.

    A path has a byte for each level, 0 for a lone node, 1 where the sibling stands on the right and 2 on the left,
    followed by the sibling's digest, from the leaf to the root."""
    more = [f for f in above.schema.fields if f.name not in ("key", "path")]
    for i, table in reversed(list(enumerate(rounds))):
        upper = above if i == len(rounds) - 1 else above.withColumnRenamed("slot", "block").drop("digest", "payload")
        joined = table.drop("root").join(upper, ["key"] if i == len(rounds) - 1 else ["key", "block"]).select("key", "block", "total", "items", "path", *[f.name for f in more])
        items = joined.schema["items"].dataType.elementType
        out_type = StructType([joined.schema["key"], items["slot"], items["digest"], items["payload"], joined.schema["path"], *[joined.schema[f.name] for f in more]])
        above = _over_arrays(joined, out_type, partial(_descended, reduce=levels))
    return above


def _descended(row: pa.RecordBatch, reduce: int) -> list[pa.Array]:
    items = row.column(3).flatten()
    order, digests = _in_order(items.field("slot"), items.field("digest"))
    levels, upper, found = _reduced(digests, row.column(2)[0].as_py(), reduce), row.column(4)[0].as_py(), [b""] * len(order)
    for place, i in enumerate(order.tolist()):
        steps = []
        for level in levels[:-1]:
            other = place ^ 1
            steps.append(b"\0" if other >= len(level) else (b"\1" if place < other else b"\2") + level[other])
            place >>= 1
        found[i] = b"".join(steps) + upper
    same = pa.array(np.zeros(len(order), np.int64))
    payload = items.field("payload")
    return [row.column(0).take(same), items.field("slot"), items.field("digest"), payload, pa.array(found, pa.binary()), *[c.take(same) for c in row.columns[5:]]]


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """payload, leaf, slot, path, subroot, root (all binary but slot): a row for each row of ``leaves``."""
    with Tables(rows.sparkSession) as tables:
        written = tables.write(rows)
        ranked = slots(written, tables)
        own = trees(ranked.select(F.col("group").alias("key"), "slot", "total", F.col("leaf").alias("digest"), "payload"), tables, levels)
        tables.drop(written)
        groups = tables.write(own[-1].select(F.col("key").alias("group"), "root", F.lit(1).cast("long").alias("n")))
        ranks = places(groups, [], [[F.substring(F.col("group").cast("binary"), 1, 3)], ["group"]])
        top = trees(ranks.select(F.lit("").alias("key"), F.col("place").alias("slot"), "total", F.col("root").alias("digest"), F.struct("group").alias("payload")), tables, levels)
        root = top[-1].select("key", F.lit(b"").alias("path"), "root")
        above = paths(top, root, levels).select(F.col("payload.group").alias("key"), "path", F.col("digest").alias("subroot"), "root")
        above = tables.keep(tables.write(above))
        for table in own:
            tables.keep(table)
    return paths(own, above, levels).select("payload", F.col("digest").alias("leaf"), "slot", "path", "subroot", "root")


def folded(proofs: DataFrame, claimed: str) -> DataFrame:
    """proofs with ``folded_root``, which the column ``claimed`` (a leaf) and the path give, and ``proof_sha256``, the hash
    of the path's siblings in turn."""
    out_type = StructType([*proofs.schema.fields, StructField("folded_root", proofs.schema[claimed].dataType), StructField("proof_sha256", proofs.schema[claimed].dataType)])
    arrow = to_arrow_schema(out_type)

    def fold(node: bytes, path: bytes) -> tuple[bytes, bytes]:
        at, siblings = 0, []
        while at < len(path):
            side, other = path[at], path[at + 1 : at + 33]
            if side:
                siblings.append(other)
                node = _h(node, other) if side == 1 else _h(other, node)
            else:
                node = _h(node)
            at += 33 if side else 1
        return node, _h(*siblings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fold(n, p) for n, p in zip(batch.column(batch.schema.get_field_index(claimed)).to_pylist(), batch.column(batch.schema.get_field_index("path")).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([x[i] for x in found], pa.binary()) for i in range(2)]], schema=arrow)
        release()

    return proofs.mapInArrow(run, out_type)


def tamper_report(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The query's columns: proofs of all rows, those of tampered rows folded from the tampered leaf."""
    tampered = F.col("n_chars").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0)
    rows = leaves(docs, claimed=F.when(tampered, leaf(F.col("n_chars") + 1)))
    proofs = manifest(rows, levels).withColumn("claimed", F.coalesce("payload.claimed", "leaf"))
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return folded(proofs, "claimed").select("payload.doc_id", text("leaf"), text("subroot"), text("root"), text("proof_sha256"), text("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tamper_report(documents(spark, sf_dir))
