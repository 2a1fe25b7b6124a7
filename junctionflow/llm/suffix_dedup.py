"""Suffix-array dedup: every byte goes that is covered by a string of ``length`` bytes which also starts elsewhere.

A suffix is known by its first ``length`` bytes. Sorting the suffixes of all bytes would move the corpus many times
over, so suffixes that cannot matter are set aside first, without losing any:

1. Each start chooses an anchor, the part of ``core`` bytes with the least hash in its string; equal strings choose
   alike. Starts in a row with one anchor make a stretch.
2. Stretches are range-partitioned over sampled splitters by anchor and content, buckets are sorted locally by multikey
   quicksort and neighbours compared, across boundaries too. A stretch whose anchor nobody shares goes. One whose whole
   content (anchor, place in the stretch, bytes) occurs again is a repeat as it stands, however many copies there are.
3. Only stretches that share an anchor but differ remain, one of each content. Their suffixes are range-partitioned
   over sampled splitters by leading bytes (ties by the rest, then by place, so that one frequent string may span many
   buckets); each bucket is sorted locally by multikey quicksort, neighbours are compared, and the first and last
   suffixes of the buckets are compared across boundaries.

Stretches are equal by 128 bits of hashes, suffixes by their first eight bytes and a 64-bit hash of all.

Strings never cross documents. Nulls and texts shorter than ``length`` lose nothing. Equal rows repeat each other like
any other copies. An empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctionflow.llm.common import Tables, any_columns, documents, keyed, over_batches, release, rewrite, signed, utf8
from junctionflow.llm.rolling import anchors, window_hashes

LENGTH, CORE_SHARE = 400, 0.75
#: Stretches or suffixes that are sorted in one bucket.
BUCKET_ROWS = 400_000
#: Starts of a text that are looked at together; a stretch ends where these end.
BLOCK = 1 << 20


def stretches(docs: DataFrame, length: int) -> DataFrame:
    """core, whole, id, tie, first, last: each stretch of starts, with the hashes of its anchor and its whole content."""
    core = max(1, int(length * CORE_SHARE))

    def per_batch(id, tie, text):  # noqa: A002
        out: dict[str, list] = {"core": [], "whole": [], "id": [], "tie": [], "first": [], "last": []}
        for i, t, x in zip(id, tie, text, strict=True):
            for at in range(0, len(x) - length + 1, BLOCK):
                block = x[at : at + BLOCK + length - 1]
                place, first, last, content = anchors(np.frombuffer(block, np.uint8), length, core)
                # the seed tells where in the stretch the anchor stands
                whole = np.array([xxhash.xxh3_64_intdigest(block[a:b], s) for a, b, s in zip(first.tolist(), (last + length).tolist(), (place - first).tolist(), strict=True)], np.uint64)
                for name, values in zip(out, (signed(content), signed(whole), np.full(len(first), i), np.full(len(first), t), first + at, last + at), strict=True):
                    out[name].append(values)
        return {k: np.concatenate(v) for k, v in out.items()} if out["id"] else None

    source = keyed(docs).select(F.col("__id").alias("id"), F.col("__tie").alias("tie"), utf8().alias("text"))
    return over_batches(source, per_batch, "core long, whole long, id long, tie long, first int, last int")


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by the first key, then, only where rows tie so far, by the next key."""
    order = np.argsort(keys[0], kind="quicksort")
    for depth in range(1, len(keys)):
        differ = np.zeros(len(order), bool)
        differ[:1] = True
        for k in keys[:depth]:
            differ[1:] |= k[order[1:]] != k[order[:-1]]
        run = np.cumsum(differ)
        tied = np.flatnonzero(np.bincount(run)[run] > 1)
        if not len(tied):
            break
        order[tied] = order[tied][np.lexsort((keys[depth][order[tied]], run[tied]))]
    return order


def _bucket(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """The rows of one bucket, of BUCKET_ROWS or so."""
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of rows with equal keys begin, in sorted order."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


#: kind: a copy (of whole content), wanted for the sorting of suffixes, or open: a content at an end of a bucket.
COPY, WANTED, OPEN = 0, 1, 2
_JUDGED = "kind int, core long, whole long, n long, id long, tie long, first int, last int"


def sorted_stretches(every: DataFrame, buckets: int) -> DataFrame:
    """kind, ...: what the sorted buckets of stretches tell. Of the anchors at the two ends of a bucket, whose stretches
    may go on in the next one, every content is given with the count that it has here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _bucket(batches)
        if table is None:
            return
        keys = [table[c].to_numpy() for c in ("core", "whole", "id", "tie", "first")]
        order = multikey_order(keys)
        core, whole = keys[0][order], keys[1][order]
        content = _starts(core, whole)
        n = np.diff(np.r_[content, len(order)])
        anchor = _starts(core[content])  # among the contents
        contents = np.diff(np.r_[anchor, len(content)])
        edge = np.zeros(len(anchor), bool)
        edge[[0, -1]] = True
        mixed = ~edge & (contents > 1) & (np.minimum.reduceat(n, anchor) == 1)
        for kind, rows, count in (
            (COPY, np.flatnonzero(np.repeat(n > 1, n)), None),
            (WANTED, content[np.repeat(mixed, contents)], n[np.repeat(mixed, contents)]),
            (OPEN, content[np.repeat(edge, contents)], n[np.repeat(edge, contents)]),
        ):
            out = table.take(pa.array(order[rows]))
            columns = [np.full(len(rows), kind, np.int32), out["core"], out["whole"], np.full(len(rows), 2) if count is None else count, *(out[c] for c in ("id", "tie", "first", "last"))]
            yield from pa.table(columns, names=["kind", "core", "whole", "n", "id", "tie", "first", "last"]).to_batches()
        release()

    return every.repartitionByRange(buckets, "core", "whole", "id", "tie", "first").mapInArrow(run, _JUDGED)


def suffixes(parts: DataFrame, length: int) -> DataFrame:
    """lead, rest, id, tie, place, alone: a row for each start of the stretches in ``parts``."""

    def explode(id, tie, first, alone, part):  # noqa: A002
        starts = np.array([len(x) - length + 1 for x in part])
        at = np.cumsum([0, *[len(x) for x in part]])[:-1]
        data = np.frombuffer(b"".join(part) + bytes(7), np.uint8)
        within = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
        rows = np.repeat(at, starts) + within
        lead = np.zeros(len(rows), np.uint64)
        for k in range(8):
            lead <<= np.uint64(8)
            if k < length:
                lead |= data[rows + k]
        rest = window_hashes(data[: len(data) - 7], length)[rows]
        each = lambda values, kind: np.repeat(np.array(values, kind), starts)
        return {"lead": signed(lead ^ np.uint64(1 << 63)), "rest": signed(rest), "id": each(id, np.int64), "tie": each(tie, np.int64), "place": each(first, np.int64) + within, "alone": each(alone, bool)}

    return over_batches(parts, explode, "lead long, rest long, id long, tie long, place int, alone boolean")


def parts_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """id, tie, first, alone, part: the bytes of the ``wanted`` stretches (id, tie, first, last, alone)."""
    lists = wanted.groupBy(F.col("id").alias("__id"), F.col("tie").alias("__tie")).agg(F.collect_set(F.struct("first", "last", "alone")).alias("wanted"))

    def cut(__id, __tie, text, wanted):
        out: dict[str, list] = {"id": [], "tie": [], "first": [], "alone": [], "part": []}
        for i, t, x, stretches in zip(__id, __tie, text, wanted, strict=True):
            for s in stretches:
                for name, value in zip(out, (i, t, s["first"], s["alone"], x[s["first"] : s["last"] + length]), strict=True):
                    out[name].append(value)
        return out

    return over_batches(keyed(docs).select("__id", "__tie", utf8().alias("text")).join(lists, ["__id", "__tie"]), cut, "id long, tie long, first int, alone boolean, part binary")


_FOUND = "lead long, rest long, id long, tie long, place int, alone boolean, edge boolean"


def sorted_repeats(rows: DataFrame, buckets: int, tables: Tables) -> DataFrame:
    """id, tie, place of the lone suffixes that equal another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _bucket(batches)
        if table is None:
            return
        lead, rest, alone = (table[c].to_numpy() for c in ("lead", "rest", "alone"))
        order = multikey_order([lead, rest])
        lead, rest, alone = lead[order], rest[order], alone[order]
        same = np.r_[False, (lead[1:] == lead[:-1]) & (rest[1:] == rest[:-1]), False]
        repeated = same[1:] | same[:-1]
        edge = np.zeros(len(order), bool)
        edge[[0, -1]] = True
        keep = np.flatnonzero((repeated & alone) | edge)
        # an edge row that has a partner here is a repeat already, and its edge copy only speaks for its string
        out = table.take(pa.array(order[keep])).select(["lead", "rest", "id", "tie", "place", "alone"])
        for wanted, flag in ((repeated[keep] & alone[keep], False), (edge[keep], True)):
            part = out.filter(pa.array(wanted))
            yield from part.append_column("edge", pa.array([flag] * part.num_rows)).to_batches()
        release()

    found = tables.write(rows.repartitionByRange(buckets, "lead", "rest", "id", "tie", "place").mapInArrow(run, _FOUND))
    edges = found.filter("edge")  # two rows a bucket at most
    shared = edges.groupBy("lead", "rest").agg(F.countDistinct("id", "tie", "place").alias("n")).filter("n > 1")
    return found.filter("NOT edge").select("id", "tie", "place").unionByName(edges.filter("alone").join(shared, ["lead", "rest"], "left_semi").select("id", "tie", "place"))


def repeated_starts(docs: DataFrame, tables: Tables, length: int = LENGTH) -> DataFrame:
    """__id, __tie, __starts: runs (first, last) of starts whose strings occur elsewhere too; they may overlap."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = tables.write(stretches(docs, length))
    judged = tables.write(sorted_stretches(every, max(least, -(-every.count() // BUCKET_ROWS))))
    tables.drop(every)
    stretch, copies, wanted = ["id", "tie", "first", "last"], judged.filter(F.col("kind") == COPY), judged.filter(F.col("kind") == WANTED)
    ends = judged.filter(F.col("kind") == OPEN)
    # a content that goes on over boundaries has a row in each bucket
    contents = tables.write(ends.groupBy("core", "whole").agg(F.sum("n").alias("n"), F.min(F.struct(*stretch)).alias("one")))
    differing = contents.groupBy("core").agg(F.count("*").alias("contents"), F.min("n").alias("least")).filter("contents > 1 AND least = 1").select("core")
    copies = copies.select(*stretch).unionByName(ends.filter("n = 1").join(contents.filter("n > 1").select("core", "whole"), ["core", "whole"], "left_semi").select(*stretch))
    alone = (F.col("n") == 1).alias("alone")
    wanted = tables.write(wanted.select(*stretch, alone).unionByName(contents.join(differing, "core", "left_semi").select("one.*", alone)))
    n = wanted.agg(F.sum(F.col("last") - F.col("first") + 1).alias("n")).head().n or 0
    parts = tables.write(parts_of(docs, wanted, length))
    found = sorted_repeats(suffixes(parts, length), max(least, -(-n // BUCKET_ROWS)), tables)
    tables.drop(parts)
    runs = copies.unionByName(found.select("id", "tie", F.col("place").alias("first"), F.col("place").alias("last")))
    starts = runs.groupBy(F.col("id").alias("__id"), F.col("tie").alias("__tie")).agg(F.collect_set(F.struct("first", "last")).alias("__starts"))
    return tables.keep(tables.write(starts))


def spans(starts: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The maximal runs of covered bytes, (start, end)."""
    out: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in starts or ()):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


def cut_spans(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *[b for _, b in gone]], [*[a for a, _ in gone], len(text)], strict=True)) if gone else text


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The columns of docs, the strings out of ``text``, with __spans that were cut and __sha256 of the bytes that are
    left. Bytes of a character that was cut apart count in __sha256 and are not in ``text``."""
    with Tables(docs.sparkSession) as tables:
        source = keyed(docs).join(repeated_starts(docs, tables, length), ["__id", "__tie"], "left")
    source = source.withColumn("__text", F.col("text").cast("binary")).drop("text", "__id", "__tie")

    def per_batch(__text, __starts):
        out: dict[str, list] = {"text": [], "__spans": [], "__sha256": []}
        for t, s in zip(__text, __starts, strict=True):
            gone = spans(s, length)
            left = cut_spans(t or b"", gone)
            for name, value in zip(out, (t if t is None else left.decode(errors="ignore"), [{"start": a, "end": b} for a, b in gone], hashlib.sha256(left).hexdigest()), strict=True):
                out[name].append(value)
        return out

    return rewrite(source, ["__text", "__starts"], per_batch, "text string, __spans array<struct<start: int, end: int>>, __sha256 string")


@any_columns
def dedup_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the same columns, repeated strings out of ``text``; ``n_chars``, where numeric, is counted anew."""
    out = remove_repeats(docs, length)
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    removed = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("__spans").cast("long").alias("n_spans"), F.col("__sha256").alias("kept_sha256"), "text")
