"""Alignment of two tokenizers' tokens over the same bytes, and how often pairs of ids are linked in the corpus.

A is byte-level BPE over a blank and the text, B a sentencepiece model over the text (it puts the blank in front). The
tokens of both are byte ranges of the same string. Where a token of A and one of B end together is a cut: it ends a group
of tokens of both, and links the two tokens.

Documents of a batch are merged in lockstep: a NumPy vector holds each lane's place in A and in B, every step compares
all lanes' ends, notes a link where they are equal, and moves the pointer of the lesser end (both when equal); lanes that
are through are compacted away. Lanes are documents, long ones cut where both certainly end (before a blank between words), so no
lane is much longer than the others. Both tokenizers see each fragment between such places once and are remembered.

Counts of id pairs are made over all documents: each batch sends its distinct pairs, counts are summed by pair, and the
counts go back by batch. Nothing is broadcast, and a pair that all documents hold has one row a batch.

Without tokens are null and empty texts, those that are not UTF-8, and those whose tokens' bytes differ from blank and
text (say, a U+2581, which B turns into a blank). Rows are kept one to one, ties and repeats included, an empty table
gives no rows, and columns other than doc_id and text are not read, so their names are free.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from junctionflow.llm import boundaries
from junctionflow.llm.common import Tables, documents, over_batches, release, slices, utf8
from junctionflow.llm.fragment_bpe import encoder, token_bytes

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
REMEMBERED = 128 << 20
#: Fragments in a lane at most.
LANE = 48
#: Bytes of the texts that are merged together and whose distinct pairs are sent together, about.
BATCH_BYTES = 2 << 20


def piece_bytes(model) -> list[bytes]:
    """The bytes of each piece of a sentencepiece model by id."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, stop_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and B of the tokens that end together, in order. A lane starts at ``at_a`` and ``at_b`` and is through
    at ``stop_a``; in each lane the last tokens of A and B end together."""
    linked = np.full(len(ends_a), -1, np.int64)
    live = at_a < stop_a
    at_a, at_b, stop_a = at_a[live], at_b[live], stop_a[live]
    while len(at_a):
        a, b = ends_a[at_a], ends_b[at_b]
        equal = a == b
        linked[at_a[equal]] = at_b[equal]
        at_a = at_a + (a <= b)
        at_b = at_b + (b <= a)
        live = at_a < stop_a
        if not live.all():
            at_a, at_b, stop_a = at_a[live], at_b[live], stop_a[live]
    found = np.flatnonzero(linked >= 0)
    return found, linked[found]


class Aligner:
    def __init__(self, a: str = A, b: str = B, most: int = REMEMBERED):
        import sentencepiece

        self.a, self.b = encoder(a, False, 1 << 20), sentencepiece.SentencePieceProcessor(model_file=b)
        self.bytes_a, self.bytes_b = token_bytes(a), piece_bytes(self.b)
        self.len_a, self.len_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        absent = self.a.certain & boundaries.absent_pairs(t for i, t in enumerate(self.bytes_b) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)))
        self.certain = absent & (np.arange(256) == 32)  # before a blank only: B takes each fragment without it
        self.memory = boundaries.Memory(self._learn, most)

    def _learn(self, fragments: list[bytes]) -> list[tuple]:
        """Of each fragment, which starts with a blank: ids by A and by B, and whether both have its bytes. Many are
        encoded as one text; one by one where that text's bytes are not the tokens'."""
        out: list[tuple] = [()] * len(fragments)
        for run in boundaries.runs(fragments, self.certain):
            for i, found in zip(run, self._encoded([fragments[i] for i in run]), strict=True):
                out[i] = found
        return out

    def _encoded(self, some: list[bytes]) -> list[tuple]:
        whole = b"".join(some)
        a, b = self.a.encode_plain([whole])[0], self.b.encode(whole[1:].decode())
        if len(whole) == 1:  # B puts no blank before nothing
            b = [self.b.piece_to_id("▁")]
        same = b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b))
        if len(some) == 1:
            return [(array("i", a), array("i", b), same)]
        at, to = (boundaries.divided(a, self.len_a, some), boundaries.divided(b, self.len_b, some)) if same else (None, None)
        if at is None or to is None:
            return [x for f in some for x in self._encoded([f])]
        return [(array("i", a[i:j]), array("i", b[k:m]), True) for i, j, k, m in zip(at, at[1:], to, to[1:], strict=False)]

    def flat(self, texts: list[bytes], lane_fragments: int = LANE) -> tuple[np.ndarray, ...]:
        """ids by A and by B of all texts in turn, the places of the tokens that end together, and where each text's
        tokens of A, of B and its cuts start and the last one's end."""
        data, ends = boundaries.joined([b" " + t if t and _utf8(t) else b"" for t in texts])
        distinct, turn, first = boundaries.fragments(data, ends, boundaries.cuts(np.frombuffer(data, np.uint8), self.certain))
        known = self.memory.of(distinct)
        # fragments of documents whose bytes both tokenizers give
        wrong = np.append(0, np.cumsum(np.array([not k[2] for k in known], bool)[turn] if len(turn) else []))[first]
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        good = (np.diff(wrong) == 0)[doc]
        turn, doc = turn[good], doc[good]
        ids_a, per_a = _expand([k[0] for k in known], turn)
        ids_b, per_b = _expand([k[1] for k in known], turn)
        # lanes: runs of fragments of a document
        start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.empty(0, np.int64)
        place = np.arange(len(doc)) - np.repeat(start, np.diff(np.append(start, len(doc))))
        lane = np.flatnonzero(place % lane_fragments == 0)
        stop = per_a[np.append(lane[1:], len(doc))] if len(lane) else lane
        cut_a, cut_b = lockstep(np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b]), per_a[lane], per_b[lane], stop)
        bound = np.searchsorted(doc, np.arange(len(texts) + 1))
        return ids_a, ids_b, cut_a, cut_b, per_a[bound], per_b[bound], np.searchsorted(cut_a, per_a[bound])

    def of(self, texts: list[bytes], lane_fragments: int = LANE) -> tuple[list[np.ndarray], ...]:
        """ids by A, ids by B, and the tokens of A and of B up to each cut: four arrays for each text."""
        ids_a, ids_b, cut_a, cut_b, bound_a, bound_b, bound_c = self.flat(texts, lane_fragments)
        split = lambda x, at: [x[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        cuts_a = [x + 1 - s for x, s in zip(split(cut_a, bound_c), bound_a.tolist(), strict=False)]
        cuts_b = [x + 1 - s for x, s in zip(split(cut_b, bound_c), bound_b.tolist(), strict=False)]
        return split(ids_a, bound_a), split(ids_b, bound_b), cuts_a, cuts_b


def _utf8(text: bytes) -> bool:
    try:
        text.decode()
        return True
    except UnicodeDecodeError:
        return False


def _expand(ids: list[array], turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the fragments in turn, and where each fragment's start and the last one's end."""
    size = np.array([len(x) for x in ids], np.int64)
    flat, at = np.frombuffer(b"".join(x.tobytes() for x in ids), np.int32), np.append(0, np.cumsum(size))
    first = np.append(0, np.cumsum(size[turn])) if len(turn) else np.zeros(1, np.int64)
    return flat[np.repeat(at[turn] - first[:-1], size[turn]) + np.arange(first[-1])] if len(turn) else flat[:0], first


@lru_cache(maxsize=1)
def aligner(a: str, b: str) -> Aligner:
    """One memory for all tasks of a Python worker."""
    return Aligner(a, b)


def align(docs: DataFrame, a: str = A, b: str = B, lane: int = LANE) -> DataFrame:
    """doc_id, a_ids, b_ids, a_cuts, b_cuts: the tokens of every whole text, and how many of A's and of B's lie before
    each cut; group g holds the tokens between cuts g - 1 and g."""

    def per_batch(doc_id, text):
        return {"doc_id": doc_id} | dict(zip(("a_ids", "b_ids", "a_cuts", "b_cuts"), aligner(a, b).of(text, lane), strict=True))

    return over_batches(docs.select("doc_id", utf8().alias("text")), per_batch, "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>")


_BATCHES = "batch long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, pairs array<long>, counts array<long>"


@lru_cache(maxsize=1)
def _strings(size: int) -> pa.Array:
    """Decimal ids with a comma, a bar or a semicolon after each."""
    return pa.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(size)], pa.large_binary())


def group_strings(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size: int = 1 << 16) -> tuple[memoryview, np.ndarray]:
    """``a1,a2|b1;...`` of all groups, and where each token's string starts. Cuts are places of tokens."""
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[cut_a], last_b[cut_b] = True, True
    to = np.empty(len(a) + len(b), np.int32)
    to[np.arange(len(a)) + np.append(0, cut_b + 1)[np.cumsum(last_a) - last_a]] = a + size * last_a
    to[np.arange(len(b)) + np.append(cut_a + 1, 0)[np.cumsum(last_b) - last_b]] = b + 2 * size * last_b
    _, at, values = _strings(size).take(pa.array(to)).buffers()
    return memoryview(values) if values else memoryview(b""), np.frombuffer(at, np.int64)[: len(to) + 1] if len(to) else np.zeros(1, np.int64)


def with_pairs(docs: DataFrame, a: str = A, b: str = B, lane: int = LANE, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Documents aligned, a row for each: its number of tokens and groups, the digest of its groups, and its links as
    places in its batch's distinct pairs. The first document of each batch has those pairs (A's id times 65536 plus B's)
    and how many links of the batch hold each."""
    arrow = to_arrow_schema(StructType.fromDDL(_BATCHES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for rows in slices(whole, batch_bytes):
                ids_a, ids_b, cut_a, cut_b, to_a, to_b, to_c = aligner(a, b).flat(rows.column(1).to_pylist(), lane)
                text, place = group_strings(ids_a, ids_b, cut_a, cut_b)
                ends, n = place[to_a + to_b].tolist(), rows.num_rows
                pairs, links, counts = np.unique(ids_a[cut_a].astype(np.int64) * 65536 + ids_b[cut_b], return_inverse=True, return_counts=True)
                links, at = links.astype("<i4"), to_c.tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * n, pa.int64()), rows.column(0), pa.array(np.diff(to_a)), pa.array(np.diff(to_b)), pa.array(np.diff(to_c)),
                    pa.array([hashlib.sha256(text[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.string()),
                    pa.array([links[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    *[pa.array([x, *[None] * (n - 1)], pa.list_(pa.int64())) for x in (pairs, counts)],
                ], schema=arrow)
                number += 1
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).mapInArrow(run, _BATCHES)


def pair_counts(batched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """batch, place, pair, n: the distinct pairs of each batch; and pair, count, best: links of the corpus that hold each
    pair, and whether no pair with the same id of B has more. A window holds the ids of A that one id of B meets."""
    rows = batched.filter(F.col("pairs").isNotNull()).select("batch", F.posexplode(F.arrays_zip("pairs", "counts"))).select("batch", F.col("pos").alias("place"), F.col("col.pairs").alias("pair"), F.col("col.counts").alias("n"))
    total = rows.groupBy("pair").agg(F.sum("n").alias("count"))
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(65535))
    return rows, total.withColumn("best", F.col("count") == F.max("count").over(same_b))


def link_report(docs: DataFrame, a: str = A, b: str = B, lane: int = LANE, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    with Tables(docs.sparkSession) as tables:
        batched = tables.keep(tables.write(with_pairs(docs, a, b, lane, batch_bytes)))
    rows, totals = pair_counts(batched)
    back = rows.select("batch", "place", "pair").join(totals, "pair").select(F.col("batch").alias("of_batch"), "place", "count", "best")
    report = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    arrow = to_arrow_schema(StructType.fromDDL(report))

    def per_group(docs: pa.Table, counts: pa.Table) -> pa.Table:
        place = counts["place"].to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], best[place] = counts["count"].to_numpy(), counts["best"].to_numpy()
        links = [np.frombuffer(x, "<i4") for x in docs["links"].to_pylist()]
        found = {"n_links": [len(x) for x in links], "n_best": [int(best[x].sum()) for x in links], "count_sum": [int(count[x].sum()) for x in links]}
        return pa.table([pa.array(found[f.name], f.type) if f.name in found else docs[f.name] for f in arrow], schema=arrow)

    told = batched.select("batch", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
    return told.groupBy("batch").cogroup(back.groupBy("of_batch")).applyInArrow(per_group, report)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_report(documents(spark, sf_dir))
