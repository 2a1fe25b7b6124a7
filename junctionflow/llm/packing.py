"""Packing by concatenating and cutting.

All documents stand one after another, each followed by an end id, and the stream is cut into windows of a fixed size.
Pass one tokenises the texts and writes ids, with each document's offset inside its task; pass two adds the prefix sums
of the task totals and cuts. A document that crosses window ends gives one piece (a boundary record) on each side. Only
the prefix sums, two numbers a task, are sent to the tasks, and no text or id is shuffled.

Nulls and empty texts are a lone end id. Equal or repeated doc_ids are packed one by one. An empty table gives no piece.
Only the last sequence is not full. Other columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from junctionflow.llm.common import Tables, documents, release, slices, utf8

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
WINDOW = 4096
#: Bytes of chunks and their ids that a Python worker remembers; beyond it the memory starts afresh.
CHUNK_BYTES = 48 << 20
#: Bytes of texts whose chunks are looked up together.
TEXT_BYTES = 8 << 20
#: What stands between chunks that are encoded together; a chunk that holds it is encoded by itself.
BETWEEN = "|"


@lru_cache(maxsize=1)
def ended() -> str:
    """A pattern of a letter or number near a chunk's end, and the ASCII punctuation after it but for the apostrophe, which
    may join them. Not of letters that the tokenizer's normal form and small letters turn into ones with a mark at their
    end (as a capital I with a dot), which joins the punctuation."""
    kind = lambda c: unicodedata.category(c)[0]
    marked = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if kind(c) in "LN" and kind(unicodedata.normalize("NFC", unicodedata.normalize("NFC", c).lower())[-1]) not in "LN"]
    out = "".join(f"\\x{{{ord(c):x}}}" for c in marked)
    return rf"(?s)\A(?P<stem>.*(?:[^\P{{L}}{out}]|[^\P{{N}}{out}]))(?P<tail>[!-&(-/:-@\[-`{{-~]+)\z"


_TOKENS = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_TAIL = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))


def _is_plain_bpe(tokenizer) -> bool:
    """Whether a few words of small letters have the ids that the model gives them by itself."""
    probe = ["a", "the", "word", "wordless", "qxzv", "dont", "internationalisation"]
    return [x.ids for x in tokenizer.encode_batch_fast(probe, add_special_tokens=False)] == [[t.id for t in tokenizer.model.tokenize(w)] for w in probe]


def _joined(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.large_binary())


class ChunkIds:
    """Ids of texts, by way of their chunks between ASCII white space.

    The tokenizer folds white space to a blank, never joins over it and drops it, and its other steps look at one
    character or at one word, so the ids of a text are those of its chunks in turn. Capitals of ASCII have the ids of
    small letters, and ASCII punctuation after a letter or a number at a chunk's end has ids of its own. Texts that hold
    a special token's string, whose match may take white space with it, are encoded as a whole.

    Chunks and ids stand in Arrow arrays; equal chunks are found by Arrow's dictionaries, by their bytes.
    """

    def __init__(self, path: str, most: int = CHUNK_BYTES):
        self.most = most
        self.tokenizer = _tokenizer(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.between = self._plain([BETWEEN])[0]
        self.letters = _is_plain_bpe(self.tokenizer)
        self.known, self.ids = pa.array([""], pa.large_string()), _joined([b""])

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk. Many are encoded as one text, with a chunk of one id between them, which costs less."""
        if any(BETWEEN in c for c in chunks) or len(self.between) != 4:
            return self._plain(chunks)
        ids = np.frombuffer(self._plain([f" {BETWEEN} ".join(chunks)])[0], "<u4")
        cut = np.flatnonzero(ids == np.frombuffer(self.between, "<u4")[0])
        if len(cut) != len(chunks) - 1:
            return self._plain(chunks)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *(4 * cut + 4).tolist()], [*(4 * cut).tolist(), len(data)], strict=True)]

    def _ids_of(self, chunks: pa.Array) -> pa.Array:
        """The ids of distinct chunks; new ones are encoded and remembered."""
        at = pc.index_in(chunks, value_set=self.known)
        missing = chunks.filter(at.is_null())
        if len(missing):
            new, found = missing.to_pylist(), {}
            if self.letters:  # one word for the model as it stands, which spares it the steps before
                found = {c: array("I", [t.id for t in self.tokenizer.model.tokenize(c)]).tobytes() for c in new if c.isascii() and c.isalpha() and c.islower()}
            rest = [c for c in new if c not in found]
            for k in range(0, len(rest), 256):
                found.update(zip(part := rest[k : k + 256], self._encoded(part), strict=True))
            ids = pa.concat_arrays([self.ids, _joined([found[c] for c in new])])
            place = np.where(at.is_null().to_numpy(zero_copy_only=False), len(self.ids) - 1 + np.cumsum(at.is_null().to_numpy(zero_copy_only=False)), at.fill_null(0).to_numpy())
            out = ids.take(pa.array(place))
            if self.known.nbytes + self.ids.nbytes > self.most:
                self.known, self.ids = chunks, out  # of those of this batch memory starts afresh
            else:
                self.known, self.ids = pa.concat_arrays([self.known, missing]), ids
            return out
        return self.ids.take(at)

    def of(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text (binary). Equal chunks of the texts are looked up once."""
        every = texts.to_pylist()
        whole = {i for i, t in enumerate(every) if any(s in t for s in self.special)}
        lower = not any(b"\xcc" in t for t in every)  # no mark that a small letter takes up and its capital does not
        plain = _joined([b"" if i in whole else t for i, t in enumerate(every)] if whole else every).view(pa.large_string())
        split = pc.ascii_split_whitespace(pc.ascii_lower(plain) if lower else plain)
        full = pc.not_equal(pc.binary_length(split.values), 0)  # blanks at a text's ends give empty words
        ends = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))][split.offsets.to_numpy()]
        words = split.values.filter(full).dictionary_encode()
        chunks = words.dictionary
        _, at, data = chunks.buffers()
        last = np.frombuffer(data, np.uint8)[np.frombuffer(at, np.int64)[1 : len(chunks) + 1] - 1] if len(chunks) else np.empty(0, np.uint8)
        some = np.flatnonzero(_TAIL[last])
        apart = pc.extract_regex(chunks.take(pa.array(some)), ended())
        some, apart = pa.array(some).filter(apart.is_valid()), apart.filter(apart.is_valid())
        split_off = np.zeros(len(chunks), bool)
        split_off[some.to_numpy()] = True
        stems = pc.replace_with_mask(chunks, pa.array(split_off), pc.struct_field(apart, 0).cast(pa.large_string()))
        tails = pc.replace_with_mask(pa.repeat(pa.scalar("", pa.large_string()), len(chunks)), pa.array(split_off), pc.struct_field(apart, 1).cast(pa.large_string()))
        both = pa.concat_arrays([stems, tails]).dictionary_encode()
        ids = self._ids_of(both.dictionary).take(both.indices)
        ids = pc.binary_join_element_wise(ids[: len(chunks)], ids[len(chunks) :], _joined([b""])[0]).take(words.indices)
        _, at, data = ids.buffers()
        at, data = np.frombuffer(at, np.int64)[: len(ids) + 1][ends], memoryview(data) if data else b""
        return [self._plain([t.decode(errors="replace")])[0] if i in whole else bytes(data[at[i] : at[i + 1]]) for i, t in enumerate(every)]


@lru_cache(maxsize=1)
def _chunk_ids(path: str, most: int) -> ChunkIds:
    """One memory for all tasks of a Python worker."""
    return ChunkIds(path, most)


def tokenise(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """part, doc_id, before, n, ids: a task's documents in turn, the ids before each in that task, and little-endian
    32-bit ids with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, end, memo = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes(), _chunk_ids(tokenizer, chunk_bytes)
        for batch in batches:
            for rows in slices(batch, TEXT_BYTES, TEXT_BYTES):
                ids = [x + end for x in memo.of(rows.column(1))]
                n = [len(x) // 4 for x in ids]
                start = before + np.cumsum([0, *n])
                before = int(start[-1])
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int64()), rows.column(0).cast(pa.int64()), pa.array(start[:-1]), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], schema=_TOKENS)
        release()

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, "part long, doc_id long, before long, n long, ids binary")


def first_places(tokens: DataFrame, tables: Tables) -> DataFrame:
    """part, first: the ids before each task's documents, by two levels of prefix sums: within blocks of tasks, and over
    the blocks."""
    totals = tables.write(tokens.groupBy("part").agg(F.sum("n").alias("n")))
    block, before = F.shiftright("part", 10), lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy(block.alias("block")).agg(F.sum("n").alias("n"))  # a thousandth of the tasks
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(before().orderBy("block")), F.lit(0)).alias("to_block"))
    within = totals.select("part", block.alias("block"), F.coalesce(F.sum("n").over(before(block).orderBy("part")), F.lit(0)).alias("in_block"))
    return within.join(blocks, "block").select("part", (F.col("to_block") + F.col("in_block")).alias("first"))


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: a row for each piece, ids little-endian 32-bit."""
    with Tables(tokens.sparkSession) as tables:
        written = tables.keep(tables.write(tokens))
        first = tables.keep(tables.write(first_places(written, tables)))  # two numbers a task
    placed = written.join(first, "part").select("doc_id", (F.col("first") + F.col("before")).alias("place"), "n", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                out: dict[str, list] = {f.name: [] for f in _PIECES}
                for doc_id, at, n, ids in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    start = 0
                    while start < n:
                        sequence, offset = divmod(at + start, window)
                        length = min(window - offset, n - start)
                        for name, value in zip(out, (doc_id, start, length, ids[4 * start : 4 * (start + length)], n, sequence, offset), strict=True):
                            out[name].append(value)
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _PIECES], schema=_PIECES)
        release()

    return placed.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(tokenise(documents(spark, sf_dir)))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
