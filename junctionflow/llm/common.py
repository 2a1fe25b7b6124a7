"""What the corpus operators share: reading documents, shared-folder tables, bounded Arrow batches, hashes of words."""

from __future__ import annotations

import ctypes
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows and bytes of text that a Python worker turns into objects at a time; a longer text stands alone.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where that is unset, a local master gets a folder of its own; on a
    cluster, whose executors would each write to their own disk, that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Tables of this thread that outlive the blocks that made them.
_kept = threading.local()


class Tables:
    """Tables of one computation in the shared folder: each computed once, and safe from lost executors.

    ``drop`` deletes tables that are read no more, and the end of a ``with`` block all that were not named in ``keep``,
    so that disk use follows the largest step and not the sum of all.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error) -> None:
        self.drop(*[df for df, _ in self.paths.values()])

    def write(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back. Shuffle files of the finished write are of no more use and are given back at once."""
        clean, path = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", f"{shared_folder(self.spark)}/table-{uuid.uuid4().hex}"
        before = self.spark.conf.get(clean, "false")
        self.spark.conf.set(clean, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(clean, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            if found := self.paths.pop(id(table), None):
                self._delete(found[1])

    def keep(self, table: DataFrame) -> DataFrame:
        """``table``, which outlives the block: a result is read from it."""
        if found := self.paths.pop(id(table), None):
            _kept.__dict__.setdefault("paths", []).append(found[1])
        return table

    def write_alone(self, make: Callable[[], DataFrame]) -> DataFrame:
        """What ``make`` gives, written; tables that it has kept for its result are dropped, which reads them no more."""
        before = len(_kept.__dict__.setdefault("paths", []))
        out = self.write(make())
        for path in _kept.paths[before:]:
            self._delete(path)
        del _kept.paths[before:]
        return out

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """A table that outlives its maker, as results that are read later need it."""
    tables = Tables(df.sparkSession)
    return tables.keep(tables.write(df))


def utf8(text: str = "text") -> Column:
    """The bytes of a text column; none for null."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def slices(batch: pa.RecordBatch, most: int = BATCH_BYTES, most_rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, so many at a time that their values take about ``most`` bytes."""
    if batch.num_rows:
        ends = None
        for c in batch.columns:
            if pa.types.is_binary(c.type) or pa.types.is_string(c.type):
                size = np.cumsum(np.diff(np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1].astype(np.int64)))
                ends = size if ends is None else ends + size
        at = 0
        while at < batch.num_rows:
            n = most_rows if ends is None else min(most_rows, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")) - at)
            n = max(1, n)
            yield batch.slice(at, n)
            at += n


try:
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except OSError:  # not a GNU system
    _TRIM = None


def release() -> None:
    """Give free memory back to the system: Python workers live on after a task, beside those of later ones."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def over_batches(df: DataFrame, per_batch: Callable[..., dict | None], schema: str) -> DataFrame:
    """Apply ``per_batch(**lists of column values) -> dict of lists`` to bounded Arrow batches of ``df``."""
    return rewrite(df, df.columns, per_batch, schema)


def rewrite(df: DataFrame, inputs: list[str], per_batch: Callable[..., dict | None], schema: str) -> DataFrame:
    """``df`` without its ``inputs`` columns, which ``per_batch`` turns into those of ``schema``, row by row; with no
    other columns the number of rows is free. Other columns pass through as they are."""
    names, kept = df.columns, [c for c in df.columns if c not in inputs]
    out_type = StructType([df.schema[c] for c in kept] + StructType.fromDDL(schema).fields)
    arrow = to_arrow_schema(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                part = dict(zip(names, rows.columns, strict=True))
                out = per_batch(**{k: part[k].to_pylist() for k in inputs})
                if out is not None:
                    yield pa.RecordBatch.from_arrays([part[f.name] if f.name in kept else out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
        release()

    return df.mapInArrow(run, out_type)


#: Columns of documents that operators look at; all others only pass through them.
READ = ("doc_id", "text", "source", "lang", "n_chars")


def any_columns(operate: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operate(docs, ...)``, which returns rows with the columns of docs, for docs whose other columns bear any names:
    meanwhile they have names that no operator uses."""

    @wraps(operate)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        plain = {c: c if c in READ else f"column{i}" for i, c in enumerate(docs.columns)}
        out = operate(docs.select(*[F.col(f"`{c}`").alias(p) for c, p in plain.items()]), *args, **options)
        return out.select(*[F.col(p).alias(c) for c, p in plain.items()])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """docs with ``__id`` and ``__tie``, which tell its rows apart; equal rows share them. Neither is null."""
    return docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))).withColumn("__tie", F.xxhash64("text"))


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * _B
    h = (h ^ (h >> np.uint64(29))) * _A
    return h ^ (h >> np.uint64(32))


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def parts(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut at white space, so that long texts take little memory at a time."""
    at = 0
    while len(text) - at > size:
        cut = _BLANK.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, the runs of anything but ASCII white space; with ``lower`` A-Z count as a-z."""
    found = [np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, (p.lower() if lower else p).split())), ">u8") for p in parts(text)]
    return (found[0] if len(found) == 1 else np.concatenate(found)).astype(np.uint64)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` neighbouring hashes; empty when there are fewer."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:m] + np.uint64(n)
    for i in range(1, n):
        out = (out ^ (out >> np.uint64(31))) * _A + hashes[i : i + m]
    return mix(out)


def distinct(h: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order."""
    h = np.sort(h)
    return h[np.r_[True, h[1:] != h[:-1]]] if len(h) else h


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
