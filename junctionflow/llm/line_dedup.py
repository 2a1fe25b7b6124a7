"""Line dedup: repeated runs of lines are deleted where they occur again, found by winnowing over line hashes.

Lines without a word are left out of account and always stay. Of each window of ``min_run`` neighbouring lines the line
with the least hash, the leftmost on a tie, is selected, so every run of that length carries a fingerprint at a place
that its content alone decides. A selected line is one row however many windows chose it. Lines whose fingerprint occurs
again are extended both ways to those windows, positions with equal extensions are joined with the first of them (by
doc_id, then place), and the later ones are deleted; neighbouring windows make up the longer runs. With ``long_words``,
a line of so many words or more is a run in itself too, whatever its neighbours.

So a line goes if and only if it lies in a run of ``min_run`` lines, or is a long line, that also starts earlier. Nulls and
empty texts have no lines and stay as they are. Of rows with one doc_id the hash of the text orders them; wholly equal
rows count as one and keep or lose the same lines. An empty table gives no rows. Other columns pass through;
``n_chars``, where numeric, is counted anew. Lines are equal by 64-bit hashes, runs by those of the fingerprint and of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from junctionflow.llm.common import Tables, any_columns, documents, keyed, ngrams, over_batches, rewrite, signed, utf8

MIN_RUN = 2
#: Words from which the corpus stage takes one line for a run; op7_line_dedup has none, as its SQL knows runs of lines only.
LONG_WORDS = 20
#: The share of all rows, one in so many, above which a fingerprint or a run is not shuffled with the others.
HOT = 1000


def winnowed(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, first): the selected places in turn, and the first of the windows in a row that chose each."""
    m = len(hashes) - window + 1
    chosen = np.lib.stride_tricks.sliding_window_view(hashes, window).argmin(axis=1) + np.arange(m)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    return chosen[first], first


def fingerprints(docs: DataFrame, min_run: int = MIN_RUN, long_words: int | None = None) -> DataFrame:
    """fingerprint, id, tie, place, lines, shifts, runs: a row for each selected line and each long line; shifts tell
    where the windows that chose it start, seen from it, and runs are the hashes of these windows."""

    def per_batch(id, tie, text):  # noqa: A002
        out: dict[str, list] = {"fingerprint": [], "id": [], "tie": [], "place": [], "lines": [], "shifts": [], "runs": [], "n": []}
        for i, t, x in zip(id, tie, text, strict=True):
            worded = [line for line in x.split(b"\n") if line.strip()]
            h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, worded)), ">u8").astype(np.uint64)
            found = []  # places, lines of a run, shifts, runs, how many of them for each place
            if len(h) >= min_run:
                place, first = winnowed(h, min_run)
                m = len(h) - min_run + 1
                n = np.diff(np.r_[first, m])
                found.append((place, min_run, np.arange(m) - np.repeat(place, n), ngrams(h, min_run), n))
            if long_words and min_run > 1:
                at = np.array([k for k, line in enumerate(worded) if len(line) >= 2 * long_words - 1 and len(line.split()) >= long_words], np.int64)
                found.append((at, 1, np.zeros(len(at), np.int64), ngrams(h, 1)[at], np.ones(len(at), np.int64)))
            for place, lines, shifts, runs, n in found:
                m = len(place)
                for name, values in zip(out, (signed(h[place]), np.full(m, i), np.full(m, t), place, np.full(m, lines), shifts, signed(runs), n), strict=True):
                    out[name].append(values)
        if not out["id"]:
            return None
        whole = {k: np.concatenate(v) for k, v in out.items()}
        ends = pa.array(np.r_[0, np.cumsum(whole.pop("n"))], pa.int32())
        return whole | {k: pa.ListArray.from_arrays(ends, pa.array(whole[k], kind)) for k, kind in (("shifts", pa.int32()), ("runs", pa.int64()))}

    source = keyed(docs).select(F.col("__id").alias("id"), F.col("__tie").alias("tie"), utf8().alias("text"))
    return over_batches(source, per_batch, "fingerprint long, id long, tie long, place int, lines int, shifts array<int>, runs array<long>")


def hot_join(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """rows, a written table, joined with keys that have n, the rows of each. Keys that hold more than a HOT-th of the rows,
    fewer than HOT by their number, meet their rows in the tasks that read them; the others are shuffled."""
    hot = F.col("n") > rows.count() / HOT
    sent, rest = F.broadcast(keys.filter(hot)), keys.filter(~hot).hint("merge")
    return rows.join(F.broadcast(keys.filter(hot).select(*on)), on, "left_anti").join(rest, on).unionByName(rows.join(sent, on))


def later_runs(docs: DataFrame, tables: Tables, min_run: int = MIN_RUN, long_words: int | None = None) -> DataFrame:
    """__id, __tie, __places, __alone: the windows of a document that start earlier as well, and its long lines that do."""
    every = tables.write(fingerprints(docs, min_run, long_words))
    of_line, of_run, where = ["fingerprint", "lines"], ["fingerprint", "lines", "shift", "run"], F.struct("id", "tie", "start")
    recurring = tables.write(every.groupBy(*of_line).agg(F.count("*").alias("n")).filter("n > 1"))
    matched = hot_join(every, recurring, of_line).select(*of_line, "id", "tie", "place", F.explode(F.arrays_zip("shifts", "runs")).alias("w"))
    extended = tables.write(matched.select(*of_line, F.col("w.shifts").alias("shift"), F.col("w.runs").alias("run"), "id", "tie", (F.col("place") + F.col("w.shifts")).alias("start")))
    tables.drop(every)
    first = tables.write(extended.groupBy(*of_run).agg(F.min(where).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    later = hot_join(extended, first, of_run).filter(where > F.col("first"))
    places = [F.collect_set(F.when((F.col("lines") == min_run) == whole, F.col("start"))).alias(c) for c, whole in (("__places", True), ("__alone", False))]
    return tables.keep(tables.write(later.groupBy(F.col("id").alias("__id"), F.col("tie").alias("__tie")).agg(*places)))


def cut_runs(text: bytes, places: list[int] | None, min_run: int, alone: list[int] | None = None) -> tuple[bytes, int, int, int]:
    """(text without the runs, lines with a word, lines removed, runs removed)"""
    lines = text.split(b"\n")
    worded = [i for i, line in enumerate(lines) if line.strip()]
    if not places and not alone:
        return text, len(worded), 0, 0
    gone = np.zeros(len(worded) + 1, bool)
    for p in places or []:
        gone[p : p + min_run] = True
    gone[alone or []] = True
    out = {worded[i] for i in np.flatnonzero(gone)}
    return b"\n".join(line for i, line in enumerate(lines) if i not in out), len(worded), len(out), int((gone[:-1] & ~gone[1:]).sum())


def dedup_lines(docs: DataFrame, min_run: int = MIN_RUN, long_words: int | None = None) -> DataFrame:
    """The columns of docs with the repeated runs out of ``text``, and __n_lines, __n_removed, __n_runs."""
    with Tables(docs.sparkSession) as tables:
        # the places grow with the documents: a shuffle at any size
        source = keyed(docs).join(later_runs(docs, tables, min_run, long_words).hint("merge"), ["__id", "__tie"], "left")
    source = source.withColumn("__text", F.col("text").cast("binary")).drop("text", "__id", "__tie")

    def per_batch(__text, __places, __alone):
        rows = [cut_runs(t or b"", p, min_run, a) for t, p, a in zip(__text, __places, __alone, strict=True)]
        return {"text": [None if t is None else r[0].decode(errors="replace") for t, r in zip(__text, rows, strict=True)]} | {name: [r[i] for r in rows] for i, name in enumerate(("__n_lines", "__n_removed", "__n_runs"), 1)}

    return rewrite(source, ["__text", "__places", "__alone"], per_batch, "text string, __n_lines long, __n_removed long, __n_runs long")


@any_columns
def dedup_documents(docs: DataFrame, min_run: int = MIN_RUN, long_words: int | None = LONG_WORDS) -> DataFrame:
    """docs with the same columns, the repeated runs and long lines out of ``text``."""
    out = dedup_lines(docs, min_run, long_words)
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), F.col("__n_runs").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


SQL = """
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS w FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
runs AS (SELECT doc_id, w, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY w) AS run FROM worded),
later AS (SELECT doc_id, w FROM (SELECT doc_id, w, row_number() OVER (PARTITION BY run ORDER BY doc_id, w) AS nth FROM runs WHERE run IS NOT NULL) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest([w, w + 1]) AS w FROM later),
marked AS (
  SELECT l.doc_id, l.k, l.line, w.w, g.w IS NOT NULL AS out FROM lines l LEFT JOIN worded w ON l.doc_id = w.doc_id AND l.k = w.k
  LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.w = w.w),
ends AS (SELECT doc_id, count(*) AS n FROM gone g WHERE NOT EXISTS (SELECT 1 FROM gone h WHERE h.doc_id = g.doc_id AND h.w = g.w + 1) GROUP BY doc_id)
SELECT m.doc_id, count(m.w) AS n_lines, count(*) FILTER (out) AS n_removed, coalesce(any_value(e.n), 0) AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT out), '')) AS kept_sha256
FROM marked m LEFT JOIN ends e ON e.doc_id = m.doc_id GROUP BY m.doc_id
"""
