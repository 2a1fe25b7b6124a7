"""Manifest, BPE by fragments and token alignment against plain versions, on edge cases: nulls, empty and very long texts,
ties, repeated rows, an empty table, extra columns whose names might clash."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from junctionflow.llm import alignment, boundaries, fragment_bpe, manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `group` int, id string, n_tokens int, __id int, a_ids int, payload int"
CLASH = (1, "x", 2, 3, 4, 5)
LETTERS = [*"abcdeLSVTrelvmd''''    \n\t.,!?-_$%0159éßİıñ中文ー😀　\xa0́‍\x85\r\x00▁", "<|endoftext|>", "<|endo", "<s>", "</s>", "<0x0A>", "'ll", "'re", " the", "  ", "\n\n", "ﬁ"]


def texts(n, seed=3):
    rng = random.Random(seed)
    made = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [None, "", " ", "a", "a" * 3000, " " * 3000 + "x", "word " * 4000, "\n \n" * 500, "x<|endoftext|>  y", *made]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, t, rng.choice(["en", "en", "de", "é", None]), rng.choice(["s1", None]), None if i % 9 == 0 else i % 50, *CLASH) for i, t in enumerate(texts(300))]
    lone = [(5_000_000_000 * i - 9, f"far {i}", "en", "s", i, *CLASH) for i in range(5)] + [(7, "alone", "zz", None, 3, *CLASH)]
    ties = [(11, f"tie {i % 3}", "en", "s", 4, *CLASH) for i in range(60)] + [(None, f"no id {i % 4}", "en", None, i % 2, *CLASH) for i in range(50)] + [(-(1 << 63), "least", "en", "s", 1, *CLASH)]
    return out + lone + ties + [out[20], out[20]]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    """Folders with a documents table as the queries read it, of all rows, and of none."""
    full, none = (str(tmp_path_factory.mktemp(n)) for n in ("full", "none"))
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.repartition(5).write.parquet(f"{full}/documents.parquet")
    docs.limit(0).write.parquet(f"{none}/documents.parquet")
    return full, none


def H(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(doc_id, text, lang, source, n_chars):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def tree(nodes):
        """The root, and each node's path of (sibling or None, whether it stands left)."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, k in enumerate(at):
                other = k ^ 1
                ways[i].append((nodes[other], other < k) if other < len(nodes) else (None, False))
                at[i] = k // 2
            nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        return nodes[0], ways

    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        tampered = n_chars is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        own = leaf(doc_id, text, lang, source, n_chars)
        groups[b"" if lang is None else b"=" + lang.encode()].append((doc_id is not None, doc_id or 0, own, doc_id, leaf(doc_id, text, lang, source, n_chars + 1) if tampered else own))
    subs = {g: tree([x[2] for x in sorted(v, key=lambda x: x[:3])]) for g, v in groups.items()}
    root, tops = tree([subs[g][0] for g in sorted(groups)])
    want = collections.Counter()
    for g, top in zip(sorted(groups), tops, strict=True):
        for (_, _, own, doc_id, claimed), way in zip(sorted(groups[g], key=lambda x: x[:3]), subs[g][1], strict=True):
            node = claimed
            for other, left in way + top:
                node = H(node) if other is None else H(other, node) if left else H(node, other)
            want[doc_id, own, subs[g][0], root, H(*(o for o, _ in way + top if o)), node, node == root] += 1
    return want


@pytest.mark.parametrize("levels", [10, 2])
def test_manifest(spark, rows, folder, levels):
    """Arrays of four slots take several rounds, those of 1024 one."""
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    got = collections.Counter(map(tuple, (manifest.tamper_report(docs, levels) if levels != manifest.LEVELS else manifest.op11_manifest(spark, folder[0])).collect()))
    assert got == brute_manifest(rows)
    assert {x[-1] for x in got} == {True, False}
    assert not manifest.op11_manifest(spark, folder[1]).collect()


def test_places(spark):
    counts = spark.createDataFrame([(i, 1 + i % 3) for i in (-(1 << 57), -70_000, -1, 0, 1, 64, 70_000, 1 << 40, 1 << 57)], "word long, n long")
    got = manifest.places(counts, [], [[F.shiftright("word", 42)], [F.shiftright("word", 26)], [F.shiftright("word", 10)], ["word"]]).orderBy("word").collect()
    assert [r.place for r in got] == np.cumsum([0, *[r.n for r in got]])[:-1].tolist()
    assert {r.total for r in got} == {sum(r.n for r in got)}


def test_fragments_are_the_library(spark, rows, folder):
    tokenizer = fragment_bpe.encoder(fragment_bpe.TOKENIZER).tokenizer
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, fragment_bpe.op12_fragment_bpe(spark, folder[0]).collect())) == want
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    assert collections.Counter(map(tuple, fragment_bpe.digests(docs, part=600).collect())) == want  # parts of a text
    assert not fragment_bpe.op12_fragment_bpe(spark, folder[1]).collect()
    encoded = fragment_bpe.encode_documents(docs)
    back = collections.Counter(map(tuple, fragment_bpe.decode_documents(encoded).collect()))
    assert back == collections.Counter((r[0], tokenizer.decode(tokenizer.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False)) for r in rows)


def test_fragments_of_many_texts():
    """Random texts in one batch, with a memory that starts afresh again and again, and bytes that are no UTF-8."""
    encoder = fragment_bpe.Encoder(most=1)
    for seed in range(5):
        many = [t or "" for t in texts(2000, seed)]
        count, (ids,) = encoder.of([t.encode() for t in many], 3)
        want = [x.ids for x in encoder.tokenizer.encode_batch(many, add_special_tokens=False)]
        assert [np.frombuffer(x, np.int32).tolist() for x in ids] == want and count.tolist() == list(map(len, want))
    assert fragment_bpe.valid(b"a\xff") == "a�".encode()


def test_long_text_in_parts():
    encoder = fragment_bpe.Encoder()
    text = ("Some words, 12 numbers! " * 300_000).encode()
    cut = list(boundaries.parts(text, encoder.certain, 1 << 20))
    assert b"".join(cut) == text and max(map(len, cut)) <= 1 << 20
    assert sum(int(encoder.of([p])[0][0]) for p in cut) == len(encoder.tokenizer.encode(text.decode(), add_special_tokens=False).ids)
    assert list(boundaries.parts(b"x" * 5000, encoder.certain, 1000)) == [b"x" * 5000]  # no certain cut


def brute_alignment(aligner, text):
    """Tokens of A and B, and the tokens up to each offset where both end."""
    if not text:
        return [], [], [], []
    a, b, whole = aligner.a.tokenizer.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text), (" " + text).encode()
    if b"".join(aligner.bytes_a[i] for i in a) != whole or b"".join(aligner.bytes_b[i] for i in b) != whole:
        return [], [], [], []
    ends_a, ends_b = np.cumsum([len(aligner.bytes_a[i]) for i in a]).tolist(), np.cumsum([len(aligner.bytes_b[i]) for i in b]).tolist()
    both = sorted(set(ends_a) & set(ends_b))
    return a, b, [ends_a.index(x) + 1 for x in both], [ends_b.index(x) + 1 for x in both]


@pytest.mark.parametrize("size,lane", [(2 << 20, 48), (2000, 2)])
def test_alignment(spark, rows, folder, size, lane):
    aligner = alignment.Aligner()
    every = [(r[0], brute_alignment(aligner, r[1])) for r in rows]
    count = collections.Counter((a[i - 1], b[j - 1]) for _, (a, b, x, y) in every for i, j in zip(x, y, strict=True))
    best = collections.defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    want = collections.Counter()
    for doc_id, (a, b, x, y) in every:
        pairs = [(a[i - 1], b[j - 1]) for i, j in zip(x, y, strict=True)]
        groups = ";".join(",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m])) for i, j, k, m in zip([0, *x[:-1]], x, [0, *y[:-1]], y, strict=False))
        want[doc_id, len(a), len(b), len(x), len(pairs), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs), H(groups) if a else ""] += 1
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    got = alignment.op13_token_alignment(spark, folder[0]) if lane == alignment.LANE else alignment.link_report(docs, lane=lane, batch_bytes=size)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == want
    assert 0 < sum(n for k, n in want.items() if not k[1]) < len(rows) and any(k[5] < k[4] for k in want)
    assert not alignment.op13_token_alignment(spark, folder[1]).collect()
    real = alignment.align(docs, lane=lane).collect()
    plain = lambda x: repr([x[0], *map(list, x[1:])])
    assert collections.Counter(map(plain, real)) == collections.Counter(plain((d, *x)) for d, x in every)


def test_lockstep():
    """Lanes of several lengths, an empty one too."""
    ends_a, ends_b = np.array([2, 5, 9, 10, 12]), np.array([5, 9, 11, 12])
    found = alignment.lockstep(ends_a, ends_b, np.array([0, 2, 3, 5]), np.array([0, 1, 2, 4]), np.array([2, 3, 5, 5]))
    assert [x.tolist() for x in found] == [[1, 2, 4], [0, 1, 3]]
