"""The pipeline and the registered queries over a folder of tables, against plain Python versions of all they do."""

import collections
import hashlib
import random
import re
import zlib

import pytest
import tiktoken
import xxhash

import corpus_pipeline
from junctionflow.llm import bpe, packing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def made_rows():
    rng = random.Random(17)
    words = ["".join(rng.choice("abcdefghiklmé") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line, run = text(90), text(25), [text(4), text(5), text(3)]
    base = text(240)
    edited = base.split()
    edited[40] = "Other"
    out = [
        (base, "good"), (" ".join(edited), "good"), (base.upper(), "other"), (base, "good"), (text(80), "good"), (text(90), None),
        # a passage inside texts, once between letters that share their last byte (é and ĩ), twice in one text
        (f"{text(60)} é{passage} {text(30)}", "good"), (f"{text(70)} ĩ{passage} {text(20)}", "good"), (f"{text(55)} {passage} {text(9)} {passage}", "other"),
        # a run of lines with blank ones between, a line of 25 words, runs that repeat within a text
        ("\n".join([text(40), *run, text(30)]), "good"), ("\n".join([text(50), run[0], "", *run[1:], " \t", text(20)]), "other"),
        (f"{text(60)}\n{line}\n{text(10)}", "good"), (f"{text(70)}\n{line}", "other"), ("\n".join([text(50), *run[:2], text(60), *run[:2]]), "good"),
        # what rules reject: nothing, little, repeats; and a host that mostly fails
        (None, "good"), ("", "other"), (text(49), "good"), (text(5) + " one two three" * 40, "other"), (text(60), "bad"),
        *[(text(60) + " #|#" * 40, "bad") for _ in range(9)], ("\n".join([text(12)] * 8), "bad"),
        (text(50), "other"), ("Ünd İ. " + text(2500), "good"), ("THE <|endoftext|> | " + text(60), "good"),
    ]
    rows = [(i * 3 % 101, t, "en", s, len(t or "")) for i, (t, s) in enumerate(out)]
    rows += [(200 + i, text(rng.randint(50, 120)), "de", f"h{i % 4}", 7) for i in range(25)]
    return [*rows, rows[4], rows[6]]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return made_rows()


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/none/documents.parquet")
    return path


def with_text(row, text):
    return (row[0], text, row[2], row[3], len(text or ""))


def quality(rows):
    def judged(text):
        words = WORD.findall(text or "")
        grams = collections.Counter(zip(words, words[1:], words[2:]))
        repeated = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        base = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        return base, base or 100 * len(re.findall(r"[#*$%&|<>]", text or "")) > 20 * len(words) or 100 * (len(lines) - len(set(lines))) > 30 * len(words)

    hosts = collections.defaultdict(list)
    for r in rows:
        hosts[r[3]].append(judged(r[1])[1])
    rates = [sum(x) / len(x) for x in hosts.values()]
    m = sum(rates) / len(rates)
    v = sum((x - m) ** 2 for x in rates) / len(rates)
    weight = max(1, min(1000, m * (1 - m) / v - 1))
    out = {h for h, x in hosts.items() if (sum(x) + weight * m) / (len(x) + weight) > 0.6}
    return [r for r in rows if not judged(r[1])[0] and r[3] not in out], out


def lines(rows):
    runs, alone, out = set(), set(), {}
    for r in sorted(set(rows), key=lambda r: r[0]):
        every = (r[1] or "").split("\n")
        worded = [i for i, x in enumerate(every) if WORD.search(x)]
        gone = set()
        for p, i in enumerate(worded):
            run = tuple(every[j] for j in worded[p : p + 2])
            if len(run) == 2:
                gone |= set(worded[p : p + 2]) if run in runs else set()
                runs.add(run)
            if len(WORD.findall(every[i])) >= 20:
                gone |= {i} if every[i] in alone else set()
                alone.add(every[i])
        out[r] = with_text(r, None if r[1] is None else "\n".join(x for i, x in enumerate(every) if i not in gone))
    return [out[r] for r in rows]


def components(rows):
    """The least id of each row's group, and the size of its set."""
    def shingles(text):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets, least = [shingles(r[1]) for r in rows], [r[0] for r in rows]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= 80 * len(a | b)]
    while any(least[i] != least[j] for i, j in links):
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    return least, [len(s) for s in sets]


def near_copies(rows):
    least, sizes = components(rows)
    worded = dict.fromkeys(r for r, k, n in zip(rows, least, sizes, strict=True) if n and r[0] == k)
    return [*worded, *[r for r, n in zip(rows, sizes, strict=True) if not n]]


def cut(rows, n=400):
    """(row, bytes left, bytes removed, runs)"""
    count = collections.Counter()
    for r in rows:
        b = (r[1] or "").encode()
        count.update(b[p : p + n] for p in range(len(b) - n + 1))
    for r in rows:
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if count[b[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        yield r, bytes(x for x, g in zip(b, gone, strict=True) if not g), sum(gone), (b"\0" + gone).count(b"\0\1")


def repeats(rows):
    return [with_text(r, None if r[1] is None else left.decode(errors="ignore")) for r, left, _, _ in cut(rows)]


def pieces_hold(pieces, rows, ids_of):
    """The pieces fill sequences of 4,096 without gaps, and are the texts' ids; ids_of gives what a piece tells of them."""
    tokenizer, at = packing._tokenizer(packing.TOKENIZER), 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 4096 + p.offset == at and 0 < p.length <= 4096 - p.offset
        at += p.length
    want = collections.Counter()
    found = collections.Counter((p.doc_id, p.start, p.length, p.doc_tokens, ids_of(p)) for p in pieces)
    ids = {r[0]: [] for r in rows}
    for r in rows:
        ids[r[0]].append([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2])
    assert at == sum(len(x) for xs in ids.values() for x in xs)
    for p in pieces:
        part = next(x for x in ids[p.doc_id] if len(x) == p.doc_tokens)[p.start : p.start + p.length]
        want[p.doc_id, p.start, p.length, p.doc_tokens, b"".join(i.to_bytes(4, "little") for i in part)] += 1
    return found, want


def test_pipeline_against_plain_python(spark, rows, folder):
    kept, rejected = quality(rows)
    assert rejected == {"bad"} and {r[3] for r in kept} >= {None, "good", "other"}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = [lambda rows: quality(rows)[0], lines, near_copies, repeats]
    now = rows
    for (name, stage), step in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        before, now, docs = now, step(now), stage(spark, docs, folder)
        assert collections.Counter(map(tuple, docs.collect())) == collections.Counter(now), name
        assert collections.Counter(before) != collections.Counter(now), name  # each stage has something to do here
    pieces = corpus_pipeline.run(spark, folder).collect()
    found, want = pieces_hold(pieces, now, lambda p: bytes(p.ids))
    assert found == want
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_op1_query(spark, rows, folder):
    got = collections.Counter(tuple(r)[:5] for r in queries.QUERIES["op1_suffix_dedup"](spark, folder).collect())
    assert got == collections.Counter((r[0], len((r[1] or "").encode()), n, runs, hashlib.sha256(left).hexdigest()) for r, left, n, runs in cut(rows))


def test_op2_query(spark, rows, folder):
    got = collections.Counter(tuple(r) for r in queries.QUERIES["op2_jaccard_join"](spark, folder).select("doc_id", "n_shingles", "component_id").collect())
    assert got == collections.Counter((r[0], n, k) for r, k, n in zip(rows, *components(rows), strict=True))


def test_op3_query(spark, rows, folder):
    found, want = pieces_hold(queries.QUERIES["op3_packing"](spark, folder).collect(), rows, lambda p: p.ids_crc32)
    assert found == collections.Counter({(*k[:4], zlib.crc32(k[4])): n for k, n in want.items()})


def test_op6_query(spark, rows, folder):
    """Shards are runs of groups by the hash of their text, the largest as small as can be; slots count each shard."""
    out = queries.QUERIES["op6_sharding"](spark, folder).collect()
    fact = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert collections.Counter((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in out) == collections.Counter((r[0], *fact(r[1]), "bytes", None) for r in rows)
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    key = {r[0]: 42 if r[1] is None else signed(xxhash.xxh64(r[1].encode(), seed=42).intdigest()) for r in rows}
    homes, sizes, slots = collections.defaultdict(set), collections.Counter(), collections.defaultdict(list)
    for r in out:
        homes[key[r.doc_id]].add(r.shard)
        sizes[key[r.doc_id]] += r.size
        slots[r.shard].append(r.slot)
    order = [homes[k] for k in sorted(homes)]
    assert all(len(h) == 1 for h in order) and [min(h) for h in order] == sorted(min(h) for h in order)
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sums = [0]
    for k in sorted(sizes):
        sums.append(sums[-1] + sizes[k])
    best = list(sums)  # the least capacity for the first groups, with more shards each time
    for _ in range(15):
        best = [min((max(best[j], sums[i] - sums[j]) for j in range(i)), default=0) for i in range(len(sums))]
    shard = collections.Counter()
    for r in out:
        shard[r.shard] += r.size
    assert max(shard.values()) == best[-1]


def test_op9_query(spark, rows, folder):
    enc = bpe.encoding()
    assert isinstance(enc, tiktoken.Encoding)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = collections.Counter()
    for r in rows:
        ids = enc.encode_ordinary(r[1] or "")
        want[r[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r[1] or "").encode())] += 1
    assert collections.Counter(tuple(r) for r in queries.QUERIES["op9_byte_bpe"](spark, folder).collect()) == want
    assert all(f(spark, f"{folder}/none").count() == 0 for k, f in queries.QUERIES.items() if k.split("_")[0] in ("op1", "op2", "op3", "op5", "op6", "op7", "op8", "op9", "op11", "op12", "op13"))
