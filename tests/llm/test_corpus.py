"""The corpus operators against plain Python versions, on edge cases: nulls, empty and long texts, ties, repeated rows,
empty tables, columns with clashing names."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from junctionflow.llm import bpe, common, jaccard_join, line_dedup, linear, merkle, packing, quality_classifier, quality_rules, sharding, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept int"


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = text(200), text(90)
    edited = base.split()
    edited[100] = "ZZ"
    out = [None, "", " \n\t ", "one", "a b c", base, base, " ".join(edited), text(150) + " " + passage + " " + text(60), passage + "\n" + text(80), "x" * 1500, "é" * 900]
    out += ["l1 a\nl2 b\nl3 c\n\nl4 d", "zz\nl1 a\nl2 b\n\nl3 c\nyy", text(5000), "THE, Thé. DON'T 12.5 ,.! | | |", "a <|endoftext|> b", "word " * 120] + [text(rng.randint(3, 200)) for _ in range(20)]
    rows = [(i, t, "en", f"s{i % 3}" if i else None, len(t or ""), "w", 7) for i, t in enumerate(out)]
    return [*rows, rows[8], (8, "another text of the same name", "en", "s1", 5, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


THUE_MORSE = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
#: Two words of 1,024 letters whose sums of letters times powers of any odd base are equal modulo 2^64.
TWINS = [THUE_MORSE, THUE_MORSE.translate({97: 98, 98: 97})]


def without_repeats(rows, n):
    """(doc_id, bytes removed, runs, SHA-256 of the rest) by brute force."""
    count, want = collections.Counter(), collections.Counter()
    for k, t in rows:
        b = (t or "").encode()
        count.update(b[p : p + n] for p in range(len(b) - n + 1))
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if count[b[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want[k, sum(gone), bytes(gone).count(b"\0\1") + (gone[:1] == b"\1"), hashlib.sha256(left).hexdigest()] += 1
    return want


@pytest.mark.parametrize("n,bucket,block", [(100, 400_000, 1 << 20), (100, 40, 300), (7, 400_000, 1 << 20)])
def test_suffix_dedup(spark, docs, empty, rows, monkeypatch, n, bucket, block):
    """Small buckets let groups of copies run over boundaries, small blocks cut stretches apart."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng, base = random.Random(8), rows[5][1]
    made = [(r[0], r[1]) for r in rows] + [(500 + i, t) for i, t in enumerate(TWINS)]
    for i in range(40):  # a group of near copies, one anchor with many contents
        w = base.split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"Q{rng.randrange(5)}"
        made.append((600 + i, " ".join(w)))
    out = suffix_dedup.remove_repeats(spark.createDataFrame(made, "doc_id long, text string").repartition(3), n).collect()
    got = collections.Counter((r.doc_id, sum(s.end - s.start for s in r["__spans"]), len(r["__spans"]), r["__sha256"]) for r in out)
    assert got == without_repeats(made, n)


def test_suffix_dedup_of_documents(docs, empty):
    assert suffix_dedup.dedup_documents(docs, 100).columns == docs.columns
    assert suffix_dedup.dedup_documents(empty, 100).count() == 0


def test_jaccard_join(docs, empty, rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [(r[0], shingles(r[1])) for r in rows]
    group = list(range(len(sets)))

    def find(i):
        return i if group[i] == i else find(group[i])

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group[find(i)] = find(j)
    least = collections.defaultdict(lambda: 1 << 60)
    for i, (k, _) in enumerate(sets):
        least[find(i)] = min(least[find(i)], k)
    want = collections.Counter((k, len(s), least[find(i)]) for i, (k, s) in enumerate(sets))
    assert collections.Counter((r.id, r.size, r.group) for r in jaccard_join.joined(docs).collect()) == want
    kept = jaccard_join.dedup_documents(docs)
    assert kept.columns == docs.columns and {5} == {r.doc_id for r in kept.collect()} & {5, 6, 7}
    assert jaccard_join.joined(empty).count() == 0 and jaccard_join.dedup_documents(empty).count() == 0


def test_near_copies_keep_one_of_rows_that_repeat(spark, docs):
    kept = jaccard_join.dedup_documents(docs)
    assert [r.doc_id for r in kept.filter("doc_id = 8 AND n_words = 'w'").collect()] == [8]
    assert kept.filter("doc_id IN (0, 1, 2)").count() == 3
    text = " ".join(f"w{i}" for i in range(200))
    made = [(1, text), (1, text), (2, " "), (2, " "), (3, ""), (3, "a text of its own with words")]
    twice = jaccard_join.dedup_documents(spark.createDataFrame(made, "doc_id long, text string").repartition(3))
    assert sorted((r.doc_id, r.text) for r in twice.collect()) == sorted(made[1:])
    assert {r.text for r in suffix_dedup.dedup_documents(twice).filter("doc_id = 1").collect()} == {text}


def test_jaccard_join_of_a_large_group_of_edited_copies(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    made = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = f"e{rng.randrange(30)}"
        made.append((i, " ".join(w)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for _, t in made]
    group = list(range(150))
    for i in range(150):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = max(group[i], group[j]), min(group[i], group[j])
                group = [b if g == a else g for g in group]
    got = {r.id: r.group for r in jaccard_join.joined(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(group))


def test_jaccard_join_pairs_few_of_a_list_whose_sets_are_far_apart(spark, monkeypatch):
    rng = random.Random(4)
    made = []
    for i in range(80):
        w = [f"w{k}" for k in range(200)]
        for k in rng.sample(range(200), 6):
            w[k] = f"e{i}"
        made.append((i, " ".join(w)))
    counts, may_link = [], jaccard_join.may_link
    monkeypatch.setattr(jaccard_join, "may_link", lambda pairs, classes: counts.append(pairs.count()) or may_link(pairs, classes))
    got = {r.id: r.group for r in jaccard_join.joined(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert got == {i: i for i in range(80)}
    assert counts[0] > 50 and sum(counts[1:]) < 20  # the list's head meets all, few others meet


def test_packing(docs, empty, rows):
    tokenizer = packing._tokenizer(packing.TOKENIZER)
    pieces = packing.pack(packing.tokenise(docs), 64).collect()
    assert packing.pack(packing.tokenise(empty), 64).count() == 0
    want = collections.Counter((r[0], tuple([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in rows)
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 64 + offset == at and 0 < length <= 64 - offset
        at += length
    assert at == sum(len(ids) * n for (_, ids), n in want.items())
    found = collections.defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        ids = memoryview(bytes(p.ids)).cast("I").tolist()
        if p.start == 0:
            found[p.doc_id].append([])
        assert p.start == len(found[p.doc_id][-1]) and len(ids) == p.length
        found[p.doc_id][-1] += ids
    assert collections.Counter((k, tuple(x)) for k, xs in found.items() for x in xs) == want


def test_chunks_have_the_tokenizers_ids():
    """Random texts of marks, capitals, letters whose small or normal form ends in a mark, punctuation and white space."""
    tokenizer, chunks = packing._tokenizer(packing.TOKENIZER), packing.ChunkIds(packing.TOKENIZER)
    rng = random.Random(11)
    letters = [*"aBzİıßÉéñΣςǅﬁ१Ⅷ²中カ́̇֍क़क़ড়שׁགྷ̈́", *" \n\t\x0b\u00a0\u3000", *".,;:!?'\"()[]{}<>|/-_#$%&*+=@^`~", "'s", "'LL", "<|endoftext|>", "0", "12"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(10_000)] + ["YENİ, SERİ.", "TÜRKİ,", "(İ)", "İ."]
    got = chunks.of(pa.array([t.encode() for t in texts], pa.binary()))
    want = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    wrong = [t for t, g, w in zip(texts, got, want, strict=True) if memoryview(g).cast("I").tolist() != w]
    assert not wrong, wrong[:5]


def test_stages_take_columns_of_any_name(spark, rows):
    import corpus_pipeline

    names = ["__id", "__tie", "__text", "__starts", "__n_runs", "_range", "label", "n_words", "kept", "size", "column0"]
    plain = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    more = plain.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)]).select(*reversed(names), *plain.columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, "")
        assert out.columns == more.columns, name
        assert {tuple(r) for r in out.select(names).distinct().collect()} == {tuple(range(len(names)))}, name
        assert sorted(map(repr, out.select(plain.columns).collect())) == sorted(map(repr, stage(spark, plain, "").collect())), name
    assert corpus_pipeline.packed(spark, more, "").count() == corpus_pipeline.packed(spark, plain, "").count()


def test_bpe(docs, empty, rows):
    enc = bpe.encoding()
    want = collections.Counter((r[0], tuple(enc.encode_ordinary(r[1] or ""))) for r in rows)
    coded = bpe.encode_documents(docs)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == want
    assert collections.Counter((r.doc_id, bytes(r.bytes)) for r in bpe.decode_documents(coded).collect()) == collections.Counter((r[0], (r[1] or "").encode()) for r in rows)
    assert bpe.digests(empty).count() == 0


@pytest.mark.parametrize("text", ["a b " * 40_000, "x" + " " * 9000 + "y  z", "\n" * 5000, "a" * 70_000 + " b", "w.  " * 20_000])
def test_long_texts_are_cut_where_the_pattern_cuts(text):
    assert bpe.encode(text) == bpe.encoding().encode_ordinary(text)
    assert "".join(p for p, _ in bpe.pieces(text, 1000)) == text


def test_quality_rules(docs, empty, rows):
    def counts(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len({j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)})

    got = quality_rules.with_counts(docs.select("doc_id", "source", "text")).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == collections.Counter((r[0], *counts(r[1])) for r in rows)
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {r[0] for r in rows if counts(r[1])[0] >= 50}
    assert quality_rules.filter_documents(empty).count() == 0


def test_hosts_that_mostly_fail_go(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "few words"
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, bad if i % 10 else good, "bad") for i in range(40)]
    kept = quality_rules.filter_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.source for r in kept.collect()} == {"good"} and kept.count() == 40


def test_sharding(docs, empty, rows):
    out = sharding.shard_documents(docs, 4).collect()
    assert sharding.shard_documents(empty, 4).count() == 0
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    text = {r[0]: r[1] for r in rows if r[0] != 8}
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in out if r.doc_id != 8)
    homes = collections.defaultdict(set)
    slots = collections.defaultdict(list)
    for r in out:
        homes[text.get(r.doc_id, "8")].add(r.shard) if r.doc_id != 8 else None
        slots[r.shard].append(r.slot)
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_capacity_is_the_least():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 30) for _ in range(12)]
        sums = [sum(sizes[:i]) for i in range(13)]

        def best(i, k):
            return sums[12] - sums[i] if k == 1 else min(max(sums[j] - sums[i], best(j, k - 1)) for j in range(i, 13))

        assert sharding.capacity(sums, 3)[0] == best(0, 3)


def test_line_dedup(docs, empty, rows):
    got = {(r.doc_id, r["__n_removed"]): r.text for r in line_dedup.dedup_lines(docs.filter("doc_id IN (0, 12, 13)")).collect()}
    assert got == {(0, 0): None, (12, 0): "l1 a\nl2 b\nl3 c\n\nl4 d", (13, 3): "zz\n\nyy"}
    assert line_dedup.dedup_documents(docs).columns == docs.columns
    assert line_dedup.dedup_documents(empty).count() == 0


def test_line_dedup_takes_a_long_line_for_a_run(spark):
    passage, short = " ".join(f"w{i}" for i in range(52)), " ".join(f"s{i}" for i in range(19))
    made = [(1, f"a b\n{passage}\nc d\n{short}"), (2, f"e f\n{passage}\ng h\n{short}\ni j"), (3, passage), (4, f"{passage}\nk l\n{passage}"), (5, None)]
    made = [(i, t, len(t or "")) for i, t in made]
    docs = spark.createDataFrame(made, "doc_id long, text string, n_chars long").repartition(3)
    got = {r.doc_id: r.text for r in line_dedup.dedup_documents(docs).collect()}
    assert got == {1: made[0][1], 2: f"e f\ng h\n{short}\ni j", 3: "", 4: "k l", 5: None}
    assert {r.doc_id: r["__n_removed"] for r in line_dedup.dedup_lines(docs).collect()} == dict.fromkeys(range(1, 6), 0)


def tree(text):
    """(fingerprint, paragraphs' hashes, leaves) by the definition."""
    h = lambda t: f"{xxhash.xxh64(t.encode(), seed=42).intdigest():016x}"
    leaves = [[h(m) for m in re.findall(r"(?:[^ ]+ *| +){1,8}", p)] for p in text.split("\n")]
    paragraphs = [h(" ".join(x)) for x in leaves]
    sections = [h(" ".join(paragraphs[i : i + 8])) for i in range(0, len(paragraphs), 8)]
    root = hashlib.sha256(" ".join(sections).encode()).hexdigest()[:32]
    flat = [x for p in leaves for x in p]
    return ";".join([root, " ".join(sections), " ".join(paragraphs), " ".join(flat)]), paragraphs, set(flat)


@pytest.mark.parametrize("range_rows", [1000, 4])
def test_merkle(docs, empty, rows, monkeypatch, range_rows):
    monkeypatch.setattr(merkle, "RANGE_ROWS", range_rows)
    assert merkle.edit_report(empty).count() == 0
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    ordered = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (-r[0], signed(xxhash.xxh64(r[1].encode(), seed=42).intdigest())))
    like = lambda a, b: 1.0 if a[0] == b[0] else 2 * len(a[2] & b[2]) / max(1, len(a[2]) + len(b[2]))
    want = collections.Counter()
    for i, (k, t) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        edited = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        own, other, after = tree(t), tree(edited), tree(following)
        differ = tuple(n for n in range(max(len(own[1]), len(other[1]))) if own[1][n : n + 1] != other[1][n : n + 1])
        want[k, len(t), hashlib.sha256(edited.encode()).hexdigest(), own[0], other[0], round(like(own, other), 12), round(like(own, after), 12), differ] += 1
    out = merkle.edit_report(docs).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12), tuple(r.edited_paragraphs)) for r in out) == want
    prints = {r.doc_id: r.fingerprint for r in out}
    assert prints[5] == prints[6] and len({r.fingerprint for r in out}) == len({r[1] or "" for r in rows})


def test_differing_paragraphs(spark):
    a = "\n".join(f"line {i}" for i in range(30))
    row = spark.createDataFrame([(a, a.replace("line 17", "other"))], "a string, b string")
    assert row.select(merkle.differing_paragraphs(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b")))).head()[0] == [17]


@pytest.mark.parametrize("module,target,marks", [(quality_classifier, "quality", ("fine prose of words", "SPAM!! BUY!! NOW!!")), (toxicity, "toxic", ("you vile clown", "a calm day in may"))])
def test_classifiers_on_held_out_rows(spark, empty, module, target, marks):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(5)) for _ in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=30)) + " " + marks[i % 2]) for i in range(600)] + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(600)], f"doc_id long, {target} int")
    out = module.score_documents(docs, labels, threshold=0.5).collect()
    assert len(out) == 602 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 600]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum(r.predicted == 1 - r.doc_id % 2 for r in held) >= 0.97 * len(held)
    assert module.score_documents(empty.select("doc_id", "text"), labels.limit(0)).count() == 0
    assert linear.train(linear.training_rows(docs, labels.limit(0), target), quality_classifier.features, 1 << 18).sum() == 0


def test_ftrl_is_the_plain_loop():
    rng = np.random.default_rng(3)
    rows = [(np.r_[0, 1 + rng.choice(19, 4, replace=False)], rng.normal(size=5), int(rng.integers(2))) for _ in range(60)]
    alpha, beta, l1, l2 = 0.3, 1.0, 0.05, 0.7
    z, n = [0.0] * 20, [0.0] * 20
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else ((1 if z[i] > 0 else -1) * l1 - z[i]) / ((beta + n[i] ** 0.5) / alpha + l2)
    for _ in range(2):
        for places, values, label in rows:
            w = [weight(i) for i in places]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, values, strict=True))))
            for i, x, wi in zip(places, values, w, strict=True):
                g = (p - label) * x
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * wi
                n[i] += g * g
    assert np.allclose(linear.ftrl(rows, 20, 2, alpha, beta, l1, l2), [weight(i) for i in range(20)])


def test_ratios_and_scaled_counts_are_counted_one_by_one(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["aab", "bba", "Ünd", "cc\tdd", "vile"], k=rng.randint(0, 9))) for _ in range(150)]
    rows = [(i, t, int("vile" in t) if i % 9 else 1 - int("vile" in t)) for i, t in enumerate(texts)] + [(900, "", 0), (901, texts[3], 1), (901, texts[3], 1)]
    whole = [np.concatenate([np.empty(0, np.int64), *toxicity.grams(t.encode())]) for _, t, _ in rows]
    for t, at in zip(texts, whole, strict=False):
        folded = f" {' '.join(t.lower().split())} "
        assert len(at) == sum(max(0, len(folded) - n + 1) for n in toxicity.SIZES)
        distinct = len({folded[i : i + n] for n in toxicity.SIZES for i in range(len(folded) - n + 1)})
        assert 0 <= distinct - len(set(at)) <= 2  # of 2^20 places few are shared
    monkeypatch.setattr(toxicity, "PART", 5)  # parts give the same n-grams
    for (_, t, _), at in zip(rows, whole, strict=True):
        assert sorted(np.concatenate([np.empty(0, np.int64), *toxicity.grams(t.encode())])) == sorted(at)
    got = toxicity.ratios(spark.createDataFrame(rows, "doc_id long, text string, label int").withColumn("text", F.col("text").cast("binary")).repartition(3))
    held, n = (collections.Counter(), collections.Counter()), [0, 0]
    for (_, _, label), at in zip(rows, whole, strict=True):
        held[label].update(set(at.tolist()))
        n[label] += 1
    for at in set(held[0]) | set(held[1]):
        prior = [toxicity.PRIOR_ROWS * k / sum(n) for k in n]
        want = math.log((held[1][at] + prior[1]) / n[1] / ((held[0][at] + prior[0]) / n[0]))
        assert abs(got[at] - (want if abs(want) >= toxicity.LEAST_RATIO and at else 0)) < 1e-9
    assert np.count_nonzero(got) <= len(set(held[0]) | set(held[1]))
    at, x = toxicity.scaled(got)(b"vile vile aab")
    n = collections.Counter(np.concatenate(list(toxicity.grams(b"vile vile aab"))).tolist())
    assert at[0] == 0 and x[0] == 1 and {int(a): round(float(v), 9) for a, v in zip(at[1:], x[1:], strict=True)} == {a: round(float(got[a] * math.log2(1 + c)), 9) for a, c in n.items() if got[a]}


@pytest.mark.parametrize("module,target,marks", [(quality_classifier, "quality", ("fine prose of words", "SPAM!! BUY!!")), (toxicity, "toxic", ("you vile clown", "a calm day in may"))])
def test_classifiers_on_repeats_nulls_and_other_columns(spark, module, target, marks):
    rows = [(i % 90, marks[i % 2], 5, "x", 1) for i in range(180)] + [(None, marks[0], 5, "x", 1), (None, None, 5, "x", 1), (7, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, part string, score int")
    labels = spark.createDataFrame([(i, 1 - i % 2, 3) for i in range(90)] + [(None, 1, 3), (2, None, 3), (4, 1, 3), (4, 1, 3)], f"doc_id long, {target} int, text int")
    out = module.score_documents(docs, labels, threshold=0.5).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(r[0] for r in rows) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out}) <= 3 and all(not r.held_out for r in out if r.doc_id is None)
    assert all(len({r.score for r in out if r.doc_id == i}) == 1 for i in range(90) if i != 7)


def test_pipeline_stages(spark, docs, rows):
    import corpus_pipeline

    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, "")
        assert at.columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, at, "").count() > 0


def test_words_with_equal_sums_of_powers_are_told_apart(spark):
    assert len(set(common.word_hashes(" ".join(TWINS).encode()).tolist())) == 2
    tokenizer, memo = packing._tokenizer(packing.TOKENIZER), packing.ChunkIds(packing.TOKENIZER)
    texts = [*TWINS, "", " a. b,  c.. ,", "İ İ x.", "a <|endoftext|> b", "don't | stop!!", "Wörter&&& Ünd, ñ$$$ 12.5%"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):  # learning and remembering
        assert [memoryview(x).cast("I").tolist() for x in memo.of(pa.array([t.encode() for t in texts], pa.binary()))] == want
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TWINS)], "doc_id long, text string")
    assert {r.id: r.group for r in jaccard_join.joined(docs).collect()} == {0: 0, 1: 1}
    assert quality_rules.text_counts(" ".join([TWINS[0], "x", "y", TWINS[1], "x", "y"]).encode())[4] == 0


def test_even_cuts_keep_the_least_capacity():
    rng = random.Random(3)
    for _ in range(100):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 40))]
        sums = [sum(sizes[:i]) for i in range(len(sizes) + 1)]
        most = sharding.capacity(sums, 4)[0]
        cuts = [0, *sharding.even_cuts(sums, 4, most), len(sizes)]
        assert cuts == sorted(cuts) and max(sums[b] - sums[a] for a, b in zip(cuts, cuts[1:])) <= most


def test_tables_are_deleted_once_they_are_dropped(spark):
    with common.Tables(spark) as tables:
        kept, gone = tables.keep(tables.write(spark.range(3))), tables.write(spark.range(2))
        path = gone.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert os.path.isdir(path)
    assert not os.path.isdir(path) and kept.count() == 3


def test_batches_are_cut_by_bytes():
    batch = pa.record_batch([pa.array([b"x" * n for n in (10, 10, 500, 3, 0, 0, 90)], pa.binary())], names=["t"])
    assert [[len(x) for x in b.column(0).to_pylist()] for b in common.slices(batch, 100)] == [[10, 10], [500], [3, 0, 0, 90]]
    assert sum(b.num_rows for b in common.slices(batch.slice(1, 5), 100)) == 5
