"""N-gram Jaccard join: documents whose sets of five-word shingles are alike to 0.8 or more, and their components.

Documents with equal sets are one class from the start, however many copies there are. Classes are joined exactly:

* Shingles stand in one global order: those found in many prefixes last (a fixed-size bitmap tells which), else by hash.
  Two sets that link share a shingle among the first ``size - ceil(0.8 size) + 1`` of each, so only these are indexed,
  with their positions.
* In each index list every set is first paired with the list's head, the set of which most is shared with others, so a
  list gives as many pairs as it has sets. A pair is compared only if its prefixes share enough for it to link at all.
  Linked sets form components.
* Within a list only sets of different components are still to be paired, with a skip of the block of positions whose
  rest cannot hold enough common shingles. A list of at most SHORT sets pairs them directly.
* In a longer list their answers come from the head's: with x and y shingles in common with a head of size t, two sets
  share c if and only if their differences from the head (what one has and the other lacks) share c + t - x - y. Where one
  of the two does not link with the head, that is one at least for every c that links. So lists of differences are joined
  in place of lists of sets, rare ones first. Each set first meets the first of its lists of differences, so that the
  components that there are within a list are known before its sets are paired.
* Entries of such lists are skipped by position too: two differences that must share k have one in common among the
  first size - k + 1 of each. The block of positions that no partner can reach, all but a quarter of the set's size, is
  never listed: what only the head has comes last there, which far sets have in common without being alike.
* What remains is compared by the sets themselves.

Words are runs of anything but ASCII white space, A-Z in lower case. A set is the distinct five-word shingles; with
fewer words the whole sequence is the one shingle; nulls and texts without words have an empty set and link with
nothing, not with each other either. Rows with one doc_id count as separate documents of one name. An empty table gives
no rows. Other columns pass through the stage and are not read by the join. Shingles are known by 64-bit hashes of their
words' hashes, equal sets by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from junctionflow.llm.common import Tables, any_columns, distinct, documents, keyed, mix, ngrams, over_batches, signed, utf8, word_hashes

WORDS = 5
#: Two sets link when PERCENT_OF * common >= PERCENT * union.
PERCENT, PERCENT_OF = 80, 100
#: Prefixes that share a shingle from which it is put last, and the bits that name the places of the bitmap that tells
#: so: about a place for each shingle of the prefixes, up to a bitmap of 16 MB.
FREQUENT, BITMAP_BITS = 12, (20, 27)
#: Sets up to which a list pairs them directly, not by their differences from its head.
SHORT = 16
#: Differences right before one that a set's entry in a list of differences carries.
BEFORE = 24
#: Longs of 64 bits that mark all listed differences of a set: a mark that only one of two sets has is a difference that they don't share.
MARKS = 12


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, in ascending order."""
    h = word_hashes(text, lower=True)
    return distinct(ngrams(h, min(words, len(h)))) if len(h) else h


def prefix_length(size: int) -> int:
    return size - -(-PERCENT * size // PERCENT_OF) + 1 if size else 0


def places(found: np.ndarray, bits: int) -> np.ndarray:
    return (mix(found) >> np.uint64(64 - bits)).astype(np.int64)


def prefix(found: np.ndarray, frequent: np.ndarray | None = None, bits: int = 0) -> np.ndarray:
    """The first shingles in the global order; ``found`` is in ascending order, ``frequent`` the bitmap."""
    n = prefix_length(len(found))
    if frequent is None:
        return found[:n]
    at = places(found, bits)
    late = (frequent[at >> 3] >> (7 - (at & 7))) & 1 == 1
    return np.concatenate([found[~late], found[late]])[:n]


def frequent_bitmap(docs: DataFrame, tables: Tables, words: int = WORDS) -> tuple[np.ndarray, int]:
    """Packed bits of the places whose shingles many prefixes share, and their number as a power of two. It only sets
    the order, which any bitmap leaves right."""
    low, high = BITMAP_BITS
    bits = min(high, max(low, (docs.count() * 128).bit_length()))

    def per_batch(text):
        place, n = np.unique(np.concatenate([places(prefix(shingles(t, words)), bits) for t in text]), return_counts=True)
        return {"place": place.astype(np.int32), "n": n.astype(np.int32)}

    counted = over_batches(docs.select(utf8().alias("text")), per_batch, "place int, n int").groupBy("place").agg(F.sum("n").alias("n"))
    # FREQUENT, or eight times what a place holds on average as they fill up
    filled = tables.write(counted.groupBy((F.col("n") >= FREQUENT).alias("many"), F.when(F.col("n") >= FREQUENT, F.col("place")).alias("place")).agg(F.sum("n").alias("n")))
    mean = (filled.agg(F.sum("n").alias("n")).head().n or 0) / (1 << bits)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: dict[int, int] = {}
        for b in batches:
            at = b.column(0).to_numpy()
            for byte, bit in zip((at >> 3).tolist(), (1 << (7 - (at & 7))).tolist(), strict=True):
                marks[byte] = marks.get(byte, 0) | bit
        if marks:
            yield pa.RecordBatch.from_arrays([pa.array(list(marks), pa.int32()), pa.array(list(marks.values()), pa.int16())], ["byte", "bits"])

    out = np.zeros(1 << (bits - 3), np.uint8)
    marked = filled.filter(F.col("many") & (F.col("n") >= max(FREQUENT, 8 * mean))).select("place").mapInArrow(packed, "byte int, bits short").toArrow()  # bytes of the bitmap
    np.bitwise_or.at(out, marked["byte"].to_numpy(), marked["bits"].to_numpy().astype(np.uint8))
    tables.drop(filled)
    return out, bits


def sets(docs: DataFrame, tables: Tables, words: int = WORDS) -> DataFrame:
    """id, tie, size, same, prefix: a row for each document; equal sets have the same ``same``."""
    bitmap, bits = frequent_bitmap(docs, tables, words)
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)  # 16 MB at most

    def per_batch(id, tie, text):  # noqa: A002
        out: dict[str, list] = {"id": id, "tie": tie, "size": [], "same": [], "prefix": []}
        for t in text:
            s = shingles(t, words)
            for name, value in zip(("size", "same", "prefix"), (len(s), xxhash.xxh3_128_digest(s.tobytes()), signed(prefix(s, sent.value, bits))), strict=True):
                out[name].append(value)
        return out

    return over_batches(keyed(docs).select(F.col("__id").alias("id"), F.col("__tie").alias("tie"), utf8().alias("text")), per_batch, "id long, tie long, size int, same binary, prefix array<long>")


def _need(a: str, b: str) -> Column:
    """Shingles that sets of these sizes must share to link, at least: the least c with 100 c >= 80 (a + b - c)."""
    return F.ceil(F.lit(PERCENT) * (F.col(a) + F.col(b)) / F.lit(PERCENT + PERCENT_OF))


def _sizes_fit(a: str, b: str) -> Column:
    return F.lit(PERCENT_OF) * F.least(a, b) >= F.lit(PERCENT) * F.greatest(a, b)


def texts_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """cls, text of the classes in ``pairs`` (a, b), each by one of its documents."""
    named = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    wanted = classes.join(named, "cls").select(F.col("one.id").alias("__id"), F.col("one.tie").alias("__tie"), "cls")
    found = keyed(docs).select("__id", "__tie", utf8().alias("text")).join(wanted, ["__id", "__tie"]).dropDuplicates(["__id", "__tie"])  # as the join has dealt them
    return found.select("cls", "text")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, left, right: pairs with the texts of both."""
    both = pairs.select("a", "b").join(texts.select(F.col("cls").alias("a"), F.col("text").alias("left")), "a")
    return both.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("right")), "b").select("a", "b", "left", "right")


class _Recent:
    """Shingles of texts, the last one remembered: rows come sorted by b, so that a head's set is made once."""

    def __init__(self, words: int):
        self.words, self.text, self.found = words, None, None

    def __call__(self, text: bytes) -> np.ndarray:
        if text != self.text:
            self.text, self.found = text, shingles(text, self.words)
        return self.found


def _inside(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of x are in y, both in ascending order and not empty."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def links(pairs: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """a, b of the pairs of classes whose sets link."""

    def per_batch(a, b, left, right):
        recent, out = _Recent(words), {"a": [], "b": []}
        for i, j, x, y in zip(a, b, left, right, strict=True):
            x, y = shingles(x, words), recent(y)
            c = int(_inside(x, y).sum())
            if PERCENT_OF * c >= PERCENT * (len(x) + len(y) - c):
                out["a"].append(i)
                out["b"].append(j)
        return out

    return over_batches(with_texts(pairs, texts), per_batch, "a long, b long")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, tables: Tables, words: int = WORDS) -> DataFrame:
    """The table of the pairs that link."""
    texts = tables.write(texts_of(docs, classes, pairs))
    found = tables.write(links(pairs, texts, words))
    tables.drop(texts)
    return found


def marked(differs: np.ndarray) -> np.ndarray:
    """The marks of differences, a bit for each, by its hash."""
    bits = np.zeros(64 * MARKS, np.uint8)
    bits[mix(differs) % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.int64)


def against_heads(pairs: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """a, b, common, skipped, differs, marks for sets a and heads b: the shingles that just one of both has, those of a first,
    without the last ones (``skipped`` of them), which no set that links with a needs.

    A set that links with a is a quarter larger at most, so that both have at most a quarter of a's size that the other
    lacks. It shares the rest of the difference from b. Differences no larger than a are whole: with these, how
    many a pair must share is told more sharply.
    """

    def per_batch(a, b, left, right):
        recent, out = _Recent(words), {"a": a, "b": b, "common": [], "skipped": [], "differs": [], "marks": []}
        for x, y in zip(left, right, strict=True):
            x, y = shingles(x, words), recent(y)
            inside = _inside(x, y)
            c = int(inside.sum())
            n = len(x) + len(y) - 2 * c
            skipped = n - len(x) // 4 - 1 if n > len(x) else 0
            differs = x[~inside]
            if len(differs) < n - skipped:
                differs = np.concatenate([differs, np.setdiff1d(y, x, assume_unique=True)])
            out["common"].append(c)
            out["skipped"].append(skipped)
            out["differs"].append(signed(differs[: n - skipped]))
            out["marks"].append(marked(differs[: n - skipped]))
        return out

    return over_batches(with_texts(pairs, texts), per_batch, "a long, b long, common int, skipped int, differs array<long>, marks array<long>")


def may_link(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b of the pairs whose prefixes share enough. What two sets share lies in both prefixes, up to the end of the
    prefix that ends first, or in the rest of that set; so common shingles are at most those of the prefixes and the
    longer rest."""
    sides = [classes.select(F.col("cls").alias(s), F.col("size").alias(f"{s}_size"), F.col("prefix").alias(f"{s}_prefix")) for s in "ab"]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    most = F.size(F.array_intersect("a_prefix", "b_prefix")) + F.greatest(*[F.col(f"{s}_size") - F.size(f"{s}_prefix") for s in "ab"])
    return both.filter(_sizes_fit("a_size", "b_size") & (most >= _need("a_size", "b_size"))).select("a", "b")


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """node, label for every node of ``edges`` (a, b): the least node that it reaches.

    Nodes take the least label in their neighbourhood and then that label's own (pointer doubling), so rounds grow with
    the logarithm of the longest chain. Each round is written to the shared folder.
    """
    both = tables.write(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    written = tables.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")))
    while True:
        labels = written.select("node", "label")
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        # a node's old label hears of the new one too, so that trees hook onto each other
        heard = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        hooks = heard.filter("least < label").groupBy(F.col("label").alias("node")).agg(F.min("least").alias("hook"))
        merged = heard.join(hooks, "node", "left").select("node", F.col("label").alias("old"), F.coalesce(F.least("least", "hook"), F.col("least")).alias("label"))
        roots = merged.select(F.col("node").alias("label"), F.col("label").alias("root"))
        new = tables.write(merged.join(roots, "label", "left").select("node", "old", F.coalesce("root", "label").alias("label")))
        changed = new.filter("label < old").limit(1).count()
        tables.drop(written)
        written = new
        if not changed:
            tables.drop(both)
            return written


def still_open(lists: DataFrame, labels: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The sets of lists whose sets are not all of one component, but for heads, which have met all: of short lists
    shingle, cls, size, place, label; of long ones a, the head b, label."""
    side = tables.write(labelled(lists, "cls", labels))
    mixed = side.groupBy("shingle").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("shingle", (F.col("n") <= SHORT).alias("short"))
    open_ = tables.write(side.filter(F.col("cls") != F.col("head")).join(mixed, "shingle"))
    tables.drop(side)
    long = open_.filter("NOT short").groupBy(F.col("cls").alias("a"), F.col("head").alias("b")).agg(F.first("label").alias("label"))
    return open_.filter("short"), long


def short_pairs(short: DataFrame) -> DataFrame:
    """a, b: sets of one short list that may still link, as far as this list tells."""
    left, right = (short.select("shingle", *[F.col(c).alias(f"{s}_{c}") for c in ("cls", "label", "size", "place")]) for s in "ab")
    # of the first list that both are in: this shingle and those after it, of the set that has fewer left, must be enough
    after = F.least(*[F.col(f"{s}_size") - F.col(f"{s}_place") for s in "ab"])
    both = left.join(right, "shingle").filter((F.col("a_cls") < F.col("b_cls")) & (F.col("a_label") != F.col("b_label")) & _sizes_fit("a_size", "b_size") & (after >= _need("a_size", "b_size")))
    return both.select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).distinct()


def listed_differences(compared: DataFrame, open_: DataFrame, classes: DataFrame, tables: Tables) -> DataFrame:
    """b, shingle, a, ...: the differences of the sets of long lists from their heads that other sets have too, with their
    places, rare ones first, and what else is known of a."""
    sizes = classes.select("cls", "size")
    often = compared.select("b", F.explode("differs").alias("shingle")).groupBy("b", "shingle").agg(F.count("*").alias("n")).filter("n > 1")
    listed = compared.select("a", "b", "skipped", F.size("differs").alias("differ"), F.explode("differs").alias("shingle")).join(often, ["b", "shingle"])
    of_set = Window.partitionBy("a", "b")  # a set's difference from one head; what is found nowhere else stands first
    listed = listed.withColumn("place", F.col("differ") - F.count("*").over(of_set) + F.row_number().over(of_set.orderBy("n", "shingle")))
    # those right before it: two sets that share one of these too have met there or earlier
    listed = listed.withColumn("before", F.collect_list("shingle").over(of_set.orderBy("n", "shingle").rowsBetween(-BEFORE, -1)))
    heads = open_.groupBy("a").agg(F.array_sort(F.collect_set("b")).alias("heads"))
    known = open_.join(compared.select("a", "b", "common", "marks"), ["a", "b"]).join(sizes.toDF("a", "size"), "a").join(sizes.toDF("b", "of_head"), "b").join(heads, "a")
    marks = [F.col("marks")[i].alias(f"mark{i}") for i in range(MARKS)]
    listed = listed.select("a", "b", "shingle", "skipped", "differ", "place", "before").join(known, ["a", "b"]).select("*", *marks).drop("marks")
    return tables.write(listed.withColumn("unmarked", F.col("differ") - sum(F.bit_count(f"mark{i}") for i in range(MARKS))))  # by a mark of its own


#: What a list of differences tells of a set.
_KNOWN = ("a", "label", "size", "of_head", "common", "skipped", "differ", "place", "unmarked", *[f"mark{i}" for i in range(MARKS)])


def _may_share(a: str, b: str) -> Column:
    """Whether two sets of one list of differences may link, as far as their differences tell. Of those that both must have,
    so many are listed for both: one of these stands among the first of each, and no more are in both than have a mark of
    both or none of their own. ``a`` and ``b`` begin the names of their columns."""
    must = _need(f"{a}size", f"{b}size") + F.col(f"{a}of_head") - F.col(f"{a}common") - F.col(f"{b}common")
    listed_too = F.greatest(must - F.greatest(f"{a}skipped", f"{b}skipped"), F.lit(1))
    most = F.least(*[F.col(f"{s}differ") - F.col(f"{s}place") + 1 for s in (a, b)])
    marks = sum((F.bit_count(F.col(f"{a}mark{i}").bitwiseAND(F.col(f"{b}mark{i}"))) for i in range(MARKS)), F.least(f"{a}unmarked", f"{b}unmarked"))
    return _sizes_fit(f"{a}size", f"{b}size") & (listed_too <= F.least(most, marks))


def first_pairs(listed: DataFrame) -> DataFrame:
    """a, b: each set with the first of every list of differences that it is in, where the list doesn't rule out that they
    link. Sets that are nearer to each other than to the head share many, so most of their components show here, from
    at most as many pairs as there are entries; pairs left out here are still met among long_pairs."""
    first = listed.groupBy("b", "shingle").agg(F.min(F.struct(*_KNOWN)).alias("first"))
    met = listed.join(first, ["b", "shingle"]).filter((F.col("a") != F.col("first.a")) & (F.col("label") != F.col("first.label")) & _may_share("", "first."))
    return met.select("a", F.col("first.a").alias("b")).distinct()


def long_pairs(listed: DataFrame) -> DataFrame:
    """a, b: sets of one long list that may still link, from their differences from the least head that both have."""
    left, right = (listed.select("b", "shingle", *[F.col(c).alias(f"{s}_{c}") for c in (*_KNOWN, "heads", "before")]) for s in "ab")
    one = F.col("b") == F.array_min(F.array_intersect("a_heads", "b_heads"))
    anew = ~F.arrays_overlap("a_before", "b_before")  # never false where two sets first meet
    pairs = left.join(right, ["b", "shingle"]).filter((F.col("a_a") < F.col("b_a")) & (F.col("a_label") != F.col("b_label")) & _may_share("a_", "b_") & anew & one)  # the cheap ones first
    return pairs.select(F.col("a_a").alias("a"), F.col("b_a").alias("b")).distinct()


def labelled(rows: DataFrame, name: str, labels: DataFrame) -> DataFrame:
    """rows with the label of the class in column ``name``, its own where it has none."""
    return rows.drop("label").join(labels.select(F.col("node").alias(name), "label"), name, "left").withColumn("label", F.coalesce("label", name))


def linked_classes(docs: DataFrame, classes: DataFrame, tables: Tables, words: int = WORDS) -> DataFrame:
    """node, label: the components of the ``classes`` (cls, size, one, prefix) that link with another."""
    # one long for size and place keeps the rows of the widest shuffle small
    entries = classes.select("cls", "size", F.posexplode("prefix").alias("place", "shingle")).select("shingle", "cls", (F.col("size").cast("long") * (1 << 32) + F.col("place")).alias("at"))
    shared = tables.write(entries.groupBy("shingle").count().filter("count > 1").select("shingle"))
    lists = tables.write(entries.join(shared, "shingle", "left_semi").select("shingle", "cls", F.shiftright("at", 32).cast("int").alias("size"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("place")))
    tables.drop(shared)
    # the head of a list is its set of which most is shared with others: in a group of edited copies, what they come from
    own = lists.groupBy("cls").agg(F.round(1000 * (1 - F.count("*") / F.max(F.col("size") - F.ceil(F.col("size") * PERCENT / PERCENT_OF) + 1))).cast("int").alias("own"))
    heads = tables.write(lists.join(own, "cls").groupBy("shingle").agg(F.min(F.struct("own", "cls")).alias("head")).select("shingle", F.col("head.cls").alias("head")))
    headed = tables.write(lists.join(heads, "shingle"))
    tables.drop(lists, heads)
    stars = headed.filter(F.col("cls") != F.col("head")).select(F.col("cls").alias("a"), F.col("head").alias("b")).distinct()
    stars = tables.write(may_link(stars, classes))
    found = verified(docs, classes, stars, tables, words)
    tables.drop(stars)
    labels = components(found, tables)

    short, long = still_open(headed, labels, tables)
    tables.drop(headed)
    long = tables.write(long)
    texts = tables.write(texts_of(docs, classes, long))
    compared = tables.write(against_heads(long, texts, words))
    tables.drop(texts)
    listed = listed_differences(compared, long, classes, tables)
    tables.drop(compared)
    pairs = tables.write(may_link(first_pairs(listed), classes))
    if not pairs.isEmpty():
        found = found.unionByName(verified(docs, classes, pairs, tables, words))
        labels = components(found, tables)
    pairs = tables.write(may_link(short_pairs(labelled(short, "cls", labels)).unionByName(long_pairs(labelled(listed, "a", labels))).distinct(), classes))
    if pairs.isEmpty():
        return labels
    return components(found.unionByName(verified(docs, classes, pairs, tables, words)), tables)


def joined(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """id, tie, size, group: a row for each document; ``group`` is the least id of its component."""
    with Tables(docs.sparkSession) as tables:
        every = tables.write(sets(docs, tables, words))
        classes = every.filter("size > 0").groupBy("same", "size").agg(F.min(F.struct("id", "tie")).alias("one"), F.first("prefix").alias("prefix"))
        classes = tables.write(classes.withColumn("cls", F.monotonically_increasing_id()))  # a short name, written with the class
        names = tables.write(every.drop("prefix"))
        tables.drop(every)
        labels = linked_classes(docs, classes, tables, words)
        named = classes.select("same", "cls", F.col("one.id").alias("id")).join(labels.select(F.col("node").alias("cls"), "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        groups = named.select("same", "label").join(named.groupBy("label").agg(F.min("id").alias("group")), "label").select("same", "group")
        return tables.keep(tables.write(names.join(groups, "same", "left").select("id", "tie", "size", F.when(F.col("size") > 0, F.col("group")).otherwise(F.col("id")).alias("group"))))


@any_columns
def dedup_documents(docs: DataFrame) -> DataFrame:
    """docs with the same columns: of each component the row with the least doc_id (then hash) stays, one row only
    where it is repeated. Rows without words link with nothing and all stay."""
    found = joined(docs)
    # of the rows that bear the least id of a component, the one with the least hash; equal rows are one
    best = found.filter("size > 0").groupBy("group").agg(F.min(F.struct("id", "tie")).alias("one")).select(F.col("one.id").alias("__id"), F.col("one.tie").alias("__tie"))
    kept = keyed(docs).join(best, ["__id", "__tie"], "left_semi").dropDuplicates(["__id", "__tie"])  # as the join has dealt them
    wordless = docs.filter(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*docs.columns).unionByName(wordless)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = joined(documents(spark, sf_dir))
    return out.select(F.when(F.col("id") != -(1 << 63), F.col("id")).alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), F.when(F.col("group") != -(1 << 63), F.col("group")).alias("component_id"))
