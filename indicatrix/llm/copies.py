"""Groups of texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8. Exact; nothing is sampled away.

Two sets of similarity t share an element among the first n - ceil(t n) + 1 of each under any one order of all elements, so
an equality join on these prefixes meets every pair. Shingles that a bounded sample holds often come last in the order; that
only saves work. Repeated texts are one text from the start.

Two filters drop pairs before any text moves; neither loses a link. At the first shingle that two sets share, what they share
lies at or behind its place in both, so a meeting at a place too far back is none. And each set has an odd sketch: bit k says
whether an odd number of its shingles falls into slot k. Every bit in which two sketches differ is a shingle that one set lacks, so
sets whose sketches differ in more bits than similar sets can differ in shingles are not similar. Joins test that while they meet rows,
on sketches folded to one width. A sketch grows with its set, as one of fixed width says nothing about long sets; pairs of long
texts are tested on whole sketches before their texts move. What is left is compared on whole sets.

Members of one component need no comparison, so four rounds find the links, each over what those before left apart: every text
with the first of its component by SimHash, and with the hubs of its groups; then with second hubs; then all members of small groups;
then all members of crowded ones. A hub is a group's first member in an order of the group's own, one of a few in the first round, so
that groups of the same texts bring the same pairs. After the hubs, groups of up to three members, and those in one component, are done.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.simhash import components, near_duplicates
from indicatrix.llm.store import discard, stored
from indicatrix.llm.words import Hasher, bounds, buffers, chunks, mixed

WIDTH = 5
# The similarity as a fraction.
SHARED, OF = 4, 5
SAMPLE_TEXTS, COMMON = 16_000, 500_000
CROWD = 64
# Orders of members that hubs of the first round are the first of.
ORDERS = 8
# Longs of an odd sketch that is folded, and the fewest of any; whole ones have a bit for each shingle or more.
SKETCH = 16


def text_key(name: str = "text") -> Column:
    """What identifies a text; null is empty."""
    return F.xxhash64(F.coalesce(F.col(name).cast("string"), F.lit("")))


def shingle_sets(batch_column, hasher: Hasher):
    """Sorted distinct shingle hashes of each text, in lower-case ASCII; a shorter text is one shingle, also one without words."""
    data, offsets = buffers(batch_column)
    scale = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WIDTH)], np.uint64)
    for first, last, part, cuts in chunks(data, offsets):
        starts, ends, text = bounds(part, cuts)
        hashes = hasher.words(part, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        at = np.searchsorted(text, np.arange(last - first + 1))
        for i in range(last - first):
            words = hashes[at[i] : at[i + 1]]
            n = max(1, len(words) - WIDTH + 1)
            total = np.zeros(n, np.uint64)
            for k in range(min(WIDTH, len(words))):
                total += words[k : k + n] * scale[k]
            yield np.unique(mixed(total + np.uint64(min(WIDTH, len(words)))).view(np.int64))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(text_key().alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def sets_of(texts: DataFrame) -> DataFrame:
    """key and shingles of each row."""

    def run(batches):
        hasher = Hasher(seed=11, lower=True)
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), hasher))
            cuts = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(cuts), values)], ["key", "shingles"])

    return texts.mapInArrow(run, "key long, shingles array<long>")


def alike(pairs: DataFrame) -> DataFrame:
    """a and b of the rows a, b, one, other whose texts ``one`` and ``other`` have sets similar enough."""

    def run(batches):
        hasher = Hasher(seed=11, lower=True)
        for batch in batches:
            keep = []
            for one, other in zip(shingle_sets(batch.column(2), hasher), shingle_sets(batch.column(3), hasher)):
                shared = len(np.intersect1d(one, other, assume_unique=True))
                # Similarity as shared / (sizes - shared), in whole numbers.
                keep.append((SHARED + OF) * shared >= SHARED * (len(one) + len(other)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "one", "other").mapInArrow(run, "a long, b long")


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a bounded sample hold, sorted, and their counts; at most COMMON of them."""
    n = texts.count()
    part = int(min(1.0, SAMPLE_TEXTS / max(n, 1)) * 1_000_003) + 1
    sample = texts.where(F.pmod(F.xxhash64("key"), F.lit(1_000_003)) < part)
    counts = sets_of(sample).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n")).where("n > 2")
    found = counts.orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow()
    values, sizes = (found.column(c).to_numpy() for c in ("shingle", "n"))
    order = np.argsort(values)
    return values[order].astype(np.int64), sizes[order].astype(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Which slots an odd number of shingles falls into, as SKETCH longs doubled until there are as many slots as shingles."""
    size = 64 * SKETCH
    while size < len(shingles):
        size *= 2
    slots = np.bincount((shingles & (size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(slots.astype(np.uint8), bitorder="little").view(np.int64)


def prefixes(texts: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """shingle, key, size of the set and place for the shingles that come first in each set, one row per text and shingle.

    The row of place 0 has the sketch of the set.
    """
    sent = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        known, counts = sent.value
        hasher = Hasher(seed=11, lower=True)
        for batch in batches:
            first, sizes, sketches = [], [], []
            for shingles in shingle_sets(batch.column(1), hasher):
                n = len(shingles)
                rank = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                    rank = np.where(known[at] == shingles, counts[at], 0)
                order = np.argsort(rank, kind="stable")
                first.append(shingles[order[: n - -(-SHARED * n // OF) + 1]])
                sizes.append(n)
                sketches += [odd_sketch(shingles).tolist(), *[None] * (len(first[-1]) - 1)]
            each = [len(f) for f in first]
            keys = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), each)
            values = np.concatenate(first) if first else np.zeros(0, np.int64)
            places = np.arange(len(values)) - np.repeat(np.cumsum(each) - each, each)
            numbers = [pa.array(np.asarray(n, np.int32)) for n in (np.repeat(sizes, each), places)]
            sent_sketches = pa.array(sketches, pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(values), pa.array(keys), *numbers, sent_sketches], ["shingle", "key", "size", "place", "sketch"])

    return texts.mapInArrow(run, "shingle long, key long, size int, place int, sketch array<long>")


def folded(sketch: Column) -> Column:
    """The sketch as SKETCH longs: slots that are a multiple of its bits apart are one."""
    parts = F.sequence(F.lit(0), (F.size(sketch) / SKETCH).cast("int") - 1)
    one = lambda k: F.aggregate(parts, F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(sketch, j * SKETCH + k)))
    return F.when(F.size(sketch) == SKETCH, sketch).otherwise(F.array(*(one(k) for k in range(SKETCH))))


def narrow(sketches: DataFrame) -> Column:
    """The folded sketch, read where the table holds it: its expression is long, and every plan that has it is kept by the driver."""
    return F.col("folded") if "folded" in sketches.columns else folded(F.col("sketch"))


def few_differ(differ: Column, a: Column, b: Column) -> Column:
    """Whether sets of sizes a and b that differ in so many shingles or more can be similar enough.

    Similar ones differ in (a + b) / 9 at most, and the smaller has 4 / 5 of the larger or more.
    """
    return (F.lit(OF) * F.least(a, b) >= F.lit(SHARED) * F.greatest(a, b)) & (F.lit(SHARED + OF) * differ <= F.lit(OF - SHARED) * (a + b))


def enough_alike(one: Column, other: Column, a: Column, b: Column) -> Column:
    """Whether sets of sizes a and b with these folded sketches can be similar enough."""
    return few_differ(sum((F.bit_count(one[k].bitwiseXOR(other[k])) for k in range(SKETCH)), F.lit(0)), a, b)


def wholly_alike(one: Column, other: Column, a: Column, b: Column) -> Column:
    """The same on whole sketches. One may be folded once: widths of sets of similar sizes are at most twice one another."""
    width = F.least(F.size(one), F.size(other))
    xor = lambda x, y: x.bitwiseXOR(y)
    one, other = (F.when(F.size(x) == width, x).otherwise(F.zip_with(F.slice(x, 1, width), F.slice(x, width + 1, width), xor)) for x in (one, other))
    differ = F.aggregate(F.zip_with(one, other, xor), F.lit(0), lambda n, x: n + F.bit_count(x))
    return few_differ(differ, a, b)


def likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs a, b whose sketches and sizes allow them to be similar enough."""

    def both(some: DataFrame, facts: DataFrame, test) -> DataFrame:
        one = some.join(facts.withColumnsRenamed({"key": "a", "size": "size_a", "sketch": "one"}), "a")
        met = one.join(facts.withColumnsRenamed({"key": "b", "size": "size_b", "sketch": "other"}), "b")
        return met.where(test(F.col("one"), F.col("other"), F.col("size_a"), F.col("size_b")))

    short = sketches.select("key", "size", narrow(sketches).alias("sketch"))
    left = stored(both(pairs.distinct(), short, enough_alike).select("a", "b", F.least("size_a", "size_b").alias("least")), "pairs-of-folded")
    # Sketches of one side that are not wider than folded ones say no more.
    wide = left.where(F.col("least") > 64 * SKETCH).select("a", "b")
    if wide.isEmpty():
        return left.select("a", "b")
    kept = both(wide, sketches.select("key", "size", "sketch").where(F.size("sketch") > SKETCH), wholly_alike).select("a", "b")
    out = stored(left.where(F.col("least") <= 64 * SKETCH).select("a", "b").union(kept), "likely-pairs")
    discard(left)
    return out


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b whose sets are similar enough. Texts travel, which are smaller than their sets."""
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    chosen = stored(texts.join(wanted, "key", "left_semi"), "candidate-texts")
    half = pairs.join(chosen.withColumnsRenamed({"key": "a", "text": "one"}), "a")
    out = stored(alike(half.join(chosen.withColumnsRenamed({"key": "b", "text": "other"}), "b")), "similar-pairs")
    discard(chosen)
    return out


def grown(found: DataFrame | None, pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Components, and those that ``pairs`` add to them. Each text meets one other first; pairs that this joins up need no comparison."""
    pairs = likely(pairs, sketches)
    if found is not None and pairs.isEmpty():
        discard(pairs)
        return found
    first = stored(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    found = joined(found, verified(first, texts))
    root = {end: found.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b")}
    placed_ = pairs.join(root["a"], "a", "left").join(root["b"], "b", "left")
    rest = placed_.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b").join(first, ["a", "b"], "left_anti")
    rest = stored(rest, "other-pairs")
    if not rest.isEmpty():
        found = joined(found, verified(rest, texts))
    discard(pairs, first, rest)
    return found


def joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of those found and the links, which are deleted."""
    out = components(links if found is None else links_of(found).union(links))
    discard(links, *([] if found is None else [found]))
    return out


def by_fingerprint(texts: DataFrame) -> DataFrame:
    """a and b: the first text of each component by SimHash fingerprints of WIDTH words, and each other one of it."""
    grouped = near_duplicates(texts.withColumnRenamed("key", "doc_id"), WIDTH)
    return stored(grouped.where("doc_id != component_id").select(F.col("component_id").alias("a"), F.col("doc_id").alias("b")), "alike-by-fingerprint")


def roots(docs: DataFrame) -> DataFrame:
    """node and root of the texts, by ``text_key``, that are similar to another one; root is the same in a whole group.

    Groups are connected components. Texts without a similar one are left out.
    """
    texts = stored(keyed(docs).groupBy("key").agg(F.min("text").alias("text")), "texts")
    first = stored(prefixes(texts, common_shingles(texts)), "prefixes")
    sketches = stored(first.where("place = 0").select("key", "size", "sketch", folded(F.col("sketch")).alias("folded")), "sketches")
    shared = stored(hubs_of(first, F.xxhash64(F.pmod("shingle", F.lit(ORDERS))), F.count("*").alias("n")).where("n > 1"), "shared-shingles")
    members = stored(first.drop("sketch").join(shared, "shingle"), "prefix-groups")
    discard(first, shared)

    marked = by_fingerprint(texts)
    found = grown(None, marked.union(to_hubs(members)), sketches, texts)
    discard(marked)
    members, all_ = split_members(members.where("n > 2"), found), members
    discard(all_)
    others = members.where("key != hub").drop("hub")
    again = others.join(hubs_of(others, F.xxhash64("shingle", F.lit(ORDERS))), "shingle")
    found = grown(found, to_hubs(again), sketches, texts)
    members, all_ = split_members(members.where("n > 3"), found), members
    discard(all_)
    few = placed(members.where(F.col("n") <= CROWD).drop("hub", "n"), found, sketches)
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, apart() & (F.col("a.key") < F.col("b.key"))).select(F.col("a.key").alias("a"), F.col("b.key").alias("b"))
    found = grown(found, pairs, sketches, texts)
    discard(few)
    crowd = members.where(F.col("n") > CROWD)
    if not crowd.isEmpty():
        found = crowded(crowd, found, sketches, texts)
    discard(members, sketches, texts)
    return found


def hubs_of(members: DataFrame, turn: Column, *more: Column) -> DataFrame:
    """shingle and hub of each group: the member that comes first when all are turned by a number of the shingle's own."""
    low = F.min(F.col("key").bitwiseXOR(turn)).alias("low")
    return members.groupBy("shingle").agg(low, *more).withColumn("hub", F.col("low").bitwiseXOR(turn)).drop("low")


def to_hubs(members: DataFrame) -> DataFrame:
    """Each member with its group's hub, as pairs a < b."""
    return members.where("key != hub").select(F.least("hub", "key").alias("a"), F.greatest("hub", "key").alias("b"))


def split_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the groups that are not in one component."""
    placed = members.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    split = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return stored(members.join(split.select("shingle"), "shingle", "left_semi"), "split-groups")


def links_of(found: DataFrame) -> DataFrame:
    """Components as links: each node with its root."""
    return found.select(F.col("node").alias("a"), F.col("root").alias("b"))


def apart() -> Column:
    """Rows a and b of one shingle that are in different components and may be the first meeting of similar sets."""
    behind = F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place"))
    enough = F.lit(SHARED + OF) * behind >= F.lit(SHARED) * (F.col("a.size") + F.col("b.size"))
    alike_ = enough_alike(F.col("a.sketch"), F.col("b.sketch"), F.col("a.size"), F.col("b.size"))
    return (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") != F.col("b.root")) & enough & alike_


def placed(members: DataFrame, found: DataFrame, sketches: DataFrame) -> DataFrame:
    """Members with their components so far, and their folded sketches."""
    facts = sketches.join(found.withColumnRenamed("node", "key"), "key", "left").select("key", narrow(sketches).alias("sketch"), F.coalesce("root", "key").alias("root"))
    return stored(members.join(facts, "key"), "placed")


def crowded(crowd: DataFrame, found: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Components with the links between members of crowded groups that are in different ones so far."""
    hubs = found.select(F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    rows = crowd.join(hubs, "hub", "left").withColumn("hub_root", F.coalesce("hub_root", "hub")).drop("hub", "n")
    rows = placed(rows, found, sketches)
    # Of two members in different components one at least is not in that of the hub.
    a, b = rows.where("root != hub_root").alias("a"), rows.alias("b")
    pairs = a.join(b, apart()).select(F.least("a.key", "b.key").alias("a"), F.greatest("a.key", "b.key").alias("b"))
    out = grown(found, pairs, sketches, texts)
    discard(rows)
    return out
