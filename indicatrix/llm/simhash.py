"""SimHash fingerprints, their links at a few differing bits, and connected components.

Links are found by a segment-popcount embedding. A fingerprint is cut into 32 segments of two bits; the popcounts of the
segments, each written in unary, make its ``cell`` of 64 bits, so that the Manhattan distance of two popcount vectors is
the number of differing cell bits, and a lower bound of the Hamming distance. The segments form ``radius + 3`` blocks. A
pair within Manhattan distance ``radius`` agrees on at least three whole blocks, so a range join over the grid is an
equality join on every choice of three blocks; the bound is tested on all segments, then the fingerprints themselves.

Grid cells of more than ``pair_limit`` fingerprints are not paired. Their members are grouped by every value that differs
from them in up to radius / 2 bits: two fingerprints share such a value exactly if they are within the radius, and a value
has a fixed number of such neighbours. Nothing is dropped either way.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.store import discard, stored

LOW_BITS = 0x5555555555555555
SEED = 42


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def majority(hashes: np.ndarray) -> int:
    """The value whose bits are those set in over half of the hashes."""
    n = len(hashes)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    full = n // 255 * 255
    counts = bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    counts += bits[full:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, width: int) -> int:
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and the signed 64-bit fingerprint of each whole text; a null text is empty, an empty one has fingerprint 0."""

    def run(batches):
        for batch in batches:
            texts = (b"" if t is None else t for t in batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array([fingerprint(t, width) for t in texts], pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, fp long"
    )


def cell_of(fp: Column) -> Column:
    """Popcounts of the two-bit segments, in unary: 0 is 00, 1 is 01, 2 is 11."""
    low, high = fp.bitwiseAND(F.lit(LOW_BITS)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def block_masks(radius: int) -> list[int]:
    """Masks over a cell of all choices of three blocks among radius + 3."""
    blocks = [sum(3 << 2 * int(segment) for segment in part) for part in np.array_split(np.arange(32), radius + 3)]
    return [signed(a | b | c) for a, b, c in combinations(blocks, 3)]


def near_pairs(distinct: DataFrame, radius: int = 2, pair_limit: int = 64) -> DataFrame:
    """Links a, b that join all fingerprints within ``radius`` differing bits; for crowded grid cells only enough of them.

    ``distinct`` holds one row per fingerprint ``fp``.
    """
    masks = block_masks(radius)
    keys = F.array(*(F.struct(F.lit(i).alias("grid"), F.col("cell").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)))
    on_grid = distinct.select("fp", cell_of(F.col("fp")).alias("cell")).select("fp", F.inline(keys))
    shared = stored(on_grid.groupBy("grid", "key").agg(F.count("*").alias("n")).where("n > 1"), "grid-cells")
    members = stored(on_grid.join(shared, ["grid", "key"]), "grid-members")

    few = members.where(F.col("n") <= pair_limit).withColumn("cell", cell_of(F.col("fp")))
    a, b = few.alias("a"), few.alias("b")
    apart = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y)))
    pairs = a.join(
        b,
        (F.col("a.grid") == F.col("b.grid"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (apart("a.cell", "b.cell") <= radius)
        & (apart("a.fp", "b.fp") <= radius),
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    out = stored(pairs.union(crowded_links(members.where(F.col("n") > pair_limit).select("fp").distinct(), radius)).distinct(), "near-pairs")
    discard(shared, members)
    return out


def crowded_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links between fingerprints that share a value at most radius / 2 bits away from both; radius is 0 or 2."""
    if radius not in (0, 2):
        raise ValueError("crowded cells are resolved for a radius of 0 or 2")
    flips = [0, *(signed(1 << i) for i in range(64))] if radius else [0]
    near = distinct.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(F.lit(x)) for x in flips))).alias("near"))
    groups = near.groupBy("near").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    return groups.select(F.element_at("fps", 1).alias("a"), F.explode(F.slice(F.col("fps"), 2, 64)).alias("b"))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of these links that are not the smallest of their component, and the smallest of each."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    one, other = ends[: len(a)], ends[len(a) :]
    while len(one):
        x, y = root[one], root[other]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up
        left = root[one] != root[other]
        one, other = one[left], other[left]
    low = root != np.arange(len(nodes))
    return nodes[low], nodes[root[low]]


# Links that are held at a time in a task.
HELD = 1 << 20


def shortened(links: DataFrame, whole: bool = False) -> DataFrame:
    """Links a > b that join the same nodes, with those of a task, up to HELD at a time, made stars. Never more than before.

    ``whole`` adds a row for each smallest node with itself.
    """
    limit = HELD

    def run(batches):
        def made(held):
            ends = stars(*(np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(2)))
            if whole:
                ends = [np.concatenate([x, np.unique(ends[1])]) for x in ends]
            return pa.record_batch([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= limit:
                yield made(held)
                held, n = [], 0
        if held:
            yield made(held)

    return links.select("a", "b").where("a != b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and root of all nodes that have links; root is the smallest node of the component.

    Links within a task become stars at once, and again in no more tasks than they need, so that few rounds are left. If that is
    one task, which holds HELD links at most, its stars are the result. Otherwise
    large-star and small-star rounds alternate until all links form stars. Links are written to the shared folder after each
    round; minima are aggregated before the shuffle and joined as stored tables, so a hub is split. They also tell whether the
    links are stars, and then are the result. Each table goes, with the shuffles behind it, as soon as the next is written.
    """
    edges = stored(shortened(links), "links")
    tasks = max(1, -(-edges.count() // HELD))
    if len(edges.inputFiles()) > tasks:
        loose, edges = edges, stored(shortened(edges.coalesce(tasks)), "links")
        discard(loose)
    if tasks == 1:
        low = stored(shortened(edges.coalesce(1), whole=True), "lows")
        discard(edges)
        return low.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Stars: a node is linked to one smaller one, or to larger ones only.
        odd = (F.min("b") < F.col("a")) & (F.max("b") > F.min("b"))
        low = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), odd.alias("odd")), "lows")
        if low.where("odd").isEmpty():
            discard(edges)
            return low.select(F.col("a").alias("node"), F.col("low").alias("root"))
        # Large star: larger neighbours of a node are linked to its smallest neighbour.
        large = stored(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b").distinct(), "links")
        discard(edges, low)
        # Small star: smaller neighbours of a node, and the node, are linked to the smallest of them.
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), "lows")
        linked = large.join(low, "a")
        edges = stored(
            linked.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b").union(low.select("a", F.col("low").alias("b"))).distinct(), "links"
        )
        discard(large, low)


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, pair_limit: int = 64) -> DataFrame:
    """doc_id, fingerprint and component_id of each document; documents link at ``radius`` or fewer differing bits.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows give repeated rows. A null doc_id takes
    part but never names a component unless it has no other member. Other columns are ignored. An empty table gives none.
    """
    marked = stored(fingerprints(docs, width), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    pairs = near_pairs(distinct.select("fp"), radius, pair_limit)
    roots = components(pairs)
    rooted = stored(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted"
    )
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    named = stored(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    discard(distinct, pairs, roots, rooted, smallest)
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
