"""Boosted trees grown leaf by leaf, for the log loss, on binned features.

Rows lie in packed blocks that are read in every pass; nothing but histograms, bounded groups of rows and splits moves. A tree
always splits the leaf of greatest gain next, up to a number of leaves. That order needs no pass per split: gains do not depend on it. Each pass
looks for the best splits of all nodes that the order may reach next. Nodes of many rows are summed into histograms, by Spark, in chunks of
bins, so no task sees all of them; the rows of a node of at most ``LOCAL_ROWS`` go to one task, which grows everything below it.
Gradients are whole numbers (of 2^-24), so sums do not depend on the order of addition, and trees not on partitions or on who grew them.

Margins of the rows are written into the blocks every ``KEEP`` rounds and worked out from the trees since, so any pass can
be run again from stored tables.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatrix.session import materialise

# Functions of this module travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = 1 << 24
LOCAL_ROWS = 100_000
BLOCK_ROWS = 8192
KEEP = 10
CHUNK_BINS = 8192
PASS_BYTES = 256 << 20
BLOCK = "id long, rows int, labels binary, weights binary, margins binary, places binary, features binary, bins binary"


@dataclass(frozen=True)
class Growth:
    """How trees grow. ``l1`` and ``l2`` shrink the values of leaves; shares are of rows and columns, drawn per tree."""

    rounds: int = 300
    rate: float = 0.05
    leaves: int = 63
    bins: int = 255
    least_rows: int = 20
    least_curvature: float = 1e-3
    l1: float = 0.0
    l2: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 42


@dataclass
class Node:
    """Sums of a node (gradient, curvature, rows) and its best split, if it has one that gains."""

    sums: tuple[int, int, int]
    gain: float = 0.0
    feature: int = -1
    bin: int = -1
    children: tuple[Node, Node] | None = None
    known: bool = False


@dataclass
class Tree:
    """Nodes as lists; a leaf has feature -1. Rows with a value up to the threshold, or a bin up to the bin, go left."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)


# -- bins -------------------------------------------------------------------------


def edges_of(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature but its last: values at even ranks of those that are not zero, and zero."""

    def run(batches):
        for batch in batches:
            _, indices, values = sparse(batch.column(0))
            yield pa.record_batch([pa.array(indices, pa.int32()), pa.array(values)], ["feature", "value"])

    grid = [i / (bins - 1) for i in range(1, bins - 1)]
    listed = rows.select("features").mapInArrow(run, "feature int, value double").where("value <> 0 AND NOT isnan(value)")
    found = listed.groupBy("feature").agg(F.array_distinct(F.percentile_approx("value", grid, 100 * bins)).alias("edges"))
    edges = [np.zeros(1)] * width
    for row in found.collect():  # at most width * bins numbers
        edges[row["feature"]] = np.unique([0.0, *row["edges"]])
    return edges


def sparse(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of entries of each vector, their indices and values; entries of dense vectors count one by one."""
    kinds, values = column.field(0).to_numpy(zero_copy_only=False), column.field(3)
    if (kinds == 0).all():
        counts = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return counts, column.field(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64), values.flatten().to_numpy(zero_copy_only=False)
    counts, places, entries = [], [np.zeros(0, np.int64)], [np.zeros(0)]
    for kind, at, value in zip(kinds, column.field(2).to_pylist(), values.to_pylist()):
        counts.append(len(value))
        places.append(np.array(at if kind == 0 else range(len(value)), np.int64))
        entries.append(np.array(value, float))
    return np.array(counts, np.int64), np.concatenate(places), np.concatenate(entries)


@dataclass(frozen=True)
class Binning:
    """Edges of all features one after the other. Feature f has bins first[f] to first[f + 1] - 1, the last one without edge."""

    edges: np.ndarray
    first: np.ndarray
    zero: np.ndarray  # the bin of zero, among those of its feature

    @classmethod
    def of(cls, edges: list[np.ndarray]) -> Binning:
        sizes = np.array([len(e) + 1 for e in edges])
        return cls(np.concatenate([np.append(e, np.inf) for e in edges]), np.concatenate([[0], np.cumsum(sizes)]), np.array([int(np.searchsorted(e, 0.0)) for e in edges]))

    @property
    def width(self) -> int:
        return len(self.zero)

    def places(self, features: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The bin of each value among those of its feature; what is no number goes to the last one."""
        low, high = self.first[features].copy(), self.first[features + 1] - 1
        last = high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            right = open_ & ~(values <= self.edges[middle])
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return np.minimum(low, last) - self.first[features]


def pack(rows: DataFrame, binning: Binning, margin: float) -> DataFrame:
    """Blocks of rows, by feature: for each, the rows whose bin is not that of zero, and their bins."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                counts, features, values = sparse(part.column(0))
                bins = binning.places(features, values)
                row = np.repeat(np.arange(part.num_rows), counts)
                kept = np.flatnonzero(bins != binning.zero[features])
                kept = kept[np.argsort(features[kept], kind="stable")]
                label, weight = (part.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in (1, 2))
                margins = np.full(part.num_rows, margin)
                fields = [label, weight, margins, row[kept].astype(np.int32), features[kept].astype(np.int32), bins[kept].astype(np.int32)]
                number += 1
                yield pa.record_batch([pa.array([number]), pa.array([part.num_rows], pa.int32()), *(pa.array([f.tobytes()]) for f in fields)], BLOCK_NAMES)

    return rows.select("features", F.col("label").cast("double"), F.col("weight").cast("double")).mapInArrow(run, BLOCK)


BLOCK_NAMES = [c.split()[0] for c in BLOCK.split(", ")]


class Block:
    """A block's rows in a task."""

    def __init__(self, row: dict):
        self.id, self.n = row["id"], row["rows"]
        self.labels, self.weights, self.margins = (np.frombuffer(row[c]) for c in ("labels", "weights", "margins"))
        self.places, self.features, self.bins = (np.frombuffer(row[c], np.int32) for c in ("places", "features", "bins"))

    def bins_of(self, feature: int, zero: int) -> np.ndarray:
        low, high = np.searchsorted(self.features, [feature, feature + 1])
        out = np.full(self.n, zero, np.int32)
        out[self.places[low:high]] = self.bins[low:high]
        return out

    def leaves(self, tree: Tree, binning: Binning) -> np.ndarray:
        """The node of a tree in which each row ends."""
        at = np.zeros(self.n, np.int64)
        for node, feature in enumerate(tree.feature):
            if feature >= 0 and (here := np.flatnonzero(at == node)).size:
                left = self.bins_of(feature, int(binning.zero[feature]))[here] <= tree.bin[node]
                at[here] = np.where(left, tree.left[node], tree.right[node])
        return at

    def margins_after(self, trees: list[Tree], binning: Binning) -> np.ndarray:
        out = self.margins.copy()
        for tree in trees:
            out += np.array(tree.value)[self.leaves(tree, binning)]
        return out

    def gradients(self, trees: list[Tree], binning: Binning, growth: Growth, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradient and curvature of the rows as whole numbers, and whether tree ``number`` sees a row."""
        p = 1 / (1 + np.exp(-self.margins_after(trees, binning)))
        g, h = np.rint(self.weights * (p - self.labels) * UNIT), np.rint(self.weights * p * (1 - p) * UNIT)
        seen = np.ones(self.n, bool)
        if growth.row_share < 1:
            seen = np.random.default_rng([growth.seed, number, self.id]).random(self.n) < growth.row_share
        return g.astype(np.int64), h.astype(np.int64), seen


# -- splits -----------------------------------------------------------------------


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def score_of(g, h, growth: Growth):
    """What a leaf of these sums takes off the loss, times two."""
    g, h = np.asarray(g) / UNIT, np.asarray(h) / UNIT
    return shrunk(g, growth.l1) ** 2 / np.maximum(h + growth.l2, 1e-300)


def leaf_value(sums: tuple[int, int, int], growth: Growth) -> float:
    g, h = sums[0] / UNIT, sums[1] / UNIT
    return float(-growth.rate * shrunk(np.array(g), growth.l1) / max(h + growth.l2, 1e-300))


def best_split(histogram: np.ndarray, sums: tuple[int, int, int], features: np.ndarray, binning: Binning, growth: Growth, allowed: np.ndarray):
    """(gain, feature, bin, sums of the left side) of the best split of a node, or None.

    ``histogram`` has gradient, curvature and rows of the bins of some features in order, without the rows in the bin of zero. Of
    equal gains the first feature and bin counts.
    """
    sizes = binning.first[features + 1] - binning.first[features]
    starts = np.cumsum(sizes) - sizes
    histogram = histogram.copy()
    histogram[:, starts + binning.zero[features]] += np.array(sums)[:, None] - np.add.reduceat(histogram, starts, axis=1)
    total = np.cumsum(histogram, axis=1)
    before = np.where(starts > 0, total[:, starts - 1], 0)
    g, h, n = left = total - np.repeat(before, sizes, axis=1)
    other = np.array(sums)[:, None] - left
    least = growth.least_curvature * UNIT
    fits = (n >= growth.least_rows) & (other[2] >= growth.least_rows) & (h >= least) & (other[1] >= least) & np.repeat(allowed[features], sizes)
    if not fits.any():
        return None
    gains = np.where(fits, score_of(g, h, growth) + score_of(other[0], other[1], growth) - score_of(sums[0], sums[1], growth), -np.inf)
    at = int(np.argmax(gains))
    if not gains[at] > 1e-10:
        return None
    k = int(np.searchsorted(starts, at, "right")) - 1
    return float(gains[at]), int(features[k]), at - int(starts[k]), tuple(int(x) for x in left[:, at])


def columns_of(growth: Growth, number: int, width: int) -> np.ndarray:
    """Which columns a tree may split on."""
    if growth.column_share >= 1:
        return np.ones(width, bool)
    chosen = np.zeros(width, bool)
    chosen[np.random.default_rng([growth.seed, number]).permutation(width)[: max(1, round(width * growth.column_share))]] = True
    return chosen


def counted(key: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """Gradient, curvature and rows of each of ``size`` bins; g and h are whole numbers as doubles."""
    return np.stack([np.bincount(key, g[rows], size), np.bincount(key, h[rows], size), np.bincount(key, minlength=size)]).astype(np.int64)


def local_splits(places, features, bins, g, h, sums, binning: Binning, growth: Growth, allowed: np.ndarray) -> list[tuple]:
    """Best-first splits below a node whose rows are all here: (parent, side, gain, feature, bin, left sums); parent -1 is the node itself.

    Entries are sorted by feature. ``parent`` counts splits in the order of the list. Of two children the one with fewer
    entries is counted, the other is what is left of the histogram above.
    """
    n = len(g)
    g, h = g.astype(np.float64), h.astype(np.float64)
    # A feature without entries has all rows in one bin.
    present, own = np.unique(features, return_inverse=True)
    sizes = binning.first[present + 1] - binning.first[present]
    key, size = (np.cumsum(sizes) - sizes)[own] + bins, int(sizes.sum())

    heap: list = []

    def push(parent: int, side: int, rows, entries, total, histogram) -> None:
        if total[2] < 2 * growth.least_rows or not len(entries):
            return
        found = best_split(histogram, total, present, binning, growth, allowed)
        if found:
            heapq.heappush(heap, (-found[0], 2 * (parent + 1) + side, parent, side, rows, entries, total, found, histogram))

    push(-1, 0, np.arange(n), np.arange(len(features)), sums, counted(key, places, g, h, size))
    out: list[tuple] = []
    inside = np.zeros(n, bool)
    while heap and len(out) < growth.leaves - 1:
        *_, parent, side, rows, entries, total, found, histogram = heapq.heappop(heap)
        gain, feature, bin_, left_sums = found
        number = len(out)
        out.append((parent, side, gain, feature, bin_, left_sums))
        if len(out) == growth.leaves - 1:
            break
        low, high = np.searchsorted(features, [feature, feature + 1])
        value = np.full(n, binning.zero[feature], np.int64)
        value[places[low:high]] = bins[low:high]
        go_left = value[rows] <= bin_
        left = rows[go_left]
        inside[left] = True
        in_left = inside[places[entries]]
        inside[left] = False
        right_sums = tuple(a - b for a, b in zip(total, left_sums))
        parts = [entries[in_left], entries[~in_left]]
        fewer = int(len(parts[1]) < len(parts[0]))
        below = counted(key[parts[fewer]], places[parts[fewer]], g, h, size)
        both = [below, histogram - below] if fewer == 0 else [histogram - below, below]
        push(number, 0, left, parts[0], left_sums, both[0])
        push(number, 1, rows[~go_left], parts[1], right_sums, both[1])
    return out


# -- passes over the blocks -------------------------------------------------------------


@dataclass(frozen=True)
class Pass:
    """What the tasks of a pass need to know."""

    binning: Binning
    growth: Growth
    trees: list[Tree]  # since margins were stored
    number: int  # of the tree that grows
    partial: Tree  # as far as it is known; its leaves are asked about


def gathered(blocks: DataFrame, asked: list[int], now: Pass) -> dict[int, list[tuple]]:
    """Splits below each asked leaf of the partial tree, grown by one task per leaf out of its rows."""

    def send(batches):
        wanted = np.full(len(now.partial.feature), -1)
        wanted[asked] = asked
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                g, h, seen = block.gradients(now.trees, now.binning, now.growth, now.number)
                leaf = np.where(seen, wanted[block.leaves(now.partial, now.binning)], -1)
                for node in np.unique(leaf[leaf >= 0]).tolist():
                    mine = np.flatnonzero(leaf == node)
                    place = np.full(block.n, -1)
                    place[mine] = np.arange(len(mine))
                    entry = np.flatnonzero(place[block.places] >= 0)
                    fields = [g[mine], h[mine], place[block.places[entry]].astype(np.int32), block.features[entry], block.bins[entry]]
                    yield pa.record_batch([pa.array([node]), pa.array([block.id]), *(pa.array([f.tobytes()]) for f in fields)], ["node", "id", "g", "h", "places", "features", "bins"])

    def grow(batches):
        # Rows come by node and block. A node has at most LOCAL_ROWS of them.
        held: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["node"] not in held:  # the one before is complete
                    yield from (grown(node, rows) for node, rows in held.items())
                    held.clear()
                held.setdefault(row["node"], []).append(row)
        yield from (grown(node, rows) for node, rows in held.items())

    def grown(node, rows):
        allowed = columns_of(now.growth, now.number, now.binning.width)
        parts = [[np.frombuffer(r[c], kind) for c, kind in (("g", np.int64), ("h", np.int64), ("places", np.int32), ("features", np.int32), ("bins", np.int32))] for r in rows]
        shift = np.cumsum([0, *(len(p[0]) for p in parts)])
        g, h, _, features, bins = (np.concatenate(x) for x in zip(*parts))
        places = np.concatenate([p[2] + s for p, s in zip(parts, shift)])
        order = np.argsort(features, kind="stable")
        sums = (int(g.sum()), int(h.sum()), len(g))
        found = local_splits(places[order], features[order].astype(np.int64), bins[order].astype(np.int64), g, h, sums, now.binning, now.growth, allowed)
        return pa.record_batch([pa.array([node]), pa.array([json.dumps([sums, found])])], ["node", "found"])

    kind = "node long, id long, g binary, h binary, places binary, features binary, bins binary"
    sent = blocks.mapInArrow(send, kind)
    dealt = sent.repartition(min(len(asked), 64), "node").sortWithinPartitions("node", "id")
    rows = dealt.mapInArrow(grow, "node long, found string").collect()  # at most one row per asked leaf
    return {row["node"]: json.loads(row["found"]) for row in rows}


def summed(blocks: DataFrame, asked: list[int], now: Pass) -> dict[int, tuple]:
    """(sums, best split or None) of each asked leaf of the partial tree, from histograms that Spark adds up by chunks of bins."""
    binning = now.binning
    # Features of each chunk.
    cuts = [0]
    for f in range(binning.width):
        if binning.first[f + 1] - binning.first[cuts[-1]] > CHUNK_BINS and f > cuts[-1]:
            cuts.append(f)
    cuts.append(binning.width)
    allowed = columns_of(now.growth, now.number, binning.width)

    def count(batches):
        slot = np.full(len(now.partial.feature), -1)
        slot[asked] = np.arange(len(asked))
        size = int(binning.first[-1])
        total, sums = np.zeros((3, len(asked) * size), np.int64), np.zeros((3, len(asked)), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                g, h, seen = block.gradients(now.trees, binning, now.growth, now.number)
                at = np.where(seen, slot[block.leaves(now.partial, binning)], -1)
                mine = at >= 0
                entry = np.flatnonzero(mine[block.places])
                key = at[block.places[entry]] * size + binning.first[block.features[entry]] + block.bins[entry]
                # Sorting the bins of a block pays only where it touches few of them.
                touched = slice(None)
                if total.shape[1] > 4 * len(key):
                    touched, key = np.unique(key, return_inverse=True)
                total[:, touched] += counted(key, block.places[entry], g.astype(np.float64), h.astype(np.float64), total[0, touched].size)
                for k, w in enumerate((g, h, np.ones(block.n, np.int64))):
                    sums[k] += np.bincount(at[mine], w[mine], len(asked)).astype(np.int64)
        for k, node in enumerate(asked):
            for chunk, (low, high) in enumerate(zip(cuts, cuts[1:])):
                part = total[:, k * size + binning.first[low] : k * size + binning.first[high]]
                yield pa.record_batch(
                    [pa.array([node]), pa.array([chunk]), pa.array([sums[:, k].tobytes()]), pa.array([np.ascontiguousarray(part).tobytes()])], ["node", "chunk", "sums", "part"]
                )

    def choose(key, table):
        node, chunk = (k.as_py() for k in key)
        add = lambda column: np.sum([np.frombuffer(b.as_buffer(), np.int64) for b in table.column(column)], axis=0).reshape(3, -1)
        sums, features = tuple(int(x) for x in add("sums").ravel()), np.arange(cuts[chunk], cuts[chunk + 1])
        found = best_split(add("part"), sums, features, binning, now.growth, allowed)
        return pa.table({"node": [node], "found": [json.dumps([sums, found])]})

    best: dict[int, tuple] = {}
    sent = blocks.mapInArrow(count, "node long, chunk long, sums binary, part binary")
    for row in sent.groupBy("node", "chunk").applyInArrow(choose, "node long, found string").collect():  # leaves * chunks rows
        sums, found = json.loads(row["found"])
        before = best.get(row["node"], (tuple(sums), None))[1]
        if found and (before is None or (-found[0], *found[1:3]) < (-before[0], *before[1:3])):
            before = found
        best[row["node"]] = (tuple(sums), before)
    return best


# -- one tree -----------------------------------------------------------------------------


def order_of(root: Node, leaves: int) -> tuple[list[Node], list[Node]]:
    """Nodes in the order in which they are split, and nodes it reaches of which nothing is known yet."""
    split: list[Node] = []
    open_ = [] if root.known else [root]
    heap, count = [], 0
    if root.known and root.gain > 0:
        heap = [(-root.gain, 0, root)]
    while heap and len(split) < leaves - 1:
        node = heapq.heappop(heap)[2]
        split.append(node)
        for child in node.children:
            count += 1
            if not child.known:
                open_.append(child)
            elif child.gain > 0:
                heapq.heappush(heap, (-child.gain, count, child))
    return split, open_


def set_split(node: Node, found, growth: Growth) -> None:
    node.known = True
    if found:
        node.gain, node.feature, node.bin = found[0], found[1], found[2]
        left = tuple(found[3])
        node.children = tuple(Node(s, known=s[2] < 2 * growth.least_rows) for s in (left, tuple(a - b for a, b in zip(node.sums, left))))


def as_tree(root: Node, split: list[Node], growth: Growth, binning: Binning) -> tuple[Tree, list[Node]]:
    """The tree of the chosen splits, and the node behind each of its places."""
    chosen = {id(n) for n in split}
    tree, nodes, at = Tree(), [root], 0
    while at < len(nodes):
        node = nodes[at]
        if id(node) in chosen:
            tree.feature.append(node.feature)
            tree.bin.append(node.bin)
            tree.threshold.append(float(binning.edges[binning.first[node.feature] + node.bin]))
            tree.left.append(len(nodes))
            tree.right.append(len(nodes) + 1)
            tree.value.append(0.0)
            nodes += node.children
        else:
            for values, x in ((tree.feature, -1), (tree.bin, -1), (tree.threshold, 0.0), (tree.left, -1), (tree.right, -1), (tree.value, leaf_value(node.sums, growth))):
                values.append(x)
        at += 1
    return tree, nodes


def grown_tree(blocks: DataFrame, total_rows: int, binning: Binning, growth: Growth, trees: list[Tree], number: int) -> Tree:
    """The next tree."""
    root = Node((0, 0, total_rows))
    at_once = max(1, PASS_BYTES // (int(binning.first[-1]) * 24))
    while True:
        split, open_ = order_of(root, growth.leaves)
        tree, nodes = as_tree(root, split, growth, binning)
        if not open_:
            return tree
        place = {id(n): k for k, n in enumerate(nodes)}
        now = Pass(binning, growth, trees, number, tree)
        small = [n for n in open_ if n.sums[2] <= LOCAL_ROWS]
        large = [n for n in open_ if n.sums[2] > LOCAL_ROWS][:at_once]
        if small:
            found = gathered(blocks, [place[id(n)] for n in small], now)
            for node in small:
                sums, splits = found.get(place[id(node)], [(0, 0, 0), []])
                node.sums = tuple(sums)
                below: list[Node] = []
                set_split(node, splits[0][2:] if splits else None, growth)
                for parent, side, *rest in splits:
                    target = node if parent < 0 else below[parent].children[side]
                    set_split(target, rest, growth)
                    below.append(target)
                # The order reaches nothing below that the task has not looked at.
                for target in [node, *below]:
                    for child in target.children or ():
                        child.known = True
        if large:
            for k, (sums, best) in summed(blocks, [place[id(n)] for n in large], now).items():
                nodes[k].sums = tuple(sums)
                set_split(nodes[k], best, growth)


def fit(rows: DataFrame, growth: Growth) -> tuple[float, list[Tree]]:
    """First margin and trees, for rows with features, label (0 or 1) and weight."""
    # Other columns would travel with every read of the rows.
    rows = materialise(rows.select("features", "label", "weight"), "training-vectors")
    facts = rows.agg(F.count("*"), F.sum("weight"), F.sum(F.col("weight") * F.col("label"))).first()
    if not facts[0]:
        raise ValueError("no rows to train on")
    share = min(max(float(facts[2]) / float(facts[1]), 1e-12), 1 - 1e-12)
    margin = math.log(share / (1 - share))
    width = rows.select("features").first()[0].size
    binning = Binning.of(edges_of(rows, width, growth.bins))
    blocks, trees, since = materialise(pack(rows, binning, margin), "blocks"), [], []
    for number in range(growth.rounds):
        tree = grown_tree(blocks, facts[0], binning, growth, since, number)
        trees.append(tree)
        since = [*since, tree]
        if len(since) == KEEP:
            blocks, since = materialise(with_margins(blocks, binning, since), "blocks"), []
    return margin, trees


def with_margins(blocks: DataFrame, binning: Binning, trees: list[Tree]) -> DataFrame:
    def run(batches):
        for batch in batches:
            margins = [Block(row).margins_after(trees, binning).tobytes() for row in batch.to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("margins"), "margins", pa.array(margins, pa.binary()))

    return blocks.mapInArrow(run, BLOCK)


# -- estimator and model ----------------------------------------------------------------


class LeafwiseModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees as text. Adds ``probability``, a vector of both classes' shares."""

    trees = Param(Params._dummy(), "trees", "margin and trees as JSON text")

    def __init__(self, text: str = ""):
        super().__init__()
        self._set(trees=text)

    def content(self) -> tuple[float, list[Tree]]:
        data = json.loads(self.getOrDefault(self.trees))
        return data["margin"], [Tree(**t) for t in data["trees"]]

    def getNumTrees(self) -> int:
        return len(self.content()[1])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin, trees = self.content()
        used, arrays = stacked(trees)

        @F.arrow_udf("double")
        def probability(vectors: pa.Array) -> pa.Array:
            counts, features, values = sparse(vectors)
            place = np.minimum(np.searchsorted(used, features), max(len(used) - 1, 0))
            hit = used[place] == features if len(used) else np.zeros(len(features), bool)
            row = np.repeat(np.arange(len(counts)), counts)
            ends = np.cumsum(counts)
            out = np.empty(len(counts))
            for at in range(0, len(counts), 512):
                last = min(at + 512, len(counts))
                part = slice(ends[at] - counts[at], ends[last - 1])
                dense, mine = np.zeros((last - at, len(used))), hit[part]
                dense[row[part][mine] - at, place[part][mine]] = values[part][mine]
                out[at:last] = 1 / (1 + np.exp(-(margin + sums_of(dense, *arrays))))
            return pa.array(out)

        share = probability("features")
        return dataset.withColumn("probability", array_to_vector(F.array(1 - share, share)))


def stacked(trees: list[Tree]) -> tuple[np.ndarray, tuple]:
    """Features in use, and all trees' nodes as tables of one width."""
    used = np.unique([f for t in trees for f in t.feature if f >= 0]).astype(np.int64)
    size = max((len(t.feature) for t in trees), default=1)

    def table(name: str, empty, kind):
        return np.array([getattr(t, name) + [empty] * (size - len(t.feature)) for t in trees], kind).reshape(len(trees), size)

    feature = table("feature", -1, np.int64)
    return used, (np.where(feature >= 0, np.searchsorted(used, feature), -1), table("threshold", 0.0, float), table("left", 0, np.int64), table("right", 0, np.int64), table("value", 0.0, float))


def sums_of(dense: np.ndarray, feature, threshold, left, right, value) -> np.ndarray:
    """Sum of the trees' values of each row."""
    at = np.zeros((len(dense), len(feature)), np.int64)
    tree = np.arange(len(feature))[None, :]
    row = np.arange(len(dense))[:, None]
    while (inner := (f := feature[tree, at]) >= 0).any():
        go_left = dense[row, np.maximum(f, 0)] <= threshold[tree, at] if dense.shape[1] else inner
        at = np.where(inner, np.where(go_left, left[tree, at], right[tree, at]), at)
    return value[tree, at].sum(axis=1)


class LeafwiseClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees over ``features``, ``label`` and ``weight``; see ``Growth`` for its settings."""

    growth = Param(Params._dummy(), "growth", "settings as JSON text")

    @keyword_only
    def __init__(self, growth: str = ""):
        super().__init__()
        self._set(growth=growth or json.dumps(asdict(Growth())))

    @classmethod
    def of(cls, **settings) -> LeafwiseClassifier:
        return cls(growth=json.dumps(asdict(Growth(**settings))))

    def settings(self) -> Growth:
        return Growth(**json.loads(self.getOrDefault(self.growth)))

    def _fit(self, dataset: DataFrame) -> LeafwiseModel:
        margin, trees = fit(dataset, self.settings())
        return LeafwiseModel(json.dumps({"margin": margin, "trees": [asdict(t) for t in trees]}))
