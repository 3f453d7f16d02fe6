"""Periodic runs of words, by maximal pairs of a bottom-up tree of LCP intervals.

A run is a stretch of words with smallest period q and at least ``max(shortest, turns * q)`` words that no neighbouring word
extends. Two places of a text, q apart, whose common following words are as many as L make a maximal pair if the words before
them differ (or there is none) and so do the words after L. Every run of period q is the maximal pair of its start and the place
q later, with L = length - q, and a maximal pair with L >= (turns - 1) * q and L + q >= shortest is a stretch of q + L words that
nothing extends. So the pairs under these two constraints are the runs, and, where several pairs name one stretch, the
least distance is its period. Nothing is extended word by word.

Texts are handled in tasks, a chunk of whole texts at a time: words become numbers by comparing the words themselves. Only *zones* go
into the tree: longest stretches of places whose next ``seed`` words occur again in the same zone, found by repeating that cut until
nothing changes. All places of a run but its last ``seed - 1`` lie in one zone, as each of them has an equal one q before or after
it; so nothing is lost, and text without repeats costs a few sorts of numbers. Suffixes of the zones are sorted by doubling.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.words import bounds, buffers, chunks, word_column

SHORTEST, TURNS = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def seed_length(shortest: int, turns: int) -> int:
    """The longest stretch that every place of a run, but those too near its end, meets again one period before or after.

    The two places of a run of period q share L = max((turns - 1) q, shortest - q) words or more. The first L - seed + 1
    places have an equal one behind them, and they reach the places they point to if they are q or more.
    """
    return min(max((turns - 1) * q, shortest - q) - q + 1 for q in range(1, shortest + 1))


def dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of rows of keys, equal for equal rows, in their order."""
    key = keys[0]
    for other in keys[1:]:
        width = int(other.max(initial=0)) + 1
        if (int(key.max(initial=0)) + 1) * width >= 2**62:
            key = np.unique(key, return_inverse=True)[1]
        key = key * width + other
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


def zones(words: np.ndarray, owner: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) word of each zone, in order."""
    n = len(words) - seed + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = words[:n]
    for k in range(1, seed):
        gram = dense(gram, words[k : n + k])
    at = np.flatnonzero(owner[:n] == owner[seed - 1 :])
    group, gram = owner[at], gram[at]
    while len(at):
        same = dense(group, gram)
        again = np.bincount(same)[same] > 1
        kept, parts, grams = at[again], group[again], gram[again]
        starts = np.ones(len(kept), bool)
        starts[1:] = (np.diff(kept) > 1) | (np.diff(parts) != 0)
        if again.all() and starts.sum() == len(np.unique(group)):
            firsts = np.flatnonzero(starts)
            return kept[firsts], kept[np.append(firsts[1:], len(kept)) - 1] + seed
        at, group, gram = kept, np.cumsum(starts), grams
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def sorted_suffixes(words: np.ndarray, zone: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all zones in order, zone by zone, and what each has in common with the one before it.

    ``ends`` holds for each word where its zone ends. Suffixes stop there.
    """
    n = len(words)
    places = np.arange(n)
    levels = [dense(zone, words)]
    while int(levels[-1].max(initial=-1)) < n - 1:
        rank, step = levels[-1], 1 << (len(levels) - 1)
        ahead = places + step
        levels.append(dense(rank, np.where(ahead < ends, rank[np.minimum(ahead, n - 1)] + 1, 0)))
    order = np.empty(n, np.int64)
    order[levels[-1]] = places
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(max(n - 1, 0), np.int64)
    limit_a, limit_b = ends[a], ends[b]
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        equal = (a < limit_a) & (b < limit_b)
        equal &= rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]
        step = equal * (1 << level)
        a, b, shared = a + step, b + step, shared + step
    common[1:] = shared
    return order, common


class Places:
    """Places below a node: all in order, and in order by the word before them."""

    __slots__ = ("order", "lists")

    def __init__(self, place: int, left: int):
        self.order, self.lists = [place], {left: [place]}

    def near(self, place: int, left: int, reach: int):
        """Places at most ``reach`` away whose word before is another."""
        low, high = bisect_left(self.order, place - reach), bisect_right(self.order, place + reach)
        if high - low <= len(self.lists):
            same = self.lists.get(left, ())
            for other in self.order[low:high]:
                at = bisect_left(same, other)
                if at == len(same) or same[at] != other:
                    yield other
        else:
            for word, places in self.lists.items():
                if word != left:
                    yield from places[bisect_left(places, place - reach) : bisect_right(places, place + reach)]

    def add(self, other: Places) -> None:
        for mine, theirs in [(self.order, other.order), *((self.lists.setdefault(left, []), places) for left, places in other.lists.items())]:
            if len(theirs) * 8 > len(mine):
                mine += theirs
                mine.sort()
            else:
                for place in theirs:
                    insort(mine, place)


def maximal_pairs(order: list[int], common: list[int], left: list[int], seed: int, shortest: int, turns: int):
    """(first place, second place, common words) of the maximal pairs that are runs, some stretches more than once.

    Intervals close from the deepest up. Each holds the places below it by the word before; a child's places meet those of the children
    before it, the smaller set going to the larger. Places of different children are followed by different words.
    """
    stack: list[tuple[int, Places]] = []  # (depth of the interval that is open, places so far)
    for at in range(len(order) + 1):
        depth = common[at] if at < len(order) else 0
        below = Places(order[at - 1], left[order[at - 1]]) if at else None
        while stack and stack[-1][0] > depth:
            width, held = stack.pop()
            below = yield from joined(held, below, width, left, shortest, turns)
        if at == len(order):
            return
        if depth < seed:
            continue
        if stack and stack[-1][0] == depth:
            below = yield from joined(stack.pop()[1], below, depth, left, shortest, turns)
        stack.append((depth, below))


def joined(a: Places, b: Places, width: int, left: list[int], shortest: int, turns: int):
    """The union of two children of an interval; yields their maximal pairs on the way."""
    small, large = (a, b) if len(a.order) < len(b.order) else (b, a)
    reach = width // (turns - 1)
    for word, places in small.lists.items():
        for place in places:
            for other in large.near(place, word, reach):
                if abs(place - other) + width >= shortest:
                    yield min(place, other), max(place, other), width
    large.add(small)
    return large


def runs_of(words: np.ndarray, owner: np.ndarray, shortest: int, turns: int) -> np.ndarray:
    """Rows (start, length, period) over a sequence of texts, by start and period; ``owner`` is the text of each word."""
    seed = seed_length(shortest, turns)
    firsts, lasts = zones(words, owner, seed)
    sizes = lasts - firsts
    if not len(sizes):
        return np.zeros((0, 3), np.int64)
    zone = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    places = np.arange(len(zone)) - begins[zone] + firsts[zone]
    order, common = sorted_suffixes(words[places], zone, (begins + sizes)[zone])
    # No run goes on beyond its zone, so a zone's first place has no word before it.
    left = np.empty(len(zone), np.int64)
    left[1:] = words[places[:-1]]
    left[begins] = -1
    found = np.fromiter((x for pair in maximal_pairs(order.tolist(), common.tolist(), left.tolist(), seed, shortest, turns) for x in pair), np.int64).reshape(-1, 3)
    start, period = found[:, 0], found[:, 1] - found[:, 0]
    length = found[:, 2] + period
    by_stretch = np.lexsort((period, length, start))
    start, period, length = start[by_stretch], period[by_stretch], length[by_stretch]
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    out = np.stack([places[start], length, period], axis=1)[first]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def covered(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that lie in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] > 0


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST, turns: int = TURNS) -> DataFrame:
    """doc_id, n_words, runs (structs start, length, period, by start and period) and collapsed: the words outside what runs
    repeat, joined by one space.

    One row per row of ``docs``, repeated and null ids included; other columns are ignored. Null and empty texts have no words, no
    runs and an empty text. Every text is judged alone and whole, however long.
    """
    if turns < 2 or shortest < 2:
        raise ValueError("a run needs two turns and two words at least")

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for first, last, part, places in chunks(data, offsets):
                starts, ends, owner = bounds(part, places)
                column = word_column(part, starts, ends)
                codes = column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                found = runs_of(codes, owner, shortest, turns)
                texts = np.arange(last - first + 1)
                word_bounds, run_bounds = np.searchsorted(owner, texts), np.searchsorted(owner[found[:, 0]], texts)
                kept = np.flatnonzero(~covered(found, len(codes)))
                words_kept = pa.ListArray.from_arrays(pa.array(np.searchsorted(kept, word_bounds), pa.int32()), column.take(pa.array(kept)))
                found[:, 0] -= word_bounds[owner[found[:, 0]]]
                structs = pa.StructArray.from_arrays([pa.array(found[:, k].copy()) for k in range(3)], fields=list(RUN))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.diff(word_bounds)),
                        pa.ListArray.from_arrays(pa.array(run_bounds, pa.int32()), structs),
                        pc.binary_join(words_kept, " "),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = "array<struct<start:long,length:long,period:long>>"
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id long, n_words long, runs {kind}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth hash of an id turns the text's end into a repeated stretch of words.

    A null id plants nothing; such texts, and all others that are not chosen, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n, g = F.size("_words"), F.floor(h / 10)
    first = g % n
    period = 1 + F.floor((n - first) / (3 + g % 8))
    places = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.when(i < F.col("_first"), i).otherwise(F.col("_first") + (i - F.col("_first")) % F.col("_period")).cast("int")
    )
    chosen = F.coalesce((h % 10 == 0) & F.col("text").isNotNull(), F.lit(False))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("_words", F.when(chosen, words).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("_first", F.when(n > 0, first)).withColumn("_period", F.when(n > 0, period))
    planted = F.array_join(F.transform(places, lambda i: F.get("_words", i)), " ")
    return rows.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def greatest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; the first of equal ones in order of start and period."""
    ahead = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, run: F.when(ahead(best, run), run).otherwise(best))


def digest(docs: DataFrame) -> DataFrame:
    """Runs of all documents with planted periods: their number, the one of greatest exponent and digests."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs(with_planted_periods(docs)).withColumn("_best", greatest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
