"""Code lengths of texts under context-tree weighting of bytes, beside a smoothed word model.

A text is its UTF-8 bytes and an end sign, which is the byte 0. Each byte is eight binary decisions, and every decision has a
context tree over the bytes before it, up to ``DEPTH`` of them. A node of the tree estimates its decision by Krichevsky-Trofimov, and
weighs its own estimate against that of its longer contexts by what each would have paid for the training data; the mixture
over all depths gives the probability. Contexts never seen defer to the next shorter one.

A byte and its contexts are one *code*. Codes of all texts are counted, in training texts and in all; within a task they are summed
per batch before the shuffle. They are dealt by their two nearest context bytes to parts of about ``PART_CODES`` codes: a part
holds all longer contexts of its codes, so it works out their trees and, with the bounded table of the contexts of one byte and of
none, the probability of each of its codes, once. No node is left out. Values of the codes met most often are sent to all
tasks; others meet the texts by a join, as rare words do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.store import discard, stored
from indicatrix.llm.words import Hasher, bounds, buffers, chunks

DEPTH = 4
PART_CODES = 300_000
COMMON_CODES = 2_000_000
COMMON_WORDS = 200_000
END_WORD = 0  # the hash kept for the end of a text; no word has it
LN10 = float(np.log(10))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


# Byte strings: the context's bytes from the nearest to the farthest, then the byte itself.


def byte_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of every byte and end of the texts, and the number of codes of each text."""
    lengths = np.diff(offsets)
    padded = np.zeros(len(data) + DEPTH * (len(lengths) + 1), np.uint64)
    at = np.arange(len(data)) + np.repeat((np.arange(len(lengths)) + 1) * DEPTH, lengths)
    padded[at] = data
    first = offsets[:-1] + (np.arange(len(lengths)) + 1) * DEPTH
    n = lengths + 1
    spots = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    whole = np.zeros(len(padded), np.uint64)
    for back in range(1, DEPTH + 1):
        whole[back:] |= padded[:-back] << np.uint64(8 * (DEPTH + 1 - back))
    whole |= padded
    return whole[spots], n


def byte_counts(texts: DataFrame) -> DataFrame:
    """code, n and seen: how often codes occur in training texts and in all. ``texts`` has a text and whether it is a training text."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            learned = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            seen, counts = np.zeros(0, np.uint64), np.zeros((2, 0))
            for first, last, part, cuts in chunks(data, offsets):
                codes, n = byte_codes(part, cuts)
                merged, place = np.unique(np.concatenate([seen, codes]), return_inverse=True)
                both = (np.repeat(learned[first:last], n), np.ones(len(codes), np.int64))
                counts = np.stack([np.bincount(place, np.concatenate([old, new]), len(merged)) for old, new in zip(counts, both)])
                seen = merged
            yield pa.record_batch([pa.array(seen.view(np.int64)), *(pa.array(c.astype(np.int64)) for c in counts)], ["code", "n", "seen"])

    counted = texts.mapInArrow(run, "code long, n long, seen long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def log_gamma(z: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for z > 0: Stirling's series at z + 8."""
    x = z + 8
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    stirling = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series
    return stirling - sum(np.log(z + i) for i in range(8))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a string with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def decisions(contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray):
    """Node keys (context, decision) with counts of zeros and ones."""
    keys, ones = [], []
    for j in range(8):
        keys.append(contexts << np.int64(8) | (np.int64(1 << j) | symbols >> np.int64(8 - j)))
        ones.append(symbols >> np.int64(7 - j) & np.int64(1))
    nodes, place = np.unique(np.concatenate(keys), return_inverse=True)
    one, n = np.concatenate(ones), np.tile(counts, 8).astype(float)
    return nodes, np.bincount(place, n * (1 - one), len(nodes)), np.bincount(place, n * one, len(nodes))


def longer_contexts(codes: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Nodes of depth DEPTH to 2, each depth as (keys, zeros, ones, log_ratio, log_weighted), in order of keys.

    ``log_ratio`` is a node's own probability of its data over that of its longer contexts.
    """
    out, below = [], None
    for depth in range(DEPTH, 1, -1):
        nodes, zeros, ones = decisions(codes >> 8 * (DEPTH + 1 - depth), codes & 255, n)
        own = log_kt(zeros, ones)
        if below is None:
            ratio, weighted = np.zeros(len(nodes)), own
        else:
            split = np.bincount(np.searchsorted(nodes, shorter(below[0])), below[1], len(nodes))
            ratio, weighted = own - split, np.logaddexp(own, split) - np.log(2)
        below = nodes, weighted
        out.append((nodes, zeros, ones, ratio, weighted))
    return out


def shorter(nodes: np.ndarray) -> np.ndarray:
    """Keys of the nodes without their farthest context byte."""
    return nodes >> 16 << 8 | nodes & 255


def readable(zeros: np.ndarray, ones: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A node's estimate of a one, and the weight of that estimate against longer contexts."""
    return (ones + 0.5) / (zeros + ones + 1), 1 / (1 + np.exp(-np.clip(ratio, -60, 60)))


def log10_of(codes: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of the byte of each code in its context; ``tables`` has keys, estimates and weights by depth from DEPTH to 0."""
    total, symbols = np.zeros(len(codes)), codes & 255
    for j in range(8):
        decision = np.int64(1 << j) | symbols >> 8 - j
        p, known = np.full(len(codes), 0.5), np.zeros(len(codes), bool)
        for depth, (keys, one, own) in zip(range(DEPTH, -1, -1), tables):
            if not len(keys):
                continue
            key = codes >> 8 * (DEPTH + 1 - depth) << 8 | decision
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found = keys[at] == key
            weight = np.where(known, own[at], 1.0)
            p = np.where(found, weight * one[at] + (1 - weight) * p, p)
            known |= found
        total += np.log(np.where(symbols >> 7 - j & 1, p, 1 - p))
    return total / LN10


def code_values(counts: DataFrame) -> DataFrame:
    """code, value and seen of all counted codes; value is the log10 probability."""
    parts = max(1, -(-counts.count() // PART_CODES))
    dealt = counts.withColumn("part", F.pmod(F.xxhash64(F.shiftright("code", 8 * (DEPTH - 1))), F.lit(parts)))

    def sums(table):
        codes, n = (table.column(c).to_numpy() for c in ("code", "n"))
        nodes, zeros, ones, _, weighted = longer_contexts(codes, n)[-1]
        keys, place = np.unique(shorter(nodes), return_inverse=True)
        return pa.table({"node": keys, **{c: np.bincount(place, v, len(keys)) for c, v in (("zeros", zeros), ("ones", ones), ("split", weighted))}})

    learned = dealt.where("n > 0").groupBy("part").applyInArrow(sums, "node long, zeros double, ones double, split double")
    # At most 255 nodes for each byte.
    short = learned.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("split").alias("split")).orderBy("node").toPandas()
    keys, zeros, ones, split = (short[c].to_numpy() for c in ("node", "zeros", "ones", "split"))
    own = log_kt(zeros, ones)
    none, place = np.unique(keys & 255, return_inverse=True)
    zeros_0, ones_0, split_0 = (np.bincount(place, v, len(none)) for v in (zeros, ones, np.logaddexp(own, split) - np.log(2)))
    top = [(keys, *readable(zeros, ones, own - split)), (none, *readable(zeros_0, ones_0, log_kt(zeros_0, ones_0) - split_0))]

    def values(table):
        codes, n = (table.column(c).to_numpy() for c in ("code", "n"))
        order = np.argsort(codes)
        longer = longer_contexts(codes[n > 0], n[n > 0])
        tables = [(nodes, *readable(zeros, ones, ratio)) for nodes, zeros, ones, ratio, _ in longer]
        return pa.table({"code": codes[order], "value": log10_of(codes[order], [*tables, *top]), "seen": table.column("seen").to_numpy()[order]})

    return dealt.groupBy("part").applyInArrow(values, "code long, value double, seen long")


def common_codes(values: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes met most often and their values, COMMON_CODES at most, down to a power of two."""
    level = F.floor(F.log2("seen")).cast("int")
    sizes = {r["level"]: r["count"] for r in values.groupBy(level.alias("level")).count().collect()}
    least, kept = max(sizes, default=0) + 1, 0
    for step in sorted(sizes, reverse=True):
        if kept + sizes[step] > COMMON_CODES:
            break
        least, kept = step, kept + sizes[step]
    table = values.where(level >= least).select("code", "value").toArrow()
    codes = table.column("code").to_numpy()
    order = np.argsort(codes)
    return codes[order], table.column("value").to_numpy()[order]


# The word model.


def word_counts(texts: DataFrame) -> DataFrame:
    """Counts of training tokens by hash; the end of a text has its own."""

    def run(batches):
        hasher = Hasher(21, lower=True)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            parts = []
            for _, _, part, cuts in chunks(data, offsets):
                starts, ends, _ = bounds(part, cuts)
                parts.append(hasher.words(part, starts, ends))
            words, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            yield pa.record_batch(
                [pa.array(np.append(words, np.uint64(END_WORD)).view(np.int64)), pa.array(np.append(n, batch.num_rows))], ["word", "c"]
            )

    return texts.mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")).where("c > 0")


def common_words(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the most frequent words, COMMON_WORDS at most, down to a power of two."""
    level = F.floor(F.log2("c")).cast("int")
    sizes = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    least, kept = max(sizes, default=0) + 1, 0
    for step in sorted(sizes, reverse=True):
        if kept + sizes[step] > COMMON_WORDS:
            break
        least, kept = step, kept + sizes[step]
    table = counts.where(level >= least).toPandas().sort_values("word")
    return table["word"].to_numpy(np.int64), table["c"].to_numpy(np.int64)


SCORED = """row long, doc_id long, n_tokens long, n_known long, n_bytes long, base double, score double,
  rare array<struct<word:bigint,n:bigint>>, rare_codes array<struct<code:bigint,n:bigint>>"""


def counted_lists(keys: np.ndarray, owner: np.ndarray, n: int, name: str) -> pa.ListArray:
    """Distinct keys of each of n owners with how often they occur; owners ascend."""
    order = np.lexsort((keys, owner))
    k, t = keys[order], owner[order]
    new = np.flatnonzero((np.diff(k, prepend=0) != 0) | (np.diff(t, prepend=-1) != 0))
    times = np.diff(np.append(new, len(k)))
    kind = [pa.field(name, pa.int64()), pa.field("n", pa.int64())]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(t[new], np.arange(n + 1)), pa.int32()), pa.StructArray.from_arrays([pa.array(k[new]), pa.array(times)], fields=kind))


def score_rows(docs: DataFrame, codes: tuple[np.ndarray, np.ndarray], common, denominator: float) -> DataFrame:
    """Per document both models' scores over common codes and words, and counts of the others."""
    model = docs.sparkSession.sparkContext.broadcast((*codes, *common))

    def run(batches):
        from pyspark import TaskContext

        codes, values, words, counts = model.value
        hasher = Hasher(21, lower=True)
        row = TaskContext.get().partitionId() << 33
        logs = np.log10((counts + 1) / denominator)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for first, last, part, cuts in chunks(data, offsets):
                n = last - first
                starts, ends, text = bounds(part, cuts)
                hashes = hasher.words(part, starts, ends).view(np.int64)
                text = np.concatenate([text, np.arange(n)])
                hashes = np.concatenate([hashes, np.full(n, END_WORD, np.int64)])
                tokens = np.bincount(text, minlength=n)
                at = np.minimum(np.searchsorted(words, hashes), max(len(words) - 1, 0))
                found = words[at] == hashes if len(words) else np.zeros(len(hashes), bool)
                base = np.bincount(text[found], logs[at[found]], n).astype(float)
                hits = np.bincount(text[found], minlength=n)
                rare = counted_lists(hashes[~found], text[~found], n, "word")
                every, per = byte_codes(part, cuts)
                own, place = np.unique(every.view(np.int64), return_inverse=True)
                at = np.minimum(np.searchsorted(codes, own), max(len(codes) - 1, 0))
                hit = codes[at] == own if len(codes) else np.zeros(len(own), bool)
                worth = np.where(hit, values[at], 0.0) if len(codes) else np.zeros(len(own))
                score = np.add.reduceat(worth[place], np.cumsum(per) - per)
                left = np.flatnonzero(~hit[place])
                rare_codes = counted_lists(own[place[left]], np.repeat(np.arange(n), per)[left], n, "code")
                yield pa.record_batch(
                    [
                        pa.array(np.arange(row, row + n)), batch.column(0).slice(first, n), pa.array(tokens), pa.array(hits), pa.array(per - 1),
                        pa.array(base), pa.array(score), rare, rare_codes,
                    ],
                    ["row", "doc_id", "n_tokens", "n_known", "n_bytes", "base", "score", "rare", "rare_codes"],
                )
                row += n

    return docs.mapInArrow(run, SCORED)


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document.

    Both models learn from the documents that are not held out. ``score`` is the log10 probability of the bytes of the whole
    text and its end, ``bits_per_byte`` its code length over their number; ``base_score`` that of its lower-cased words and end under add-one counts. Null and empty texts
    consist of their end; a null doc_id is not held out; repeated rows are rows of their own; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = docs.where(~held_out(F.col("doc_id"))).select("text")
    counts = stored(word_counts(training), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    denominator = float(total + distinct + 1)
    codes = stored(byte_counts(docs.select("text", (~held_out(F.col("doc_id"))).alias("training"))), "byte-counts")
    values = stored(code_values(codes), "code-values")
    rows = stored(score_rows(docs, common_codes(values), common_words(counts), denominator), "scored-rows")
    discard(codes)

    # Words that are not common meet their counts by a join; sums go back to the rows.
    rare = rows.select("row", F.inline("rare")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rare = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10((c + 1) / F.lit(denominator))).alias("more"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("hits")
    )
    others = rows.select("row", F.inline("rare_codes")).join(values.select("code", "value"), "code")
    others = others.groupBy("row").agg(F.sum(F.col("n") * F.col("value")).alias("more_score"))
    joined = rows.drop("rare", "rare_codes").join(stored(rare, "rare-words"), "row", "left").join(stored(others, "rare-codes"), "row", "left")
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return joined.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("hits", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        (-score / F.lit(float(np.log10(2))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
