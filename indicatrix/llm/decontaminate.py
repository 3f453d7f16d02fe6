"""Benchmark passages in documents, also reworded ones: latent semantic candidates, then subsequence and answer checks.

Documents are cut into overlapping passages. Passages and benchmark items are TF-IDF vectors over the words of the
benchmark; document frequencies are counted over the passages of all documents, without what stands there as part of an item.
A randomised SVD over the items and all passages
of all documents gives the latent space; it is an index and decides nothing but candidates. One scan sums, for every pair of
benchmark words, the products of their weights over the passages; the sums stay a table, of which Spark makes the products with
the random test matrix, so the driver holds matrices of (benchmark words x rank) only. Every passage is projected
and compared with every item by cosine; items come in blocks of bounded size, a scan of the documents per block. Candidates
are verified on the words: the longest common subsequence with the surroundings of the passage must cover ``least`` of the
item, or ``weak`` of it if the item's answer also stands there word for word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.store import discard, release, sent, stored
from indicatrix.llm.words import Hasher, bounds, buffers, chunks
from indicatrix.session import materialise

PASSAGE, STRIDE = 48, 24
# Bytes of text at a time, few enough that what is worked out of them stays in a core's cache.
CHUNK = 1 << 19
# A block never holds more items than the latent space has directions, so that each item can have its own.
RANK, OVERSAMPLE = 448, 16
BLOCK_ITEMS, BLOCK_WORDS = 400, 40_000
# The squared weights of all passages together, as a multiple of those of the items, at most: with no more items than directions,
# passages then never take up the space of the items, however many they are.
PASSAGE_WEIGHT = 1.0
# Passages that a task sums, and the tasks of a small corpus: what a task has to send does not shrink with its passages.
SUM_PASSAGES, SUM_TASKS = 500_000, 12
# Words whose pairs a task keeps as a square, and other pairs that it gathers before it sums or sends them.
FREQUENT, GATHERED = 2_048, 1 << 20
SLAB, PIECE = 64, 1 << 17
SUMS = "slab long, pairs binary, sums binary"
ANSWER_WORDS = 5
FOUND = "array<struct<item_id:bigint,cosine:double,lcs:int,item_words:int,answered:boolean>>"


class Items:
    """A block of benchmark items: hashed words, vocabulary, and later weights and latent vectors."""

    def __init__(self, rows, hasher: Hasher):
        texts = pa.array([r["text"] or "" for r in rows], pa.large_string())
        data, offsets = buffers(texts)
        starts, ends, item = bounds(data, offsets)
        hashes = hasher.words(data, starts, ends)
        self.ids = [r["item_id"] for r in rows]
        self.words = [hashes[item == i] for i in range(len(rows))]
        self.answers = [self._answer(hasher, r, w) for r, w in zip(rows, self.words)]
        self.vocabulary = np.unique(hashes)

    @staticmethod
    def _answer(hasher, row, words):
        if "answer" in row and row["answer"]:
            data = np.frombuffer(row["answer"].encode(), np.uint8)
            starts, ends, _ = bounds(data, np.array([0, len(data)]))
            return hasher.words(data, starts, ends)
        return words[-ANSWER_WORDS:]


class Lookup:
    """Places of hashes in a sorted vocabulary, found by their first bits."""

    def __init__(self, vocabulary):
        bits = max(8, (8 * len(vocabulary)).bit_length())
        self.shift, self.vocabulary = np.uint64(64 - bits), vocabulary
        first = np.searchsorted(vocabulary >> self.shift, np.arange(1 << bits, dtype=np.uint64))
        self.first = np.append(first, len(vocabulary)).astype(np.int32)
        self.most = int(np.diff(self.first).max())

    def __call__(self, hashes):
        """The place of each hash; -1 if it is not there."""
        index = np.full(len(hashes), -1)
        if not len(self.vocabulary):
            return index
        cell = (hashes >> self.shift).astype(np.int64)
        at = self.first[cell]
        filled = np.flatnonzero(at < self.first[cell + 1])
        for _ in range(self.most):
            place = at[filled]
            hit = self.vocabulary[place] == hashes[filled]
            index[filled[hit]] = place[hit]
            at[filled] += 1
            filled = filled[~hit]
            filled = filled[at[filled] < self.first[cell[filled] + 1]]
        return index


def passages(hashes, texts, lookup):
    """Vocabulary index of every word (-1: none), and first word, end and text of every passage; no passage spans two texts."""
    index = lookup(hashes)
    first = np.flatnonzero(np.diff(texts, prepend=-1))
    counts = np.diff(np.append(first, len(texts)))
    per = np.maximum(1, -(-(counts - PASSAGE) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(first)), per)
    begin = first[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
    return index, begin, np.minimum(begin + PASSAGE, (first + counts)[owner]), texts[first][owner] if len(first) else owner


def rows_of(begin, end):
    """Positions of all words of all passages, and the passage of each."""
    n = end - begin
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + begin[row], row


def word_batches(batches, hasher, vocabulary):
    lookup = Lookup(vocabulary)
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        for _, _, part, cuts in chunks(data, offsets, CHUNK):
            starts, ends, text = bounds(part, cuts)
            if len(starts):
                hashes = hasher.words(part, starts, ends)
                yield text, *passages(hashes, text, lookup)[:3]


# Three words of a row of up to four, by distance from the first: what is left of an item around one changed word.
SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))


def grams(index, group, shape, n):
    """Positions where ``shape`` picks words of the vocabulary within one group, and a number for what it picks there."""
    size = max(0, len(index) - shape[-1])
    a, b, c = (index[k : k + size] for k in shape)
    at = np.flatnonzero((a >= 0) & (b >= 0) & (c >= 0) & (group[:size] == group[shape[-1] : shape[-1] + size]))
    return at, (a[at] * n + b[at]) * n + c[at]


def item_grams(items: Items):
    """Per shape, the sorted numbers of what the items hold; an item of two words counts as a pair, of one word not at all."""
    n = len(items.vocabulary)
    index = np.concatenate([np.searchsorted(items.vocabulary, w) for w in items.words]) if items.words else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(items.words)), [len(w) for w in items.words])
    pairs = [np.searchsorted(items.vocabulary, w) for w in items.words if len(w) == 2]
    return [np.unique(grams(index, group, shape, n)[1]) for shape in SHAPES], np.unique([a * n + b for a, b in pairs]).astype(np.int64)


def of_items(index, group, known, n):
    """Which words stand there as part of an item."""
    out = np.zeros(len(index), bool)
    threes, pairs = known
    for shape, numbers in zip(SHAPES, threes):
        at, number = grams(index, group, shape, n)
        at = at[np.isin(number, numbers, kind="sort")]
        for k in shape:
            out[at + k] = True
    if len(pairs) and len(index) > 1:
        both = (index[:-1] >= 0) & (index[1:] >= 0) & (group[:-1] == group[1:])
        at = np.flatnonzero(both & np.isin(index[:-1] * n + index[1:], pairs, kind="sort"))
        out[at] = out[at + 1] = True
    return out


def frequencies(docs: DataFrame, items: Items, hasher: Hasher) -> np.ndarray:
    """Of every word of the vocabulary, the passages of all documents that hold it, and last the number of passages.

    Words that stand in a document as part of an item are not counted, so that an item keeps its weight however many
    documents hold it.
    """
    vocabulary, known = items.vocabulary, item_grams(items)

    def run(batches):
        counts = np.zeros(len(vocabulary) + 1, np.int64)
        for text, index, begin, end in word_batches(batches, hasher, vocabulary):
            index = np.where(of_items(index, text, known, len(vocabulary)), -1, index)
            # A word counts once for the passage where it starts a stride: strides do not overlap.
            at, row = rows_of(begin, np.minimum(begin + STRIDE, end))
            found = index[at]
            pairs = np.unique(row[found >= 0] * len(vocabulary) + found[found >= 0])
            counts[:-1] += np.bincount(pairs % max(len(vocabulary), 1), minlength=len(vocabulary))
            counts[-1] += len(begin)
        seen = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(seen), pa.array(counts[seen])], ["word", "n"])

    counts = np.zeros(len(vocabulary) + 1)
    for row in docs.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[row["word"]] = row["n"]
    return counts


def weights(counts) -> np.ndarray:
    """Weights of the vocabulary from its frequencies, and last that of any other word.

    The inverse document frequency is squared: words of everyday use, which any passage shares with any item, then add
    next to nothing to a cosine.
    """
    idf = (np.log((counts[-1] + 1) / (counts[:-1] + 1)) + 0.1) ** 2
    return np.append(idf, idf.mean() if len(idf) else 1.0)


def idf_of(docs: DataFrame, items: Items, hasher: Hasher) -> np.ndarray:
    return weights(frequencies(docs, items, hasher))


def item_matrix(items: Items, idf):
    """Rows, columns and unit-length weights of the items."""
    words = [np.unique(np.searchsorted(items.vocabulary, w), return_counts=True) for w in items.words]
    row = np.repeat(np.arange(len(words)), [len(w) for w, _ in words])
    column = np.concatenate([w for w, _ in words]) if words else np.zeros(0, np.int64)
    weight = (np.concatenate([n for _, n in words]) if words else np.zeros(0)) * idf[column]
    norm = np.sqrt(np.bincount(row, weight**2, minlength=len(words)))
    return row, column, weight / np.maximum(norm[row], 1e-12)


def range_sum(row, column, weight, n_rows, test):
    """A^T (A test) of a sparse A that holds a place once, rows in order; one row at a time, as the driver is small."""
    out = np.zeros(test.shape)
    edges = np.searchsorted(row, np.arange(n_rows + 1))
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
        at, values = column[first:last], weight[first:last]
        out[at] += values[:, None] * (values @ test[at])
    return out


def passage_words(index, begin, end, idf, rank):
    """The distinct words of passages, by rank, and their weights: matrices (words x passages) of passages of equally many."""
    n = len(rank)
    at, row = rows_of(begin, end)
    found = index[at]
    # Of the whole passage, so that one of everyday words alone weighs little.
    length = np.sqrt(np.bincount(row, idf[found] ** 2, minlength=len(begin)))
    of_rank = np.empty(n)
    of_rank[rank] = idf[:-1]
    word, times = np.unique(row[found >= 0] * n + rank[found[found >= 0]], return_counts=True)
    row, word = np.divmod(word, n)
    weight = times * of_rank[word] / length[row]
    count = np.bincount(row, minlength=len(begin))
    first = np.cumsum(count) - count
    for size in np.unique(count[count > 0]).tolist():
        start = first[count == size]
        step = max(1, (1 << 18) // size**2)
        for k in range(0, len(start), step):
            place = start[k : k + step] + np.arange(size)[:, None]
            yield word[place], weight[place]


def summed(pairs, values):
    """The distinct numbers in order, and the sum of the values of each."""
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    edges = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[edges], np.add.reduceat(values[order], edges) if len(edges) else values


def pieces(pairs, values, n, slabs):
    """Sums of pairs a * n + b, dealt to slabs by a: the rows a, a + slabs, a + 2 slabs and so on of the matrix."""
    a, b = np.divmod(pairs, n)
    slab, place = a % slabs, a // slabs * n + b
    order = np.argsort(slab, kind="stable")
    slab, place, values = slab[order], place[order], values[order]
    edges = np.append(np.flatnonzero(np.diff(slab, prepend=-1)), len(slab))
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
        for k in range(first, last, PIECE):
            part = slice(k, min(k + PIECE, last))
            columns = [pa.array([slab[k]]), pa.array([place[part].tobytes()]), pa.array([values[part].tobytes()])]
            yield pa.record_batch(columns, ["slab", "pairs", "sums"])


def slab_blocks(batches, n, slabs):
    """Slabs as matrices, of batches in the order of their slabs."""
    held, block = None, None
    for batch in batches:
        for slab, pairs, values in zip(*(c.to_pylist() for c in batch.columns)):
            if slab != held:
                if held is not None:
                    yield held, block
                held, block = slab, np.zeros((len(range(slab, n, slabs)), n))
            block.reshape(-1)[np.frombuffer(pairs, np.int64)] += np.frombuffer(values)
    if held is not None:
        yield held, block


def passage_products(docs: DataFrame, items: Items, idf, rank, hasher: Hasher, slabs: int) -> DataFrame:
    """A^T A of all passages of all documents, words by rank, as rows of slabs: its places that are not zero, and their values."""
    vocabulary, n = items.vocabulary, len(items.vocabulary)
    square = min(FREQUENT, n)

    def run(batches):
        # One more row and column for words that are not frequent; their pairs are gathered instead.
        near = np.zeros((square + 1, square + 1))
        corners = [np.triu_indices(k) for k in range(PASSAGE + 1)]
        far, gathered = [], 0
        for _, index, begin, end in word_batches(batches, hasher, vocabulary):
            for words, weight in passage_words(index, begin, end, idf, rank):
                a, b = corners[len(words)]
                close = np.minimum(words, square)
                pairs = (close * (square + 1))[a]
                pairs += close[b]
                values = weight[a]
                values *= weight[b]
                np.add.at(near.reshape(-1), pairs.reshape(-1), values.reshape(-1))
                b, at = np.nonzero(words >= square)
                a, k = rows_of(np.zeros_like(b), b + 1)
                b, at = b[k], at[k]
                far.append((words[a, at] * n + words[b, at], weight[a, at] * weight[b, at]))
                gathered += len(a)
            if gathered > 2 * GATHERED:
                far = [summed(*map(np.concatenate, zip(*far)))]
                gathered = len(far[0][0])
                if gathered > GATHERED:
                    yield from pieces(*far[0], n, slabs)
                    far, gathered = [], 0
        if far:
            yield from pieces(*summed(*map(np.concatenate, zip(*far))), n, slabs)
        a, b = np.nonzero(near[:square, :square])
        yield from pieces(a * n + b, near[a, b], n, slabs)

    def fold(batches):
        for slab, block in slab_blocks(batches, n, slabs):
            step = max(1, GATHERED // n)
            for k in range(0, len(block), step):
                a, b = np.nonzero(block[k : k + step])
                values, a = block[a + k, b], (a + k) * slabs + slab
                yield from pieces(a * n + b, values, n, slabs)
                yield from pieces((b * n + a)[a < b], values[a < b], n, slabs)

    def dealt(parts):
        return parts.repartition(slabs, "slab").sortWithinPartitions("slab")

    return stored(dealt(dealt(docs.mapInArrow(run, SUMS)).mapInArrow(fold, SUMS)), "passage-products")


def latent_basis(docs: DataFrame, items: Items, idf, hasher: Hasher, seed: int = 7, passages: float | None = None) -> np.ndarray:
    """An orthonormal basis (words x rank) of the leading right singular directions of items and all passages.

    Passages are scaled alike, so that together they weigh no more than ``PASSAGE_WEIGHT`` allows. ``passages`` is their
    number, counted here if it is not known.
    """
    n, size = len(items.vocabulary), min(RANK + OVERSAMPLE, len(items.vocabulary))
    own = item_matrix(items, idf)
    texts = docs.select("text")
    if passages is None:
        passages = frequencies(texts, items, hasher)[-1]
    # Frequent words first.
    order = np.argsort(idf[:-1], kind="stable")
    rank = np.argsort(order)
    slabs = -(-n // SLAB)
    tasks = max(SUM_TASKS, -(-int(passages) // SUM_PASSAGES))
    sums = passage_products(texts.coalesce(tasks), items, idf, rank, hasher, slabs)

    def product(test):
        # Narrow numbers travel: the driver holds some copies of what it sends and gets.
        ranked = test[order].astype(np.float32)

        def run(batches):
            wide = ranked.astype(np.float64)
            for slab, block in slab_blocks(batches, n, slabs):
                squares = block[np.arange(len(block)), np.arange(slab, n, slabs)].sum()
                columns = [pa.array([slab]), pa.array([(block @ wide).astype(np.float32).tobytes()]), pa.array([squares])]
                yield pa.record_batch(columns, ["slab", "sums", "squares"])

        rows = sums.mapInArrow(run, "slab long, sums binary, squares double").collect()
        share = min(1.0, PASSAGE_WEIGHT * (own[2] ** 2).sum() / max(sum(r["squares"] for r in rows), 1e-12))
        out = range_sum(*own, len(items.ids), test)
        for r in rows:
            out[order[r["slab"] :: slabs]] += share * np.frombuffer(r["sums"], np.float32).reshape(-1, size)
        del rows
        release(sums)
        return out

    basis = np.random.default_rng(seed).standard_normal((n, size))
    for _ in range(2):
        basis, _ = np.linalg.qr(product(basis))
    _, vectors = np.linalg.eigh(basis.T @ product(basis))
    discard(sums)
    return basis @ vectors[:, ::-1][:, : min(RANK, size)]


def common_subsequence(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence; the table's rows are the bits of one number."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full = row = (1 << len(item)) - 1
    for w in words:
        if hit := row & places.get(w, 0):
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def contains(words: list[int], part: list[int]) -> bool:
    n = len(part)
    return n > 0 and any(words[i] == part[0] and words[i : i + n] == part for i in range(len(words) - n + 1))


class Search:
    """Finds the items of a block in texts; what it holds is bounded by the block."""

    def __init__(self, items: Items, idf, basis, hasher, cosine: float, least: float, weak: float):
        row, column, weight = item_matrix(items, idf)
        latent = np.zeros((len(items.ids), basis.shape[1]))
        np.add.at(latent, row, weight[:, None] * basis[column])
        length = np.sqrt((latent**2).sum(axis=1, keepdims=True))
        self.latent = (latent / np.maximum(length, 1e-12)).T.astype(np.float32)
        self.basis, self.idf, self.hasher = basis.astype(np.float32), idf, hasher
        # The most that one occurrence of a word can add to the product with any item.
        reach = np.abs(basis @ self.latent).max(axis=1, initial=0.0) if len(items.ids) else np.zeros(len(basis))
        self.reach = reach * idf[:-1]
        self.vocabulary, self.ids, self.lookup = items.vocabulary, items.ids, Lookup(items.vocabulary)
        self.words, self.answers = [w.tolist() for w in items.words], [w.tolist() for w in items.answers]
        self.cosine, self.least, self.weak = cosine, least, weak

    def candidates(self, index, begin, end):
        """Passage, item and cosine of all pairs at or above the cosine.

        What its words can add to the product with any item bounds the cosine of a passage, so passages below it are left
        out before they are projected; no pair is lost.
        """
        square = np.append(self.idf[index] ** 2, 0.0)
        reach = np.append(np.where(index >= 0, self.reach[index], 0.0), 0.0)
        cuts = np.stack([begin, end], axis=1).ravel()
        norm = np.sqrt(np.add.reduceat(square, cuts)[::2])
        some = np.flatnonzero(np.add.reduceat(reach, cuts)[::2] >= 0.999 * self.cosine * norm)
        for k in range(0, len(some), 2048):
            part = some[k : k + 2048]
            at, row = rows_of(begin[part], end[part])
            at, row = at[index[at] >= 0], row[index[at] >= 0]
            vectors = np.zeros((len(part), self.basis.shape[1]), np.float32)
            edges = np.flatnonzero(np.diff(row, prepend=-1))
            for e in range(0, len(edges), 256):
                last = edges[e + 256] if e + 256 < len(edges) else len(row)
                span = slice(edges[e], last)
                values = self.basis[index[at[span]]] * self.idf[index[at[span]], None].astype(np.float32)
                vectors[row[edges[e : e + 256]]] = np.add.reduceat(values, edges[e : e + 256] - edges[e], axis=0)
            cosines = vectors @ self.latent / norm[part, None]
            p, i = np.nonzero(cosines >= self.cosine)
            yield from zip(part[p].tolist(), i.tolist(), cosines[p, i].tolist())

    def find(self, texts: pa.Array) -> list[dict[int, tuple[float, int, bool]]]:
        """Per text the verified items, with cosine, common subsequence and answer of the best passage."""
        out: list[dict[int, tuple[float, int, bool]]] = [{} for _ in range(len(texts))]
        if not len(self.vocabulary):
            return out
        data, offsets = buffers(texts)
        for first, _, part, cuts in chunks(data, offsets, CHUNK):
            starts, ends, text = bounds(part, cuts)
            if not len(starts):
                continue
            hashes = self.hasher.words(part, starts, ends)
            index, begin, end, owner = passages(hashes, text, self.lookup)
            for p, i, cosine in self.candidates(index, begin, end):
                item, found = self.words[i], out[first + owner[p]]
                low = max(int(begin[p]) - len(item), int(np.searchsorted(text, owner[p])))
                high = min(int(end[p]) + len(item), int(np.searchsorted(text, owner[p], "right")))
                words = hashes[low:high].tolist()
                lcs = common_subsequence(item, words)
                if lcs < self.weak * len(item):
                    continue
                answered = contains(words, self.answers[i])
                if lcs >= self.least * len(item) or answered:
                    found[i] = max(found.get(i, (0.0, 0, False)), (cosine, lcs, answered), key=lambda x: (x[1], x[2], x[0]))
        return out


def lowered(name: str) -> Column:
    return F.lower(F.col(name).cast("string"))


def item_blocks(benchmark: DataFrame):
    """The items in blocks of about BLOCK_ITEMS items and BLOCK_WORDS words at most."""
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    columns = [F.col("item_id").cast("long").alias("item_id"), lowered("text").alias("text")]
    if "answer" in benchmark.columns:
        columns.append(lowered("answer").alias("answer"))
    sized = materialise(benchmark.select(*columns, words.alias("n")).where("n > 0"), "items")
    total, items = sized.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_blocks = max(1, -(-total // BLOCK_WORDS), -(-items // BLOCK_ITEMS))
    for b in range(n_blocks):
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b
        if rows := [r.asDict() for r in sized.where(block).drop("n").orderBy("item_id", "text").collect()]:
            yield rows


def with_matches(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.2, least: float = 0.8, weak: float = 0.5) -> DataFrame:
    """Adds ``matches``, the items found in each whole text: item_id, cosine, lcs, item_words, answered.

    An item without an ``answer`` column has its last words as answer. Items without words match nothing; null and empty
    texts hold nothing; repeated items and documents are judged alike; other columns pass through. Nothing is shuffled.
    """
    hasher = Hasher(seed=7)
    texts = docs.select(lowered("text").alias("text"), "doc_id")
    found = []
    for rows in item_blocks(benchmark):
        items = Items(rows, hasher)
        counts = frequencies(texts.select("text"), items, hasher)
        idf = weights(counts)
        search = Search(items, idf, latent_basis(texts, items, idf, hasher, passages=counts[-1]), hasher, cosine, least, weak)
        found.append(finder(sent(docs.sparkSession, search))(lowered("text")))
    empty = F.array().cast(FOUND)
    return docs.withColumn("matches", F.concat(*found) if found else empty)


def finder(packed):
    held: list[Search] = []

    def run(texts: pa.Array) -> pa.Array:
        import pickle

        if not held:
            held.append(pickle.loads(packed.value))
        search = held[0]
        rows = [
            [
                {"item_id": search.ids[i], "cosine": c, "lcs": n, "item_words": len(search.words[i]), "answered": a}
                for i, (c, n, a) in sorted(found.items())
            ]
            for found in search.find(texts)
        ]
        kind = pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.int32()), ("item_words", pa.int32()), ("answered", pa.bool_())])
        return pa.array(rows, pa.list_(kind))

    return F.arrow_udf(run, FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id and the evidence of every verified pair, one row per row of the documents and item."""
    rows = with_matches(docs, benchmark).where(F.size("matches") > 0)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline("matches"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, untouched, that hold no item, whatever their columns are called."""
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "text")
    kept = with_matches(rows, benchmark).where(F.size("matches") == 0)
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
