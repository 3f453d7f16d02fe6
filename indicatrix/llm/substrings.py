"""Repeated passages of words: suffixes in groups by prefix, split by longer prefixes until only real repeats are left.

A passage of ``length`` words that repeats is an internal node of the suffix tree of all texts, at that depth. The tree is
never built whole. Suffixes are dealt by a hash of their first words, and a group of one suffix has no internal node and is
left out. Not every suffix is needed: each window of ``length`` words has an *anchor*, the word in it whose prefix of
``PREFIX`` words has the least hash. Equal windows have equal anchors at equal places, so only suffixes that start at
anchors are dealt, about one in eight, each with the windows around it. Groups that are still shared are split by the
longer prefix that the windows themselves are: first whole runs of windows around an anchor, which copies share, then
single windows. Every split is an aggregation with partial sums and a join that Spark can split, so one passage in a
third of all documents is no group that some task has to hold.

Windows are known by two independent 64-bit hashes, of the anchor's prefix and of the window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.store import discard, stored
from indicatrix.llm.words import Hasher, bounds, buffers, chunks

LENGTH, PREFIX = 20, 5


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the first least one."""
    places, done = np.arange(len(values)), 1
    while done < width:
        step = min(done, width - done)
        a, b = places[:-step], places[step:]
        places = np.where(values[a] <= values[b], a, b)
        done += step
    return places


class Anchors:
    """Anchors of texts: prefix hash, text, place, first window and window hashes of each."""

    def __init__(self, length: int, prefix: int):
        self.length, self.prefix = length, prefix
        self.words, self.prefixes, self.windows = Hasher(11), Hasher(12), Hasher(13)

    def find(self, data, offsets):
        starts, ends, text = bounds(data, offsets)
        n = len(starts) - self.length + 1
        if n <= 0:
            return None
        hashes = self.words.words(data, starts, ends)
        at = np.arange(len(hashes) - self.prefix + 1)
        prefixes = self.prefixes.spans(hashes, at, at + self.prefix)
        anchor = least_places(prefixes, self.length - self.prefix + 1)
        begin = np.flatnonzero(text[:n] == text[self.length - 1 :])
        if not len(begin):
            return None
        windows = self.windows.spans(hashes, begin, begin + self.length)
        anchor = anchor[begin]
        new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(begin, prepend=-2) != 1))
        first_word = np.searchsorted(text, text[begin[new]])
        return prefixes[anchor[new]], text[begin[new]], anchor[new] - first_word, begin[new] - first_word, windows, np.append(new, len(begin))


def anchor_counts(docs: DataFrame, length: int, prefix: int) -> DataFrame:
    """How often each anchor prefix stands in the texts, counted within tasks first."""

    def run(batches):
        anchors = Anchors(length, prefix)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            parts = [x[0] for _, _, part, cuts in chunks(data, offsets) if (x := anchors.find(part, cuts)) is not None]
            if parts:
                seen, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch([pa.array(seen.view(np.int64)), pa.array(n)], ["anchor", "n"])

    return docs.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))


def anchor_places(docs: DataFrame, length: int, prefix: int) -> DataFrame:
    """A row per anchor: its prefix, document and place."""

    def run(batches):
        anchors = Anchors(length, prefix)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for first, _, part, cuts in chunks(data, offsets):
                if (x := anchors.find(part, cuts)) is not None:
                    ids = batch.column(1).take(pa.array(x[1] + first))
                    yield pa.record_batch([pa.array(x[0].view(np.int64)), ids, pa.array(x[2], pa.int32())], ["anchor", "doc_id", "place"])

    return docs.select("text", "doc_id").mapInArrow(run, "anchor long, doc_id long, place int")


def anchor_runs(docs: DataFrame, length: int, prefix: int) -> DataFrame:
    """A row per anchor at one of the document's ``places``, with its first window and the hashes of its windows."""

    def run(batches):
        anchors = Anchors(length, prefix)
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            lists = batch.column(2)
            wanted = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)) << 32 | lists.flatten().to_numpy()
            for first, _, part, cuts in chunks(data, offsets):
                if (x := anchors.find(part, cuts)) is None:
                    continue
                prefixes, text, place, begin, windows, edges = x
                kept = np.flatnonzero(np.isin((text + first) << 32 | place, wanted))
                runs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(windows.view(np.int64))).take(pa.array(kept))
                ids = batch.column(1).take(pa.array(text[kept] + first))
                yield pa.record_batch(
                    [pa.array(prefixes[kept].view(np.int64)), ids, pa.array(place[kept], pa.int32()), pa.array(begin[kept], pa.int32()), runs],
                    ["anchor", "doc_id", "place", "first", "windows"],
                )

    return docs.select("text", "doc_id", "places").mapInArrow(run, "anchor long, doc_id long, place int, first int, windows array<long>")


def later_windows(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX) -> DataFrame:
    """doc_id and ``spans``, (at, n) each: n windows from word ``at`` on, each of whose words also start earlier.

    Earlier is a smaller doc_id, or an earlier start in one document; a null doc_id is the smallest. Rows of one doc_id are
    one document: equal rows agree, and of different texts under one doc_id the windows are compared by their starts.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = stored(anchor_counts(docs, length, prefix).where("n > 1").select("anchor"), "shared-prefixes")
    # Where they stand, by document; only those anchors bring their windows along.
    places = anchor_places(docs, length, prefix).join(shared, "anchor").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("place").alias("places"))
    places = stored(places, "shared-places")
    placed = docs.join(places, F.col("doc_id").eqNullSafe(F.col("_id")))
    runs = stored(anchor_runs(placed, length, prefix).withColumn("run", F.xxhash64("windows")), "anchor-runs")
    discard(shared, places)

    # Copies: equal runs of windows around an anchor. All but the first are later altogether.
    own = F.struct("doc_id", "place")
    first = runs.groupBy("anchor", "run").agg(F.min(own).alias("earliest"), F.max(own).alias("latest")).where("earliest <> latest")
    first = stored(first.select("anchor", "run", "earliest"), "first-runs")
    judged = runs.join(first, ["anchor", "run"], "left").withColumn("copy", F.col("earliest").isNotNull() & (F.col("earliest") != own))
    judged = stored(
        judged.select("anchor", "doc_id", "first", "copy", F.size("windows").alias("n"), F.when(~F.col("copy"), F.col("windows")).alias("windows")), "judged-runs"
    )
    discard(runs, first)

    # The windows of first runs, one by one.
    windows = judged.where(~F.col("copy")).select("anchor", "doc_id", "first", F.posexplode("windows").alias("i", "window"))
    windows = windows.select("anchor", "window", "doc_id", (F.col("first") + F.col("i")).alias("at"))
    own = F.struct("doc_id", "at")
    earliest = windows.groupBy("anchor", "window").agg(F.min(own).alias("earliest"), F.max(own).alias("latest")).where("earliest <> latest")
    earliest = stored(earliest.select("anchor", "window", "earliest"), "first-windows")
    later = windows.join(earliest, ["anchor", "window"]).where(F.col("earliest") != own).select("doc_id", "at", F.lit(1).alias("n"))
    found = judged.where("copy").select("doc_id", F.col("first").alias("at"), "n").union(later)
    spans = stored(found.groupBy("doc_id").agg(F.collect_set(F.struct("at", "n")).alias("spans")), "later-windows")
    discard(judged, earliest)
    return spans


def covered(n_words: int, spans, length: int) -> np.ndarray:
    """Which words the windows cover."""
    marks = np.zeros(n_words + 1, np.int64)
    for span in spans:
        low, high = span["at"], min(span["at"] + span["n"] - 1 + length, n_words)
        if low < high:
            marks[low] += 1
            marks[high] -= 1
    return np.cumsum(marks[:-1]) > 0


def without_repeats(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX) -> DataFrame:
    """Documents with ``kept_text`` (words joined by one space), n_words and n_removed; other columns pass through.

    Words are runs outside ASCII white space, unchanged. A word goes if a window of ``length`` words that covers it also
    starts earlier; windows are judged on the input. Null and empty texts have no words. Columns of the added names are
    replaced.
    """
    result = "struct<kept_text:string,n_words:bigint,n_removed:bigint>"

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts.to_pylist(), spans.to_pylist()):
            words = (text or "").encode().split()
            gone = covered(len(words), found or (), length)
            kept = b" ".join([w for w, g in zip(words, gone) if not g] if gone.any() else words)
            out.append({"kept_text": kept.decode(), "n_words": len(words), "n_removed": int(gone.sum())})
        return pa.array(out, pa.struct([("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())]))

    spans = later_windows(docs, length, prefix).select(F.col("doc_id").alias("_id"), F.col("spans").alias("_spans"))
    docs = docs.drop("kept_text", "n_words", "n_removed")
    joined = docs.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left")
    made = joined.withColumn("_made", F.arrow_udf(cut, result)(F.col("text").cast("string"), F.col("_spans")))
    return made.select(*docs.columns, "_made.*")


def digest(docs: DataFrame) -> DataFrame:
    kept = without_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
