"""Exact top-k by inner product: every query row against every row, in blocks.

Rows and queries are packed into blocks of bounded size. Query blocks are dealt to as many keys as their number asks for;
every row block meets each of them by an equality join on that key, and is itself dealt over a fixed number of slots, so no
key grows with the rows. In a task, scores accumulate term at a time: for each component of a query that is not zero, its
posting list (the rows with that component, and their weights) is scattered into a dense array of scores. Partition selection keeps
the rows that can be among the first k of their block; the blocks' lists are merged by a ranked window, cut before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatrix.session import materialise

SCALE = 256
ROWS_PER_BLOCK, QUERIES_PER_BLOCK, SLOTS = 8192, 512, 32
PACKED = "block long, ids binary, weights binary, width int, wide boolean"


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id and floor(256 x) of every component; vectors that are null, or hold null or non-finite components, are left out."""
    component = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    values = F.transform("embedding", lambda x: x.cast("double"))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v"))
    # A double of 2^52 or more is a whole number, and may not fit in the long that floor() gives.
    whole = lambda y: F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)
    return usable.where(F.forall("v", component)).select("vec_id", F.transform("v", lambda x: whole(x * SCALE)).alias("v"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows, as 64-bit ids and a dense table of whole-number weights."""

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column(1)
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
                width = int(lengths.max()) if len(lengths) else 0
                table = np.zeros((part.num_rows, width))
                table[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                wide = bool(np.abs(table).max(initial=0) >= 2**24)
                block += 1
                values = table if wide else table.astype(np.int32)
                yield pa.record_batch(
                    [pa.array([block]), pa.array([part.column(0).to_numpy().tobytes()]), pa.array([values.tobytes()]), pa.array([width], pa.int32()), pa.array([wide])],
                    ["block", "ids", "weights", "width", "wide"],
                )

    return rows.mapInArrow(run, PACKED)


def accumulated(query: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Scores of n rows for one query, term at a time over its components that are not zero."""
    scores = np.zeros(n, np.int64)
    for term in np.flatnonzero(query[: len(postings)]):
        rows, weights = postings[term]
        if len(rows) == n:
            scores += query[term] * weights
        elif len(rows):
            scores[rows] += query[term] * weights
    return scores


def exact_scores(query, table) -> np.ndarray:
    """For components of 2^24 and more: whole numbers of any size, held to the range of a long."""
    width = min(len(query), table.shape[1])
    q = [int(x) for x in query[:width]]
    sums = [sum(a * int(b) for a, b in zip(q, row)) for row in table[:, :width]]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in sums], np.int64)


def block_top(queries: DataFrame, k: int) -> DataFrame:
    """Per joined pair of blocks, the rows that can be among a query's first k."""

    def table(row, name):
        values = np.frombuffer(row[f"{name}weights"], np.float64 if row[f"{name}wide"] else np.int32)
        return np.frombuffer(row[f"{name}ids"], np.int64), values.reshape(-1, row[f"{name}width"]) if row[f"{name}width"] else None

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, rows = table(row, "")
                query_ids, asked = table(row, "q_")
                n = len(ids)
                rows = np.zeros((n, 0), np.int64) if rows is None else rows
                asked = np.zeros((len(query_ids), 0), np.int64) if asked is None else asked
                wide = row["wide"] or row["q_wide"]
                if not wide:
                    rows, asked = rows.astype(np.int64), asked.astype(np.int64)
                    postings = [(at := np.flatnonzero(column), column[at]) for column in rows.T]
                out = []
                for query_id, query in zip(query_ids, asked):
                    scores = exact_scores(query, rows) if wide else accumulated(query, postings, n)
                    others = np.flatnonzero(ids != query_id)
                    if len(others) > k:
                        # All rows at or above the k-th score, then the smaller ids among ties.
                        least = np.partition(scores[others], len(others) - k)[len(others) - k]
                        others = others[scores[others] >= least]
                        others = others[np.lexsort((ids[others], -scores[others]))[:k]]
                    out.append((np.full(len(others), query_id), ids[others], scores[others]))
                if out:
                    yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out)], ["query_id", "vec_id", "score"])

    return queries.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of each query row's k best other rows; ties go to the smaller vec_id.

    Other columns are ignored. A query is never matched with rows of its own vec_id. Vectors of different lengths meet over
    their common components. Of rows that repeat a vec_id and vector one is kept; if a vec_id has several vectors, each is a
    row, and the query is the first of them in array order. No rows, or no other rows, give no rows.
    """
    rows = materialise(scaled(vectors).dropDuplicates(), "vectors")
    asked = materialise(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "query-vectors")
    n_keys = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(n_keys))).repartition(n_keys, "part").drop("part")
    query_blocks = materialise(packed(dealt, QUERIES_PER_BLOCK), "query-blocks").withColumn("part", F.pmod(F.xxhash64("block"), F.lit(n_keys)))
    query_blocks = query_blocks.select(
        *(F.col(c).alias("q_" + c) for c in ("ids", "weights", "width", "wide")), "part", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("slot")
    )
    row_blocks = packed(rows, ROWS_PER_BLOCK).select(
        "ids", "weights", "width", "wide", F.pmod(F.xxhash64("block"), F.lit(SLOTS)).cast("int").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(n_keys - 1)).cast("array<long>")).alias("part")
    )
    best = block_top(row_blocks.hint("merge").join(query_blocks, ["part", "slot"]), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.col("vec_id") % 50 == 0)


# Whole numbers of up to 2^31 squared, summed over the components.
NEAREST_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows q JOIN rows r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""
