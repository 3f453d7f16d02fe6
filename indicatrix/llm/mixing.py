"""Mixing sources to target weights by capped water-filling, and seeded sampling of repetitions.

Targets share a total by weight. A source stops at ``max_epochs`` times its size; what it cannot take is shared again by
weight until no target is above its cap. In the order of cap over weight, the capped sources are a prefix, so the level of
the others follows from running sums over the sources.

A source with target / size = r takes every document floor(r) times, and once more the documents that come first in a seeded
order, until the target is met; the document at the border gives the words that are missing. The border is found by counts
per bucket of the order, so only one bucket of a source is ever sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatrix.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3


def sized(docs: DataFrame) -> DataFrame:
    """Adds ``size``, the number of words; a null text has none."""
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long"))


def repeating_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights in turn to sources by code point, null last. ``sources`` has a row per source."""
    at = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8")))
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (at - 1) % len(weights) + 1).cast("double"))


def targets(sources: DataFrame, max_epochs: int = 3, share: float = 1.0) -> DataFrame:
    """Adds ``target`` to rows of source, source_size and weight (above 0); they share ``share`` of all sizes."""
    cap = F.col("source_size") * F.lit(max_epochs)
    ratio = cap / F.col("weight")
    before = Window.orderBy(ratio, F.col("source").isNull(), F.encode("source", "utf-8")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everyone = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everyone).cast("double") * share
    ranked = sources.withColumns(
        {
            "_cap": cap.cast("double"),
            "_total": total,
            "_capped": F.sum(cap).over(before).cast("double"),
            "_free": F.sum("weight").over(everyone) - F.sum("weight").over(before),
        }
    )
    # With this source and those before it capped, the level of the rest; it is capped if that level reaches its own ratio.
    level_before = (F.col("_total") - (F.col("_capped") - F.col("_cap"))) / (F.col("_free") + F.col("weight"))
    ranked = ranked.withColumns({"_level": level_before, "_full": level_before * F.col("weight") >= F.col("_cap")})
    level = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(everyone)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("weight") * level)
    return ranked.withColumn("target", target).select(*sources.columns, "target")


def seeded_order(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def taken_words(sizes: DataFrame, plan: DataFrame, seed: int, totals_of: DataFrame | None = None) -> DataFrame:
    """Adds ``taken`` to rows of doc_id, source and size. ``plan`` has source, source_size and target, a row per source.

    ``totals_of`` holds the same rows without what else they carry. Only rows of a source's border bucket are shuffled.
    """
    ordered = lambda rows: rows.withColumn("_order", seeded_order(F.col("doc_id"), seed)).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    keyed = ordered(sizes)
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    goals = plan.select(
        F.col("source").alias("_source"), "source_size", "target", whole.alias("whole"), (F.round("target").cast("long") - whole * F.col("source_size")).alias("goal")
    )
    totals = (keyed if totals_of is None else ordered(totals_of)).groupBy("source", "_bucket").agg(F.sum("size").alias("n"))
    until = Window.partitionBy("source").orderBy("_bucket")
    border = (
        totals.withColumn("before", F.sum("n").over(until) - F.col("n"))
        .join(goals, F.col("source").eqNullSafe(F.col("_source")))
        .where((F.col("before") < F.col("goal")) & (F.col("goal") <= F.col("before") + F.col("n")))
        .select("_source", F.col("_bucket").alias("border"), "before")
    )
    known = goals.join(border.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    known = materialise(known, "mix-goals")
    # One row per source: broadcast by the size Spark reads from the stored table, else a shuffled join.
    joined = keyed.join(known, F.col("source").eqNullSafe(F.col("_source")), "left")
    at_border = joined.where(F.col("_bucket") == F.col("border"))
    in_order = Window.partitionBy("source").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = at_border.withColumn("_end", F.col("before") + F.sum("size").over(in_order))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("goal") - (F.col("_end") - F.col("size"))))
    sorted_part = ranked.withColumn("taken", F.col("whole") * F.col("size") + extra)
    rest = joined.where(F.col("border").isNull() | (F.col("_bucket") != F.col("border")))
    rest = rest.withColumn("taken", F.col("whole") * F.col("size") + F.when(F.col("_bucket") < F.col("border"), F.col("size")).otherwise(F.lit(0)))
    columns = [*sizes.columns, "source_size", "target", "taken"]
    return sorted_part.select(*columns).unionByName(rest.select(*columns))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, share: float = 1.0, seed: int = 42) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every document.

    Null texts have size 0, a null source is one source, the last; a source without words has target 0. Repeated rows are
    documents of their own; of rows with one doc_id, source and size any may be at the border. Reruns agree.
    """
    sizes = sizes_of(docs)
    return taken_words(sizes, plan_of(sizes, weights, max_epochs, share), seed)


def sizes_of(docs: DataFrame) -> DataFrame:
    return materialise(sized(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "size"), "sizes")


def plan_of(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int, share: float) -> DataFrame:
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    return materialise(targets(repeating_weights(sources, weights), max_epochs, share), "mix-plan")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, share: float = 1.0, seed: int = 42) -> DataFrame:
    """The documents that the mix takes words of, with size, target and taken; columns of these names are replaced.

    Every row is judged by itself, also rows that share an id or are equal throughout. Rows carry their columns along, so
    nothing is joined back.
    """
    sizes = sizes_of(docs)
    carried = docs.select(F.struct("*").alias("_row"), "text", F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    taken = taken_words(sized(carried).drop("text"), plan_of(sizes, weights, max_epochs, share), seed, sizes).where("taken > 0")
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("size", "target", "taken")]
    return taken.select(*kept, "size", "target", F.col("taken").cast("long").alias("taken"))


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


# The same in plain window functions, for the check of the result.
MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, 1.0::DOUBLE + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS weight FROM sources),
running AS (
  SELECT *, CAST(source_size * 3 AS DOUBLE) AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
    CAST(sum(source_size * 3) OVER prior AS DOUBLE) AS capped, sum(weight) OVER () - sum(weight) OVER prior AS free
  FROM weighed
  WINDOW prior AS (ORDER BY source_size * 3 / weight, source IS NULL, encode(source) ROWS UNBOUNDED PRECEDING)),
levels AS (SELECT *, (total - (capped - cap)) / (free + weight) AS level FROM running),
plan AS (
  SELECT source, source_size, CASE WHEN level * weight >= cap THEN cap
    ELSE weight * (SELECT level FROM levels WHERE level * weight < cap ORDER BY cap / weight, source IS NULL, encode(source) LIMIT 1) END AS target
  FROM levels),
goals AS (
  SELECT *, CAST(floor(target / greatest(source_size, 1)) AS BIGINT) AS whole FROM plan),
ordered AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole,
    CAST(round(g.target) AS BIGINT) - g.whole * g.source_size AS goal,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('42:' || CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sizes d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(size, goal - (upto - size))) AS BIGINT) AS taken
FROM ordered
"""
