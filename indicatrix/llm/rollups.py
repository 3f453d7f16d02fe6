"""Token totals by source, language and tokenizer version, kept current by signed deltas.

A change says what happened to one document: ``insert`` adds its count, ``delete`` takes it back, ``revise`` replaces an old
count. A batch of changes becomes one folder of additive deltas, a row per key, under the batch's name. The folder counts
once Spark has finished writing it; committing the same batch again changes nothing, and a batch that broke off is written
anew. Totals are the sums over the finished batches. Compaction replaces batches by their sum and keeps their names, so
late repeats are still known.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatrix.session import materialise, scratch_dir

KEYS = ["source", "lang", "tokenizer"]
KINDS = "source string, lang string, tokenizer string, documents long, tokens long"
DONE = "_SUCCESS"


def signed(changes: DataFrame) -> DataFrame:
    """Additive deltas per key. ``changes`` has op, KEYS, tokens, and old_tokens for revised counts.

    Null keys are keys of their own, null counts are 0, and an unknown or null op counts nothing. Repeated rows are
    changes of their own: a change feed has to name each change once.
    """
    new, old = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("tokens", "old_tokens"))
    op = F.col("op")
    return (
        changes.where(op.isin("insert", "delete", "revise"))
        .select(
            *(F.col(k).cast("string").alias(k) for k in KEYS),
            F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0).cast("long").alias("documents"),
            F.when(op == "insert", new).when(op == "delete", -new).otherwise(new - old).alias("tokens"),
        )
        .groupBy(*KEYS)
        .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    )


class Rollup:
    """A folder of committed batches. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _is_done(self, name: str) -> bool:
        return self._fs.exists(self._fs_path(f"{self.path}/{name}/{DONE}"))

    def _folders(self) -> list[str]:
        at = self._fs_path(self.path)
        if not self._fs.exists(at):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(at) if s.isDirectory())
        return sorted(n for n in names if self._is_done(n))

    def _live(self) -> list[str]:
        """Finished folders, without batches that a finished compaction contains."""
        names = self._folders()
        packed = {b for n in names if n.startswith("compact-") for b in self._names_in(n)}
        return [n for n in names if n not in packed]

    def _names_in(self, folder: str) -> list[str]:
        rows = self.spark.read.schema("batch string").parquet(f"{self.path}/names-{folder}")
        return [r["batch"] for r in rows.collect()]

    def committed(self, batch: str) -> bool:
        name = f"batch-{batch}"
        return self._is_done(name) or any(self._holds(n, name) for n in self._folders() if n.startswith("compact-"))

    def _holds(self, folder: str, name: str) -> bool:
        names = self.spark.read.schema("batch string").parquet(f"{self.path}/names-{folder}")
        return not names.where(F.col("batch") == name).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch; False if one of that name is already in."""
        if self.committed(batch):
            return False
        signed(changes).write.mode("overwrite").parquet(f"{self.path}/batch-{batch}")
        return True

    def totals(self) -> DataFrame:
        """KEYS, documents and tokens over the committed batches; keys without documents and tokens are left out."""
        live = [n for n in self._live() if not n.startswith("names-")]
        if not live:
            return self.spark.createDataFrame([], KINDS)
        parts = [self.spark.read.schema(KINDS).parquet(f"{self.path}/{n}") for n in live]
        sums = reduce(DataFrame.unionByName, parts).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where((F.col("documents") != 0) | (F.col("tokens") != 0))

    def compact(self, name: str) -> None:
        """Sums the live batches into one folder; the batches stay on disk until somebody removes them."""
        live = [n for n in self._live() if not n.startswith("names-")]
        folder = f"compact-{name}"
        if folder in live or not live:
            return
        sums = self.totals()
        known = [b for n in live if n.startswith("compact-") for b in self._names_in(n)]
        names = self.spark.createDataFrame([(b,) for b in [*live, *known]], "batch string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/names-{folder}")
        sums.write.mode("overwrite").parquet(f"{self.path}/{folder}")


WORD = r"[^\x20\x09-\x0D]+"
LONE_BAR = r"(?<![^\x20\x09-\x0D])\|(?![^\x20\x09-\x0D])"
SHORT = 40


def token_totals(docs: DataFrame) -> DataFrame:
    """The totals of all documents by source, language and tokenizer version, after a history that ends with the whole table.

    Versions are words@1, words@2, which does not count table bars, and bytes@1 (UTF-8). Counts are loaded as an older run left
    them, then revised to the true ones; documents of under 40 characters are deleted and inserted again. Each batch is
    committed twice, as after a lost answer; the totals do not change. Null and empty texts are documents without tokens; rows
    with null or repeated ids are documents of their own; other columns are ignored; an empty table has no totals.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = materialise(
        docs.select(
            "source",
            "lang",
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
            F.regexp_count(text, F.lit(LONE_BAR)).cast("long").alias("bars"),
            F.octet_length(text).cast("long").alias("bytes"),
            F.length(text).cast("long").alias("letters"),
        ).withColumn("short", F.col("letters") < SHORT),
        "token-counts",
    )
    # The true count of each version, and the one it is loaded with.
    true = {"words@1": "words", "words@2": "words - bars", "bytes@1": "bytes"}
    stale = {"words@1": "words - bars", "words@2": "words", "bytes@1": "letters"}

    def changes(op: str, tokens: dict[str, str], old: dict[str, str] | None = None, where: str = "true") -> DataFrame:
        parts = [
            counted.where(where).select(
                F.lit(op).alias("op"), "source", "lang", F.lit(name).alias("tokenizer"), F.expr(count).alias("tokens"), F.expr(old[name] if old else "0").alias("old_tokens")
            )
            for name, count in tokens.items()
        ]
        changed = reduce(DataFrame.unionByName, parts)
        return changed.where("tokens <> old_tokens") if old else changed

    rollup = Rollup(docs.sparkSession, scratch_dir(docs.sparkSession, "token-rollup"))
    batches = {
        "load": changes("insert", stale),
        "revise": changes("revise", true, stale),
        "retire": changes("delete", true, where="short"),
        "return": changes("insert", true, where="short"),
    }
    for name, batch in batches.items():
        rollup.commit(name, batch)
        rollup.commit(name, batch)
    return rollup.totals()


TOTALS_SQL = r"""
WITH counted AS (
  SELECT source, lang, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, strlen(coalesce(text, '')) AS bytes FROM documents)
SELECT source, lang, 'words@1' AS tokenizer, count(*) AS documents, CAST(sum(len(words)) AS BIGINT) AS tokens FROM counted GROUP BY ALL
UNION ALL
SELECT source, lang, 'words@2', count(*), CAST(sum(len(list_filter(words, lambda w: w <> '|'))) AS BIGINT) FROM counted GROUP BY ALL
UNION ALL
SELECT source, lang, 'bytes@1', count(*), CAST(sum(bytes) AS BIGINT) FROM counted GROUP BY ALL
"""
