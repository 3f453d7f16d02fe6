"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatrix.llm import copies, decontaminate, mixing, secrets, store, toxicity
from indicatrix.session import configure, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not predict toxic; rows with null or repeated ids are judged by their texts."""
    configure(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select(F.struct("*").alias("_row"), "text")
    scored = toxicity.with_score(rows, toxicity.fit(docs, labels), "_score")
    return scored.where(F.col("_score") < 0.5).select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: a row of the smallest doc_id.

    Near duplicates share 0.8 or more of their five-word shingles; SimHash fingerprints and a prefix join bring pairs, whole sets are compared. Groups are of texts, so rows that share a doc_id, or have none, are judged by their own texts. A null doc_id is kept
    only if no row of its group has another; of rows alike in doc_id and text one is kept.
    """
    configure(spark)
    key = copies.text_key()
    rows = docs.groupBy(key.alias("_key"), F.col("doc_id").cast("long").alias("_id")).agg(F.count("*").alias("_rows"))
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_rows")).alias("first")
    texts = store.stored(rows.groupBy("_key").agg(first), "distinct-texts")
    roots = copies.roots(docs).withColumnRenamed("node", "_key")
    kept = texts.join(roots, "_key", "left").groupBy(F.coalesce("root", "_key").alias("root")).agg(F.min(F.struct("first._none", "first._id", "_key", "first._rows")).alias("kept"))
    kept = materialise(kept.select("kept._key", "kept._id", "kept._rows"), "first-documents")

    # The row itself in one column, so that no name of its own meets the ones used here.
    whole = docs.select(F.struct("*").alias("_row"), key.alias("_text"), F.col("doc_id").cast("long").alias("_doc"))

    def rows_of(chosen: DataFrame) -> DataFrame:
        return whole.join(chosen, (F.col("_text") == F.col("_key")) & F.col("_doc").eqNullSafe(F.col("_id")), "left_semi")

    found = rows_of(kept.where("_rows = 1"))
    repeated = kept.where("_rows > 1")
    if not repeated.isEmpty():
        found = found.union(rows_of(repeated).dropDuplicates(["_text"]))
    return found.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    configure(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; null texts stay null."""
    configure(spark)
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words taken of each row; rows without words are not taken."""
    configure(spark)
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# Scores, fingerprints over hashes and the latent search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
