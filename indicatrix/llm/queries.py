"""Registered queries of this subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from indicatrix.llm import bpe, chat, ctw, decontaminate, mixing, periods, rollups, secrets, simhash, substrings, topk, toxicity, whitening
from indicatrix.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, *tables: str, sql: str | None = None):
    """Register a function of the named tables."""

    def add(build: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return build(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return add


query("op1_secret_scans", "documents")(secrets.digest)
query("op2_simhash_near_dedup", "documents")(simhash.near_duplicates)
query("op3_toxicity", "documents", "labels")(toxicity.toxicity)
query("op4_exact_top_k", "embeddings", sql=topk.NEAREST_SQL)(topk.nearest)
query("op5_token_counts", "documents", sql=rollups.TOTALS_SQL)(rollups.token_totals)
query("op6_mixing", "documents", sql=mixing.MIX_SQL)(mixing.mix_digest)
query("op7_benchmark_decontamination", "documents", "benchmark")(decontaminate.contamination)
query("op8_chat_formatting", "conversations", sql=chat.DIGEST_SQL)(chat.digest)
query("op9_substring_dedup", "documents")(substrings.digest)
query("op10_lm_scoring", "documents")(ctw.scores)
query("op11_periodic_runs", "documents")(periods.digest)
query("op12_embedding_whitening", "embeddings")(whitening.whiten)
query("op13_bpe", "documents")(bpe.digest)
