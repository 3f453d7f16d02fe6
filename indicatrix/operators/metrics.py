"""Ranking quality of scores: ROC-AUC, average precision, recall at a false-positive limit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatrix.operators.ordered import running_totals
from indicatrix.session import materialise

FPR_LIMIT = 0.01


def _curve(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row per score, best first, with positives and negatives so far and in all."""
    groups = materialise(
        scored.filter(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")),
        "score-groups",
    )
    total = groups.agg(F.sum("p"), F.sum("n")).first()
    ranked = running_totals(groups, "score", {"tp": "p", "fp": "n"}, descending=True)
    return ranked.withColumns({"tp_all": F.lit(total[0] or 0), "fp_all": F.lit(total[1] or 0)})


def evaluate(scored: DataFrame, label: str = "label", score: str = "score", limit: float = FPR_LIMIT) -> DataFrame:
    """The three measures in one row. Equal scores are one step of the curve.

    Average precision adds up precision over recall steps; it is not the
    trapezoid area under the precision-recall curve.
    """
    positives = F.nullif(F.col("tp_all").cast("double"), F.lit(0.0))
    negatives = F.nullif(F.col("fp_all").cast("double"), F.lit(0.0))
    # A negative loses against every positive above it, and half against equal ones.
    wins = F.col("n").cast("double") * (F.col("tp") - F.col("p")) + F.col("p") * F.col("n") * 0.5
    precision = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    within = F.col("fp") / negatives <= limit
    return _curve(scored, label, score).agg(
        (F.sum(wins) / F.max(positives * negatives)).alias("roc_auc"),
        F.sum(F.col("p") / positives * precision).alias("pr_auc"),
        F.max(F.when(within, F.col("tp") / positives).otherwise(0.0)).alias("recall_at_1pct"),
    )


def compare(models: dict[str, DataFrame], label: str = "label", score: str = "score") -> DataFrame:
    """One row of measures per model."""
    rows = [evaluate(df, label, score).select(F.lit(name).alias("model"), "*") for name, df in models.items()]
    return reduce(DataFrame.unionByName, rows)
