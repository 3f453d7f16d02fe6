"""Joins of raw rows to lookup tables when a few keys hold much of the rows.

AQE splits a skewed sort-merge join only where both sides come straight out of
a shuffle. Lookup tables mostly come out of a de-duplication on the join key, so
hot keys are spread here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task may meet.
HOT_ROWS = 1_000_000
# Tasks that rows without a key are dealt out to.
KEYLESS_PARTS = 4096
# Largest table that is sent to all executors.
BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table holds at most ``rows`` rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    small: bool = False,
) -> DataFrame:
    """Join rows to a table with one row per key, whatever the skew of the rows.

    ``small`` says that the caller measured ``right`` with ``is_small``; it is
    then broadcast. Otherwise a key of more than ``hot_rows`` rows is cut into
    parts of about that size by a hash of the whole row, and its lookup row is
    repeated once per part. Identical rows share a part, so pass distinct rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small:
        return left.join(F.broadcast(right), keys, how)
    # Every hot key stands for at least hot_rows rows, which bounds this table
    # and all its parts by the number of rows divided by hot_rows.
    hot = (
        left.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts"))
    )
    row = F.xxhash64(*left.columns)
    part = F.coalesce(F.pmod(row, F.col("_parts")).cast("int"), F.lit(0))
    # Rows without a key match nothing and may go anywhere.
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = left.join(F.broadcast(hot), keys, "left").withColumn(
        "_part", F.when(keyless, F.pmod(row, F.lit(KEYLESS_PARTS)).cast("int")).otherwise(part)
    )
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    copies = right.join(F.broadcast(hot), keys, "left").withColumn("_part", parts).drop("_parts")
    return spread.join(copies, [*keys, "_part"], how).drop("_part", "_parts")
