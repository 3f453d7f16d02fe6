"""Running totals and exact quantiles over data of any size.

A window without a partition key runs in one task. Here the rows are cut into
value ranges of about equal size, a window runs per range, and the totals of the
ranges before it, a row per million rows, are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatrix.session import materialise

# Rows that one range, and so one task, holds.
RANGE_ROWS = 1_000_000


def _place(key: str, cuts: list[float]) -> Column:
    """How many cut points lie below the key: first among groups of cut points, then inside one group."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]

    def below(points: Column) -> Column:
        return F.size(F.filter(points, lambda c: c < F.col(key)))

    literal = lambda values: F.array(*[F.lit(v) for v in values])
    coarse = below(literal([g[-1] for g in groups]))
    inside = F.get(F.array(*[literal(g) for g in groups]), coarse)
    return F.when(coarse < len(groups), coarse * width + below(inside)).otherwise(len(cuts))


def running_totals(
    groups: DataFrame, key: str, sums: dict[str, str], descending: bool = False, ranges: int | None = None
) -> DataFrame:
    """Add running sums over ``key`` order. ``groups`` has one row per numeric key value.

    ``sums`` maps a new column to the column it adds up, the current row included.
    ``groups`` is read several times, so pass a materialised table. Its size sets
    the number of ranges unless the caller does.
    """
    if ranges is None:
        ranges = max(1, -(-groups.count() // RANGE_ROWS))
    order = F.col(key).desc() if descending else F.col(key).asc()
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    if ranges == 1:
        return groups.withColumns({out: F.sum(src).over(upto) for out, src in sums.items()})
    # Any cut points give exact results; good ones only balance the tasks.
    steps = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(groups.approxQuantile(key, steps, min(0.001, 0.1 / ranges)))) if steps else []
    place = _place(key, cuts)
    ranged = groups.withColumn("_range", F.lit(ranges) - place if descending else place)

    # A row per range, so this one window stays small.
    totals = ranged.groupBy("_range").agg(*[F.sum(src).alias(f"_{out}") for out, src in sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(f"_{out}").over(before), F.lit(0)).alias(f"_{out}") for out in sums]
    )
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumns({out: F.sum(src).over(inside) for out, src in sums.items()})
        .join(offsets, "_range")
        .withColumns({out: F.col(out) + F.col(f"_{out}") for out in sums})
        .drop("_range", *[f"_{out}" for out in sums])
    )


def exact_quantiles(df: DataFrame, value: str, points: dict[str, float]) -> DataFrame:
    """One row of quantiles with linear interpolation, as ``percentile`` gives.

    ``percentile`` keeps every distinct value of a group in one task's memory;
    this reads the values at the wanted ranks off running counts instead.
    """
    counts = materialise(
        df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n")), "value-counts"
    )
    size = counts.agg(F.sum("_n")).first()[0] or 0
    ranked = running_totals(counts, value, {"_upto": "_n"})
    picks, results = [], []
    for name, p in points.items():
        place = (size - 1) * p
        low, high = math.floor(place), math.ceil(place)
        # The value at 0-based rank r is the least value with more than r rows up to it.
        picks += [
            F.min(F.when(F.col("_upto") > low, F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_upto") > high, F.col(value))).alias(f"_hi_{name}"),
        ]
        step = F.col(f"_hi_{name}") - F.col(f"_lo_{name}")
        results.append((F.col(f"_lo_{name}") + step * F.lit(place - low)).alias(name))
    return ranked.agg(*picks).select(*results)


def hash_ranks(df: DataFrame, group: str, key: str, seed: int, digits: int | None = None) -> DataFrame:
    """Rank the rows of each group, from 1, by the MD5 of ``key`` and a seed.

    Groups may be as few and as large as two classes: the leading hash digits cut
    each into ``16**digits`` even parts that are ranked apart. Without ``digits``
    the rows are counted, so pass a materialised table.
    """
    if digits is None:
        digits = 1
        rows = df.count()
        while rows > 16**digits * RANGE_ROWS:
            digits += 1
    hashed = df.withColumn("_md5", F.md5(F.concat(F.col(key), F.lit(f":{seed}")).cast("binary"))).withColumn(
        "_part", F.substring("_md5", 1, digits)
    )
    # One row per group and part.
    sizes = hashed.groupBy(group, "_part").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, "_part").orderBy("_md5", key)
    return (
        hashed.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, [group, "_part"])
        .withColumn("hash_rank", F.col("_rank") + F.col("_offset"))
        .drop("_md5", "_part", "_rank", "_offset")
    )
