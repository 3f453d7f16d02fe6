"""Incremental lookup caches: what to fetch, how to merge, what to publish."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicatrix import schemas
from indicatrix.functions.ip import address_halves, ip_family, network_bounds
from indicatrix.operators import picks
from indicatrix.operators.skew import lookup_join
from indicatrix.session import materialise

# Functions of this module travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a range of the address line, and rows per range by which its cuts are chosen.
RANGE_ROWS, SAMPLED = 1_000_000, 50

PAIR = ["puny_domain", "ip"]


def missing_pairs(pairs: DataFrame, cache: DataFrame) -> DataFrame:
    """Resolved (domain, address) pairs that the cache does not hold.

    Both sides are distinct, so no key holds more than one row.
    """
    return pairs.select(*PAIR).distinct().join(cache.select(*PAIR).distinct(), PAIR, "left_anti")


def refresh_list(
    domains: DataFrame, cache: DataFrame, now: Column, ttl_days: int = 30, error_days: int = 7
) -> DataFrame:
    """Domains to fetch: not cached, stale, or failed and due for another try."""
    age = now - F.col("fetched_at")
    fresh = F.coalesce(age < F.make_dt_interval(F.lit(ttl_days)), F.lit(False))
    failed = F.coalesce(F.col("error") != "", F.lit(False))
    due = F.coalesce(age >= F.make_dt_interval(F.lit(error_days)), F.lit(False))
    state = cache.groupBy(F.lower("domain").alias("domain")).agg(F.bool_or(~fresh | (failed & due)).alias("_due"))
    wanted = domains.select("domain").distinct().join(state, "domain", "left")
    return wanted.filter(F.coalesce("_due", F.lit(True))).select("domain")


def daily_snapshot(cache: DataFrame, domains: DataFrame, key: str) -> DataFrame:
    """The cache rows of today's domains. A domain may have very many addresses."""
    return lookup_join(cache, domains.select(key).distinct(), key, "left_semi")


def attach_geo(pairs: DataFrame, geo: DataFrame) -> DataFrame:
    """Pairs with address family and the geo attributes of their address.

    Very many domains may share an address.
    """
    by_ip = picks.pick_one(schemas.conform(geo, schemas.GEO), ["ip"], ["country", "asn"])
    rows = pairs.select(*PAIR).distinct().withColumn("family", ip_family(F.col("ip")))
    return schemas.conform(lookup_join(rows, by_ip, "ip"), schemas.DNS_GEO)


def upsert_geo(cache: DataFrame, new: DataFrame) -> DataFrame:
    """One row per pair, new rows win."""
    return picks.upsert(cache, new, PAIR)


def upsert_whois(cache: DataFrame, new: DataFrame) -> DataFrame:
    """One row per domain, the latest fetch wins."""
    both = cache.unionByName(new, allowMissingColumns=True).withColumn("domain", F.lower("domain"))
    return picks.latest_whois(both)


def locate_ips(ips: DataFrame, blocks: DataFrame) -> DataFrame:
    """Attributes of the network block that holds each address, IPv4 and IPv6 alike; the narrowest block wins.

    ``blocks`` carries ``network`` as ``address/width`` plus attributes. Blocks and addresses are numbers on one line, cut into
    ranges of about RANGE_ROWS of both. A block goes to each range it touches: blocks around a cut lie inside each other, so a cut
    repeats at most one per width. In a range, blocks are flattened to stretches that do not overlap, and an address takes the last
    stretch that begins at or before it. Each address is shuffled twice, whatever the widths in use.
    """
    attributes = [c for c in blocks.columns if c != "network"]
    width = F.substring_index("network", "/", -1).try_cast("int")
    sized = blocks.withColumns({"_at": address_halves(F.substring_index("network", "/", 1)), "_width": width})
    sized = sized.filter(F.col("_at").isNotNull() & (F.col("_width") >= 0) & (F.col("_width") <= F.when(F.col("_at.family") == 4, 32).otherwise(128)))
    first, last = network_bounds(F.col("_at"), F.col("_width"))
    # Of repeated networks the one that sorts first.
    known = sized.groupBy(first.alias("_first"), last.alias("_last"), "_width").agg(F.min(F.struct("network", *attributes)).alias("_block"))
    known = materialise(known, "blocks")
    numbered = materialise(ips.select("ip").distinct().withColumn("_at", address_halves(F.col("ip"))), "addresses")
    placed = numbered.where("_at IS NOT NULL")
    part = range_number(placed.select("_at"), known.select(F.col("_first").alias("_at")))

    touched = F.explode(F.sequence(part(F.col("_first")), part(F.col("_last")))).alias("_part")
    stretches = flattened(known.select(touched, "_first", "_last", "_width", "_block"))
    line = placed.select(part(F.col("_at")).alias("_part"), "_at", "ip", F.lit(None).cast(stretches.schema["_block"].dataType).alias("_block"))
    line = line.unionByName(stretches.select("_part", "_at", F.lit(None).cast("string").alias("ip"), "_block"))
    # Stretches come before addresses at the same place.
    before = Window.partitionBy("_part").orderBy("_at", F.col("ip").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_block", F.last("_block", ignorenulls=True).over(before)).where("ip IS NOT NULL")
    nowhere = numbered.where("_at IS NULL").select("ip", F.lit(None).cast(stretches.schema["_block"].dataType).alias("_block"))
    return found.select("ip", "_block").unionByName(nowhere).select("ip", "_block.network", *[f"_block.{a}" for a in attributes])


def range_number(*lines: DataFrame) -> Callable[[Column], Column]:
    """The range of a place ``_at``, among ranges of about RANGE_ROWS rows of all tables, cut at places out of them.

    Cuts are even ranks of a sample by hash, SAMPLED rows per range.
    """
    rows = reduce(DataFrame.unionByName, lines)
    count = rows.count()
    ranges = max(1, -(-count // RANGE_ROWS))
    if ranges == 1:
        return lambda at: F.lit(0)
    sample = sorted(tuple(r[0]) for r in rows.orderBy(F.xxhash64("_at"), "_at").limit(SAMPLED * ranges).collect())
    cuts = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)})
    # First among about the root of all cuts, then among those between two of them.
    step = max(1, round(len(cuts) ** 0.5))
    place = lambda c: F.struct(F.lit(c[0]).alias("family"), F.lit(c[1]).cast("bigint").alias("hi"), F.lit(c[2]).cast("bigint").alias("lo"))
    groups = [cuts[k : k + step] for k in range(0, len(cuts), step)]
    heads = F.array(*[place(g[0]) for g in groups])
    rest = F.array(F.array().cast("array<struct<family:int,hi:bigint,lo:bigint>>"), *[F.array(*[place(c) for c in g]) for g in groups])

    def number(at: Column) -> Column:
        group = F.size(F.filter(heads, lambda c: c <= at))
        inside = F.size(F.filter(F.get(rest, group), lambda c: c <= at))
        return F.when(group == 0, 0).otherwise((group - 1) * step + inside).cast("int")

    return number


def flattened(blocks: DataFrame) -> DataFrame:
    """(_part, _at, _block): where in a range another block becomes the narrowest; a block of nulls where none is left.

    Blocks of a range come in order, the wider first, and lie inside each other or apart, so a stack holds the open ones.
    """
    kind = blocks.schema["_block"].dataType

    def run(batches):
        stack: list[tuple] = []
        part, written = None, 0

        def close(until, out):
            """Blocks that end before a place."""
            while stack and (until is None or stack[-1][0] < until):
                end, _ = stack.pop()
                out.append((part, _after(end), stack[-1][1] if stack else {}))

        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                first, last = tuple(row["_first"].values()), tuple(row["_last"].values())
                if row["_part"] != part:
                    close(None, out)
                    part = row["_part"]
                close(first, out)
                stack.append((last, row["_block"]))
                out.append((part, first, row["_block"]))
            kind_of_block = batch.schema.field("_block").type
            yield _stretches(out, written, kind_of_block)
            written += len(out)
        out = []
        close(None, out)
        if out:
            yield _stretches(out, written, kind_of_block)

    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_at", blocks.schema["_first"].dataType), T.StructField("_order", T.LongType()), T.StructField("_block", kind)])
    ordered = blocks.repartition("_part").sortWithinPartitions("_part", "_first", "_width")
    rows = ordered.mapInArrow(run, schema)
    # Of several stretches that begin at one place the last one written.
    return rows.groupBy("_part", "_at").agg(F.max_by("_block", "_order").alias("_block"))


def _after(end: tuple[int, int, int]) -> tuple[int, int, int]:
    """The next address; after the last one of a family, the first of the next family."""
    family, hi, lo = end
    if family == 4:
        return (4, 0, lo + 1)
    if lo < 2**63 - 1:
        return (6, hi, lo + 1)
    return (6, hi + 1, -(2**63)) if hi < 2**63 - 1 else (7, 0, 0)


def _stretches(rows: list[tuple], written: int, kind):
    import pyarrow as pa

    at = pa.struct([("family", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])
    part, places, block = (list(x) for x in zip(*rows)) if rows else ([], [], [])
    starts = [dict(zip(("family", "hi", "lo"), p)) for p in places]
    order = range(written, written + len(rows))
    return pa.record_batch([pa.array(part, pa.int32()), pa.array(starts, at), pa.array(order, pa.int64()), pa.array(block, kind)], ["_part", "_at", "_order", "_block"])
