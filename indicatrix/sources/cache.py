"""Lookup caches of one row per key that grow without being rewritten.

A cache lies in buckets by a hash of its key. A merge adds a *delta*: the new rows alone, by bucket. Reading takes, per key,
the best row out of a bucket's base and the deltas since. A bucket whose deltas have become many, or heavy beside its base, is compacted
by itself. Each state is one commit that names its folders, so a reader sees a merge whole or not at all, and a broken merge
leaves only folders that nobody names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicatrix import schemas
from indicatrix.operators.picks import pick_one
from indicatrix.operators.skew import lookup_join
from indicatrix.sources import commits

BUCKETS = 64
MOST_DELTAS = 8  # of a bucket, before it is compacted
HEAVY = 0.5  # of the bytes of a bucket's base
BUCKET, SEQUENCE = "_bucket", "_sequence"


@dataclass(frozen=True)
class KeyedCache:
    """Rows of ``schema`` by ``keys``. Of several rows of a key the first by ``order`` counts, then the newest merge."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[Column | str, ...] = ()
    buckets: int = BUCKETS

    # -- reading ------------------------------------------------------------------

    def _state(self) -> tuple[int, dict]:
        number, state = commits.latest(self.spark, self.path)
        return number, state or {"buckets": self.buckets, "bases": {}, "deltas": []}

    def _folders(self, state: dict, buckets: set[str] | None = None) -> list[str]:
        """Folders of the base and the later deltas of each bucket."""
        found = [f"{base['folder']}/{BUCKET}={b}" for b, base in state["bases"].items() if (buckets is None or b in buckets) and base["bytes"]]
        for delta in state["deltas"]:
            for b in delta["bytes"]:
                if (buckets is None or b in buckets) and delta["sequence"] > state["bases"].get(b, {"upto": 0})["upto"]:
                    found.append(f"{delta['folder']}/{BUCKET}={b}")
        return [f"{self.path}/{folder}" for folder in found]

    def _stored(self, folders: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(SEQUENCE, T.LongType())])
        if not folders:
            return schemas.empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def rows(self) -> DataFrame:
        """All stored rows, a key possibly more than once. For readers that ask which keys there are."""
        return self._stored(self._folders(self._state()[1])).drop(SEQUENCE)

    def read(self, within: DataFrame | None = None) -> DataFrame:
        """One row per key. ``within``, rows of some key columns, keeps the keys that agree with one; others are not merged at all."""
        stored = self._stored(self._folders(self._state()[1]))
        if within is not None:
            # Very many rows may agree in some key columns.
            stored = lookup_join(stored, within.distinct(), within.columns, "left_semi")
        return self._best(stored).drop(SEQUENCE)

    def _best(self, stored: DataFrame) -> DataFrame:
        return pick_one(stored, list(self.keys), [*self.order, F.col(SEQUENCE).desc()])

    # -- writing ------------------------------------------------------------------

    def _write(self, df: DataFrame, folder: str, count: int) -> dict[str, int]:
        """Write rows by bucket; the bytes of each bucket."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(count)).cast("int")
        rows = df.withColumn(BUCKET, bucket).select(*self.schema.names, SEQUENCE, BUCKET)
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        target, files = commits.files_at(self.spark, f"{self.path}/{folder}")
        sizes = {}
        for status in files.listStatus(target):
            name = status.getPath().getName()
            if name.startswith(f"{BUCKET}="):
                sizes[name.split("=")[1]] = files.getContentSummary(status.getPath()).getLength()
        return sizes

    def merge(self, new: DataFrame) -> int:
        """Add rows and return the number of the merge. It writes as much as ``new`` holds, and compacts buckets that are due.

        Rows whose keys are null in part are rows like others. An empty ``new`` writes nothing.
        """
        number, state = self._state()
        sequence = number + 1
        folder = f"delta-{sequence:012d}-{uuid.uuid4().hex[:8]}"
        sizes = self._write(self._best(schemas.conform(new, self.schema).withColumn(SEQUENCE, F.lit(sequence).cast("bigint"))), folder, state["buckets"])
        if not sizes:
            self._delete(folder)
            return number
        state["deltas"].append({"sequence": sequence, "folder": folder, "bytes": sizes})
        commits.commit(self.spark, self.path, sequence, state)
        due = self._due(state)
        return self.compact(due) if due else sequence

    def _due(self, state: dict) -> list[str]:
        """Buckets whose deltas are many, or heavy beside what they add to."""
        many: dict[str, list[int]] = {}
        for delta in state["deltas"]:
            for b, size in delta["bytes"].items():
                if delta["sequence"] > state["bases"].get(b, {"upto": 0})["upto"]:
                    many.setdefault(b, []).append(size)
        base = lambda b: state["bases"].get(b, {"bytes": 0})["bytes"]
        return [b for b, sizes in many.items() if len(sizes) > MOST_DELTAS or (len(sizes) > 1 and base(b) and sum(sizes) > HEAVY * base(b))]

    def compact(self, buckets: Sequence[str] | None = None) -> int:
        """Merge the named buckets, or all, into new bases; others stay as they lie. Folders that no commit of the last two names go."""
        number, state = self._state()
        known = {b for d in state["deltas"] for b in d["bytes"]} | set(state["bases"])
        chosen = known if buckets is None else known & set(buckets)
        if not chosen:
            return number
        sequence, folder = number + 1, f"base-{number + 1:012d}-{uuid.uuid4().hex[:8]}"
        sizes = self._write(self._best(self._stored(self._folders(state, chosen))), folder, state["buckets"])
        for b in chosen:
            state["bases"][b] = {"folder": folder, "upto": number, "bytes": sizes.get(b, 0)}
        live = lambda d: {b: n for b, n in d["bytes"].items() if d["sequence"] > state["bases"].get(b, {"upto": 0})["upto"]}
        state["deltas"] = [{**d, "bytes": left} for d in state["deltas"] if (left := live(d))]
        commits.commit(self.spark, self.path, sequence, state)
        self.clean(sequence - 1)
        return sequence

    def clean(self, since: int) -> None:
        """Remove what no commit from ``since`` on names."""
        commits.drop_before(self.spark, self.path, since)
        states = [commits.get(self.spark, f"{self.path}/{commits.FOLDER}/{n:012d}.json") for n in commits.numbers(self.spark, self.path)]
        named = {e["folder"] for s in states for e in [*s["bases"].values(), *s["deltas"]]}
        for name in commits.names_in(self.spark, self.path):
            if name.startswith(("delta-", "base-")) and name not in named:
                self._delete(name)

    def _delete(self, folder: str) -> None:
        target, files = commits.files_at(self.spark, f"{self.path}/{folder}")
        files.delete(target, True)


def geo_cache(spark: SparkSession, path: str) -> KeyedCache:
    """One row per resolved pair; newer merges win."""
    return KeyedCache(spark, path, schemas.DNS_GEO, ("puny_domain", "ip"))


def whois_cache(spark: SparkSession, path: str) -> KeyedCache:
    """One row per domain in lower case; the latest fetch wins."""
    return KeyedCache(spark, path, schemas.WHOIS, ("domain",), (F.col("fetched_at").desc_nulls_last(),))
