"""Partitioned tables: pruned scans, idempotent writes, versioned caches, documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicatrix import schemas
from indicatrix.sources import commits
from indicatrix.sources.commits import files_at

PARTITION = "ingest_date"


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = files_at(spark, path)
    return files.exists(target)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, skip_unreadable: bool = False
) -> DataFrame:
    """A Parquet table; columns of all files are kept. Of published days it is the attempt that was committed last.

    With a schema, a table that was never written reads as empty. A damaged file
    is an error unless the caller asks to skip such files and reports them with
    ``unreadable_files``.
    """
    reader = spark.read.option("ignoreCorruptFiles", skip_unreadable).option("recursiveFileLookup", False)
    folders = live_folders(spark, path)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    if folders is None:
        if schema is not None and not path_exists(spark, path):
            return schemas.empty(spark, schema)
        return reader.parquet(path)
    if not folders and schema is not None:
        return schemas.empty(spark, schema)
    return reader.option("basePath", path).parquet(*folders)


def live_folders(spark: SparkSession, path: str) -> list[str] | None:
    """What of a table with published days is to be read: each day's last committed attempt, and days written without attempts.

    None for a table that has no published days.
    """
    known = _committed(spark, path)
    days = [n for n in commits.names_in(spark, path) if n.startswith(f"{PARTITION}=")]
    if not known and not any(_attempts(spark, f"{path}/{d}") for d in days):
        return None
    found = []
    for day in days:
        if day in known:
            found.append(f"{path}/{day}/{ATTEMPT}{known[day][-1]:06d}")
        else:
            found += [f"{path}/{day}/{n}" for n in commits.names_in(spark, f"{path}/{day}") if n.endswith(".parquet")]
    return found


ATTEMPT = "attempt-"


def _committed(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Committed attempts of each day, in order. The names of the commit files say it all."""
    root, files = files_at(spark, f"{path}/{commits.FOLDER}")
    found: dict[str, list[int]] = {}
    if files.exists(root):
        listed = files.listFiles(root, True)
        while listed.hasNext():
            file = listed.next().getPath()
            if file.getName().endswith(".json"):
                found.setdefault(file.getParent().getName(), []).append(int(file.getName().removesuffix(".json")))
    return {day: sorted(numbers) for day, numbers in found.items()}


def _attempts(spark: SparkSession, day: str) -> list[int]:
    return [int(n.removeprefix(ATTEMPT)) for n in commits.names_in(spark, day) if n.startswith(ATTEMPT)]


def unreadable_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(path, bytes, reason) of the table's files that a skipping read leaves out.

    Names come from a listing that reads no content. Of files that gave no rows tasks read the footers: what is damaged
    fails there, an empty file does not. Tasks open files by Arrow's own file systems.
    """

    def run(batches):
        import pyarrow.parquet as parquet
        from pyarrow import fs

        for batch in batches:
            kept, reasons = [], []
            for at, file in enumerate(batch.column("path").to_pylist()):
                try:
                    files, name = fs.FileSystem.from_uri(file)
                    with files.open_input_file(name) as source:
                        parquet.read_metadata(source)
                except Exception as error:  # whatever a damaged file makes its reader say
                    kept.append(at)
                    reasons.append(f"{type(error).__name__}: {str(error)[:500]}")
            taken = batch.take(pa.array(kept, pa.int64()))
            yield pa.record_batch([*taken.columns, pa.array(reasons, pa.string())], ["path", "bytes", "reason"])

    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    listed = listing.load(live_folders(spark, path) or path)
    files = listed.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    read = read_table(spark, path, schema, skip_unreadable=True).select(F.col("_metadata.file_path").alias("path")).distinct()
    silent = files.join(read, "path", "left_anti")
    return silent.mapInArrow(run, "path string, bytes long, reason string")


# -- scans that prune partitions ---------------------------------------------


def trailing_days(df: DataFrame, ds: str, days: int, partition: str = PARTITION) -> DataFrame:
    """The last ``days`` partitions up to ``ds``; absent days are simply not there."""
    last = F.lit(ds).cast("date")
    return df.filter((F.col(partition) > F.date_sub(last, days)) & (F.col(partition) <= last))


def listed_days(df: DataFrame, days: list[str], partition: str = PARTITION) -> DataFrame:
    return df.filter(F.col(partition).isin(*[F.lit(d).cast("date") for d in days]))


def newest_rows(
    df: DataFrame, run: str, order: list[Column | str], runs: int | None = None, rows: int | None = None
) -> DataFrame:
    """The newest ``rows`` rows out of the newest ``runs`` partitions; a limit not given does not apply."""
    if runs is not None:
        latest = df.select(run).distinct().orderBy(F.col(run).desc()).limit(runs)
        df = df.join(latest, run, "left_semi")
    return df if rows is None else df.orderBy(*order).limit(rows)


def latest_run(df: DataFrame, run: str) -> DataFrame:
    return df.filter(F.col(run) == df.agg(F.max(run)).scalar())


# -- writes -------------------------------------------------------------------


def write_days(df: DataFrame, path: str) -> None:
    """Replace the partitions that ``df`` holds and leave all others alone.

    The rebalance gathers the rows of a small day into one file and splits a
    large day over several tasks.
    """
    (
        df.hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def write_day(df: DataFrame, path: str, ds: str) -> None:
    write_days(df.withColumn(PARTITION, F.lit(ds).cast("date")), path)


def day_exists(spark: SparkSession, path: str, ds: str) -> bool:
    day = f"{PARTITION}={ds}"
    plain = any(n.endswith(".parquet") for n in commits.names_in(spark, f"{path}/{day}"))
    return plain or path_exists(spark, f"{path}/{commits.FOLDER}/{day}")


def delete_path(spark: SparkSession, path: str) -> None:
    target, files = files_at(spark, path)
    files.delete(target, True)


def publish_day(df: DataFrame | None, path: str, ds: str, min_rows: int = 0, today: str | None = None) -> str:
    """Write a partition unless a rule says otherwise; the answer tells which one.

    ``no_input``: nothing upstream. ``history``: a current snapshot never stands
    in for a past day. ``kept``: too few rows, the partition of an earlier run
    stays. Too few rows on the first run are an error. The plan runs once: rows go to an attempt of their own in the day's
    folder and are counted there. One small commit file makes readers take it; nothing is moved, and what was there stays until
    then, and one attempt longer, for readers that have begun. A job that breaks off leaves an attempt that nobody reads.
    """
    if today is not None and ds != today:
        return "history"
    if df is None:
        return "no_input"
    spark, day = df.sparkSession, f"{PARTITION}={ds}"
    number = max([0, *_attempts(spark, f"{path}/{day}"), *_committed(spark, path).get(day, [])]) + 1
    attempt = f"{path}/{day}/{ATTEMPT}{number:06d}"
    df.hint("rebalance").write.parquet(attempt)
    # Read off the files' footers.
    rows = spark.read.schema(df.schema).parquet(attempt).count()
    if not rows or rows < min_rows:
        delete_path(spark, attempt)
        if not rows:
            return "no_input"
        if day_exists(spark, path, ds):
            return "kept"
        raise ValueError(f"{rows} rows are fewer than {min_rows}")
    if not commits.put_new(spark, f"{path}/{commits.FOLDER}/{day}/{number:06d}.json", {"rows": rows}):
        raise RuntimeError(f"another job has published {day} of {path}")
    drop_attempts(spark, path, day)
    return "written"


def drop_attempts(spark: SparkSession, path: str, day: str, keep: int = 2) -> None:
    """Remove a day's attempts but the last committed ones, and files of the day that lie beside attempts."""
    committed = _committed(spark, path).get(day, [])
    kept = set(committed[-keep:])
    for n in committed[:-keep]:
        delete_path(spark, f"{path}/{commits.FOLDER}/{day}/{n:06d}.json")
    for n in _attempts(spark, f"{path}/{day}"):
        # An attempt after the last commit may be under way.
        if n not in kept and n < committed[-1]:
            delete_path(spark, f"{path}/{day}/{ATTEMPT}{n:06d}")
    if len(committed) > 1:
        for name in commits.names_in(spark, f"{path}/{day}"):
            if name.endswith(".parquet"):
                delete_path(spark, f"{path}/{day}/{name}")


# -- caches that are read and replaced by one job --------------------------------


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write the next version of a cache beside the one being read.

    A version that an earlier, failed run left incomplete is replaced.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written completely, oldest first."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(root)]
    found = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return sorted(v for v in found if path_exists(spark, f"{path}/version={v}/_SUCCESS"))


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest versions; the one before may still be read."""
    for version in versions(spark, path)[:-keep]:
        delete_path(spark, f"{path}/version={version}")


def read_cache(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, int]:
    """The newest complete version and its number; empty and 0 before the first."""
    known = versions(spark, path)
    if not known:
        return schemas.empty(spark, schema), 0
    return spark.read.schema(schema).parquet(f"{path}/version={known[-1]}"), known[-1]


# -- documents ----------------------------------------------------------------


def json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON text; fields without a value are kept as null."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def run_manifest(
    job: str,
    ds: str,
    generated_at: str,
    domains: DataFrame,
    new_pairs: DataFrame,
    daily: DataFrame,
    cache: DataFrame,
    provider: str,
) -> DataFrame:
    """One row of counts about a lookup run, under the names its readers know."""
    counts = {"total_domains": domains, "new_pairs_resolved": new_pairs, "daily_rows": daily, "cache_size": cache}
    return domains.sparkSession.range(1).select(
        F.lit(job).alias("dag_id"),
        F.lit(ds).alias("ds"),
        F.lit(generated_at).alias("generated_at"),
        *[table.agg(F.count("*")).scalar().alias(name) for name, table in counts.items()],
        F.lit(provider).alias("geo_provider"),
        F.lit(0).cast("bigint").alias("errors"),
    )
