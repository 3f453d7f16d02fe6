"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here relies on. Skewed joins are split by AQE,
# also where the split costs one more shuffle further down the plan.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows may be large: a batch for Python ends at whichever limit comes first. It is held several times over, in the
    # executor and in its workers.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Spark keeps the list of files of every folder that was read, up to 250 MB of the driver, also of folders long deleted.
    # Jobs here read many folders that they wrote themselves, each once or twice.
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    # Stream state on local disk, its changes in the checkpoint, some batches kept for a restart.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.maintenanceInterval": "60s",
    "spark.sql.streaming.minBatchesToRetain": "10",
}

_local_scratch: dict[str, str] = {}
# Folders handed out while a job that removes them runs, the innermost job last.
_handed_out: list[list[str]] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(name: str = "indicatrix", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, for tables and stream checkpoints.

    The folder must be one that all executors share. Only a local-mode session
    that names none gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="indicatrix-")
        base = _local_scratch[app]
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _handed_out:
        _handed_out[-1].append(path)
    return path


def removes_scratch(job: Callable) -> Callable:
    """A job, ``job(spark, ...)``, whose scratch folders go when it ends. What it returns must not read them."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        _handed_out.append([])
        try:
            return job(spark, *args, **kwargs)
        finally:
            for path in _handed_out.pop():
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    return run


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table once to the shared folder and read it back.

    For results that several later steps read: it cuts the lineage, survives the
    loss of executors and gives the optimizer real sizes.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
