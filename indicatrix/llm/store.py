"""Intermediate tables that release what made them."""

from __future__ import annotations

import gc

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from indicatrix.session import materialise


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder, read back, and let Spark's cleaner delete shuffle files that nothing refers to any more.

    The cleaner waits for a collection of the driver's garbage, which a quiet driver may not do for half an hour.
    """
    out = materialise(df, name)
    release(df)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(df: DataFrame) -> None:
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def sent(spark: SparkSession, value):
    """A broadcast of any value, to be read with ``pickle.loads``. It holds classes of this package by value, so workers need not have it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))
