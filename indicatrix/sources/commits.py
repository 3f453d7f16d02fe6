"""Numbered commit files: small JSON documents that appear whole or not at all, and are never changed.

A table whose folders are named by a commit is switched by one rename. What a broken job left behind is named by none.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_commits"


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()


def files_at(spark: SparkSession, path: str):
    """Hadoop's path and file system of a path."""
    jvm, conf = _jvm(spark)
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(conf)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    target, files = files_at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def put_new(spark: SparkSession, path: str, document: dict) -> bool:
    """Write a document under a name that nobody has taken; False if somebody has.

    The text goes to a name of its own first, so a reader never sees a part of it.
    """
    jvm, conf = _jvm(spark)
    draft, files = files_at(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(path)
    files.mkdirs(target.getParent())
    out = files.create(draft, True)
    try:
        out.write(bytearray(json.dumps(document).encode()))
    finally:
        out.close()
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(draft, target, options)
        return True
    except Exception:
        if files.exists(target):
            return False
        raise
    finally:
        files.delete(draft, False)


def get(spark: SparkSession, path: str) -> dict | None:
    """The document of a name, or None."""
    target, files = files_at(spark, path)
    if not files.exists(target):
        return None
    source = files.open(target)
    try:
        return json.loads(bytes(source.readAllBytes()).decode())
    finally:
        source.close()


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits of a table, in order."""
    names = names_in(spark, f"{path}/{FOLDER}")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest commit and its number; 0 and an empty one before the first."""
    known = numbers(spark, path)
    return (known[-1], get(spark, _name(path, known[-1]))) if known else (0, {})


def _name(path: str, number: int) -> str:
    return f"{path}/{FOLDER}/{number:012d}.json"


def commit(spark: SparkSession, path: str, number: int, document: dict) -> None:
    """Make ``document`` the commit of a number. Of two jobs that began with the same state, one fails."""
    if not put_new(spark, _name(path, number), document):
        raise RuntimeError(f"another job has committed {number} to {path}")


def drop_before(spark: SparkSession, path: str, number: int) -> None:
    """Forget commits below a number."""
    for old in numbers(spark, path):
        if old < number:
            target, files = files_at(spark, _name(path, old))
            files.delete(target, False)
