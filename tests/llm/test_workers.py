"""Every operator with workers that cannot import this package."""

import os
import pathlib
import subprocess
import sys

REPO = pathlib.Path(__file__).parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import functions as F
from indicatrix.session import build_session

spark = build_session("workers", "local[4]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.checkpoint.dir": {folder!r}}})
spark.sparkContext.setLogLevel("ERROR")


def there(batches):
    import importlib.util

    import pyarrow as pa

    for _ in batches:
        yield pa.record_batch([pa.array([importlib.util.find_spec("indicatrix") is not None])], ["there"])


assert [r[0] for r in spark.range(1).mapInArrow(there, "there boolean").collect()] == [False]
for name in ("documents", "benchmark", "labels", "conversations", "embeddings"):
    rows = spark.read.parquet({tables!r} + "/" + name + ".parquet")
    rows.limit(60).coalesce(1).write.parquet({folder!r} + "/in/" + name + ".parquet")
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, query(spark, {folder!r} + "/in").count(), flush=True)
"""


def test_operators_without_the_package_on_workers(tmp_path):
    script = SCRIPT.format(repo=str(REPO), folder=str(tmp_path / "shared"), tables="/root/testdata/sf0.001")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    # Workers look into the folder the driver was started in, so that is another one.
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len([line for line in done.stdout.splitlines() if line.startswith(("op", "pipeline"))]) == 14
