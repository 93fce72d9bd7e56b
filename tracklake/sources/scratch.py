"""A folder for files that one query writes and reads again."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _own() -> str:
    """A folder of this process, removed at its end."""
    path = tempfile.mkdtemp(prefix="tracklake-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``, which driver and executors share.

    Where that is unset and Spark is one process, a temporary folder that goes
    with it; on a cluster without the setting this is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not shared and master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(shared or _own()).rstrip('/')}/tracklake/{uuid.uuid4().hex}/{name}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what queries have written to the shared folder; results that still read it fail."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x")).getParent().getParent()
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
