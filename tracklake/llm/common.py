"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch.  Texts may be long, so batches are kept
#: short: this bounds what a Python worker holds at one time.
ARROW_ROWS, ARROW_BYTES = 512, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table, with Arrow batches sized for whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``.  Where that is unset and
    Spark runs in one process, as in tests, a folder of our own is taken and
    removed at exit; on a cluster without the setting this is an error, as
    no machine's own folder would do.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tracklake-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


#: Folders that ``materialize`` has written, in order.
written: list[str] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The files outlive executors, so a lost one costs only its running tasks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tracklake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders that ``materialize`` has written; results that still read them fail."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard_materialized(spark: SparkSession) -> None:
    """Remove what ``materialize`` has written for this session's folder; results that still read it fail."""
    discard(spark, [f"{shared_dir(spark).rstrip('/')}/tracklake"])
    written.clear()


def column(name: str) -> Column:
    """The column of that very name, which may hold dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed by place to c0, c1, ..., and the new names of ``names``.

    Whole rows can then pass through an operator: no name of the input, however
    odd, meets one of the operator's.
    """
    return df.toDF(*(f"c{k}" for k in range(len(df.columns)))), [f"c{df.columns.index(n)}" for n in names]


def spread(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose hot keys adaptive execution may split.

    Spark splits a skewed partition only where both sides are shuffled for the
    join itself.  When ``right`` comes from an aggregation over the same keys it
    would be joined where it lies and a hot key would stay in one task; with
    the hash as one more key both sides are dealt anew.
    """
    key = F.xxhash64(*on)
    return left.withColumn("_k", key).join(right.withColumn("_k", key), ["_k", *on], how).drop("_k")


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each row of a string column; null gives no bytes."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
