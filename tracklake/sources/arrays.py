"""A data source for files of dense arrays, one partition for each file.

    spark.dataSource.register(ArraySource)
    spark.read.format("arrays").option("stream", "peak").load("/runs")

On a cluster, ``read_arrays`` reads them from any store that Spark reads.
``stream`` is ``peak`` (file, row, offset_s, counts) or ``control`` (file, row,
counts).  HDF5 needs the optional library h5py; NumPy archives (.npz) with the
same array names are read without it.
"""

from __future__ import annotations

import glob
import io
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tracklake.functions.clock import name_time
from tracklake.functions.numbers import fitted_array, scaled_array
from tracklake.operators.small import small

#: Paths of the arrays in a file (fixed values), and counts per second in a count.
PEAKS, TIMES, CONTROLS = "/PeakData/PeakData", "/TimingData/BufTimes", "/TPS2/TwData"
FREQUENCY = 24_990.0


#: Rows in an Arrow batch.
BATCH_ROWS = 4096
SCHEMA = "file string, row bigint, offset_s double, counts array<double>"


def read_array(path: str, name: str, content: bytes | None = None) -> np.ndarray:
    """An array of a file, or of a file's content, flattened to rows of its last dimension."""
    source = path if content is None else io.BytesIO(content)
    if path.endswith(".npz"):
        with np.load(source) as f:
            a = f[name.strip("/").replace("/", "_")]
    else:
        import h5py

        with h5py.File(source) as f:
            a = f[name][...]
    return a.reshape(-1, a.shape[-1]) if a.ndim > 1 else a


def array_batches(path: str, stream: str, content: bytes | None = None) -> Iterator[pa.RecordBatch]:
    """A file's rows as Arrow batches, cut from its arrays without a step for each number."""
    if stream == "control":
        counts, offsets = read_array(path, CONTROLS, content), None
    else:
        counts, offsets = read_array(path, PEAKS, content), read_array(path, TIMES, content).reshape(-1).astype("f8")
    counts = counts.reshape(len(counts), -1)
    size, width = len(counts) if offsets is None else len(offsets), counts.shape[1]
    for a in range(0, size, BATCH_ROWS):
        n = min(BATCH_ROWS, size - a)
        part = np.ascontiguousarray(counts[a : a + n], "f8")  # counts follow the times: cut or padded with nothing
        ends = np.minimum(np.arange(n + 1), len(part)).astype("i4") * width
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(part.reshape(-1)), mask=pa.array(np.arange(n) >= len(part)))
        yield pa.record_batch(
            [pa.array([path] * n, pa.string()), pa.array(np.arange(a, a + n, dtype="i8")), pa.nulls(n, pa.float64()) if offsets is None else pa.array(offsets[a : a + n]), lists],
            names=["file", "row", "offset_s", "counts"],
        )


def read_arrays(spark: SparkSession, folder: str, stream: str = "peak") -> DataFrame:
    """The rows of all array files of a folder, which may lie in any store that Spark reads; a task for each file."""
    if stream not in ("peak", "control"):
        raise ValueError(f"unknown stream {stream!r}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{h5,npz}").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                yield from array_batches(path.as_py(), stream, content.as_py())

    return files.mapInArrow(run, SCHEMA)


class _Reader(DataSourceReader):
    def __init__(self, path: str, stream: str) -> None:
        self.path, self.stream = path, stream

    def partitions(self) -> list[InputPartition]:
        found = [self.path] if os.path.isfile(self.path) else sorted(glob.glob(f"{self.path}/*.h5") + glob.glob(f"{self.path}/*.npz"))
        return [InputPartition(p) for p in found]

    def read(self, partition: InputPartition):
        return array_batches(partition.value, self.stream)


class ArraySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrays"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        stream = self.options.get("stream", "peak")
        if stream not in ("peak", "control"):
            raise ValueError(f"unknown stream {stream!r}")
        return _Reader(self.options["path"], stream)


def peak_names(names: list[str], size: int) -> list[str]:
    """Names for ``size`` columns: cut, or numbered on."""
    return names[:size] + [f"Peak_{i}" for i in range(len(names), size)]


def wide_counts(peaks: DataFrame, controls: DataFrame, names: list[str], size: int, control_columns: list[tuple[int, str]], frequency: float = FREQUENCY) -> DataFrame:
    """Peaks and controls side by side: ``date``, a column for each peak in counts per second, and the controls.

    Rows meet by their position in the order of files and rows, as far as the
    shorter goes.  Positions come from the rows of each file before.
    """

    def placed(df: DataFrame, extra: list) -> DataFrame:
        sizes = df.groupBy("file").agg((F.max("row") + 1).alias("n"))  # one row for each file
        before = sizes.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
        return df.join(small(before), "file").select((F.col("_base") + F.col("row")).alias("_at"), *extra)

    start = name_time("file")
    date = F.timestamp_micros(F.unix_micros(start) + (F.col("offset_s") * 1e6).cast("bigint"))
    fitted = scaled_array(fitted_array("counts", size), frequency)
    left = placed(peaks, [date.alias("date"), fitted.alias("_c")])
    right = placed(controls, [F.get("counts", i).alias(n) for i, n in control_columns])
    cols = [F.get("_c", i).alias(n) for i, n in enumerate(peak_names(names, size))]
    return left.join(right, "_at").select("date", *cols, *(n for _, n in control_columns))
