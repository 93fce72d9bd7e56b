"""Writers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions.geo import curve_key
from tracklake.sources.readers import cps_long

#: A line of two points in well-known binary: byte order, kind, number of points, the points.
LINE = np.dtype([("order", "u1"), ("kind", "<u4"), ("points", "<u4"), ("xy", "<f8", 4)])
_ENDS = ("seg_start_lon", "seg_start_lat", "seg_end_lon", "seg_end_lat")


def packed_lines(ends: list[pa.Array]) -> pa.Array:
    """Lines from arrays of longitudes and latitudes; null where any of them is."""
    here = ends[0].is_valid().to_numpy(zero_copy_only=False)
    for e in ends[1:]:
        here = here & e.is_valid().to_numpy(zero_copy_only=False)
    lines = np.zeros(len(here), LINE)
    lines["order"], lines["kind"], lines["points"] = 1, 2, 2
    for k, e in enumerate(ends):
        lines["xy"][:, k] = e.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bits = pa.py_buffer(np.packbits(here, bitorder="little").tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(LINE.itemsize), len(here), [bits, pa.py_buffer(lines.tobytes())]).cast(pa.binary())


def with_line(track: DataFrame, name: str = "geometry") -> DataFrame:
    """Add each row's segment as a line in well-known binary; null without a segment."""
    names = [*track.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns, packed_lines([batch.column(c) for c in _ENDS])], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in track.schema.fields)
    return track.mapInArrow(run, f"{fields}, {name} binary")


def write_track(track: DataFrame, path: str, by: list[str] | None = None, lines: bool = True) -> None:
    """A track as Parquet with lines, or as CSV if the path says so."""
    if path.endswith(".csv"):
        track.write.mode("overwrite").csv(path, header=True)
    else:
        write_table(with_line(track) if lines else track, path, by)


def write_table(df: DataFrame, path: str, by: list[str] | None = None, **options: str) -> None:
    """Parquet, in folders by the columns ``by``; rewritten folders replace theirs alone."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_by_place(df: DataFrame, path: str, lat: str = "lat", lon: str = "lon", files: int | None = None, group_bytes: int | None = None) -> None:
    """Parquet whose files and row groups each hold one stretch of a curve through all places.

    A box then meets few of them, which Spark sees from their least and greatest
    latitudes and longitudes; in the order of time nearly every one holds a bit
    of any box.  Rows are range-partitioned by the curve's key and sorted by it;
    rows without a position come first.  ``group_bytes`` bounds a row group.
    """
    key = curve_key(F.col(lat), F.col(lon))
    keyed = df.withColumn("_key", key)
    dealt = (keyed.repartitionByRange(files, "_key") if files else keyed.repartitionByRange("_key")).sortWithinPartitions("_key").drop("_key")
    writer = dealt.write.mode("overwrite")
    (writer.option("parquet.block.size", group_bytes) if group_bytes else writer).parquet(path)


def write_cps(cps: DataFrame, path: str) -> None:
    write_table(cps, path)


def write_cps_long(cps: DataFrame, path: str) -> None:
    write_table(cps_long(cps), path)


def write_stats(df: DataFrame, path: str) -> None:
    """A small table of statistics as one CSV file with a header, also when it has no rows."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_if_any(df: DataFrame, path: str, by: list[str] | None = None) -> bool:
    """Write only if there are rows; says whether there were."""
    if df.isEmpty():
        return False
    write_table(df, path, by)
    return True


#: Files that a task writes side by side.
OPEN = 64
#: Whole numbers that differ little from one to the next take few bytes as differences, which the second version of the format has.
SMALL_STEPS = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0", **{f"parquet.enable.dictionary#{c}_e10.list.element": "false" for c in ("lat", "lon")}}


def write_cells(segments: DataFrame, path: str) -> None:
    """Cached road segments, or chains of them, in folders by cell and segment length.

    A task writes the files of its first ``OPEN`` cells side by side, so that
    rows need no order; only those of further cells are sorted.
    """
    conf, name = segments.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN)
    try:
        write_table(segments, path, ["cell_lat", "cell_lon", "length_seg"], **(SMALL_STEPS if "lat_e10" in segments.columns else {}))
    finally:
        conf.set(name, before)
