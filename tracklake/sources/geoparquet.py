"""Writing Parquet whose files say which column is a geometry, as readers of maps ask for.

    spark.dataSource.register(GeoParquet)
    with_line(track).write.format("geoparquet").mode("append").save("/out/track.parquet")

Each task writes one file into a folder of the job, with the ``geo`` key and the
box of its lines; the driver puts the files in place when all tasks are done,
or removes the folder.  So a task that fails or runs twice leaves no file; of a
task that is killed while the folder goes, a folder may be left whose name
begins with an underscore, which readers pass over.
The folder must be one that driver and executors share (a path or a URI that
pyarrow knows).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tracklake.sources.writers import LINE

VERSION, ENCODING = "1.1.0", "WKB"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def lines_box(lines: pa.Array) -> np.ndarray | None:
    """West, south, east and north of lines of two points; None without any."""
    found = lines.drop_null()
    if not len(found):
        return None
    xy = np.frombuffer(b"".join(found.to_pylist()), LINE)["xy"].reshape(-1, 2)
    return np.concatenate([xy.min(axis=0), xy.max(axis=0)])


def geo_key(column: str, box: np.ndarray | None) -> bytes:
    """The file's metadata: one column of lines, in degrees of longitude and latitude."""
    told = {"encoding": ENCODING, "geometry_types": ["LineString"]} | ({} if box is None else {"bbox": box.tolist()})
    return json.dumps({"version": VERSION, "primary_column": column, "columns": {column: told}}).encode()


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, column: str, overwrite: bool) -> None:
        self.path, self.column, self.overwrite, self.job = path.rstrip("/"), column, overwrite, uuid.uuid4().hex

    @property
    def aside(self) -> str:
        return f"{store(self.path)[1]}/_temporary-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, _ = store(self.path)
        name, rows, box, writer = f"part-{uuid.uuid4().hex}.parquet", 0, None, None
        files.create_dir(self.aside)
        for batch in iterator:
            if writer is None:
                writer = pq.ParquetWriter(f"{self.aside}/{name}", batch.schema, filesystem=files)
            writer.write_batch(batch)
            rows += batch.num_rows
            if (b := lines_box(batch.column(self.column))) is not None:
                box = b if box is None else np.concatenate([np.minimum(box[:2], b[:2]), np.maximum(box[2:], b[2:])])
        if writer is not None:
            writer.add_key_value_metadata({b"geo": geo_key(self.column, box)})
            writer.close()
        return Written(name if writer is not None else "", rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, path = store(self.path)
        old = [f.path for f in files.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.is_file] if self.overwrite else []
        for m in messages:
            if m is not None and m.file:
                files.move(f"{self.aside}/{m.file}", f"{path}/{m.file}")
        for f in old:
            files.delete_file(f)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, _ = store(self.path)
        if files.get_file_info(self.aside).type != fs.FileType.NotFound:
            files.delete_dir(self.aside)


class GeoParquet(DataSource):
    """Options: ``path``, and ``geometry``, the name of the column of lines (``geometry``)."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        column = self.options.get("geometry", "geometry")
        if column not in schema.names:
            raise ValueError(f"there is no column {column}")
        return _Writer(self.options["path"], column, overwrite)
