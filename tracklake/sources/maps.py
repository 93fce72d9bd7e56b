"""Map elements: fetching them from map servers, and the cache of road segments by cell."""

from __future__ import annotations

import random
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.operators import roads
from tracklake.sources import readers, writers

#: Public servers of the map query language.
SERVERS = ("https://overpass-api.de/api/interpreter",)


#: What the cells' files hold: chains of segments, or segments (files of earlier versions).
STORED = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("road_name", "highway")), T.StructField("oneway", T.BooleanType()), T.StructField("service", T.StringType()),
    *roads.SEGMENT.fields, *(f for f in roads.CHAIN.fields if f.name not in roads.SEGMENT.names),
    T.StructField("date", T.DateType()), *(T.StructField(c, T.DoubleType()) for c in ("cell_lat", "cell_lon")), T.StructField("length_seg", T.IntegerType()),
])


def post(server: str, query: str, timeout_s: float) -> str:
    data = urllib.parse.urlencode({"data": query}).encode()
    with urllib.request.urlopen(server, data, timeout=timeout_s) as answer:
        return answer.read().decode()


def fetch(query: str, servers: tuple[str, ...] = SERVERS, tries: int = 2, timeout_s: float = 120.0, most_wait_s: float = 8.0,
          send: Callable[[str, str, float], str] = post, sleep: Callable[[float], None] = time.sleep) -> str:
    """The answer to a map query: each server is tried in turn, with growing, jittered pauses."""
    wait, last = 1.0, None
    for _ in range(tries):
        for server in servers:
            try:
                return send(server, query, timeout_s)
            except OSError as why:
                last = why
                sleep(min(most_wait_s, wait) + random.random())
                wait *= 2
    raise ConnectionError(f"no map server answered: {last}")


@dataclass
class RoadCache:
    """Road segments in folders by cell (lower edges) and segment length.

    ``elements`` gives the map elements of a list of cells; by default they are
    fetched, one request for each cell.  Files hold chains of segments
    (``roads.CHAIN``), an eighth of the bytes of their segments.  Only cells that a track touches and the
    cache lacks are built, each from the roads that pass it and clipped to it,
    so a cell's folder is the same whatever was built with it or before it.
    """

    spark: SparkSession
    path: str
    length_m: float = 30.0
    size: float = 0.1
    buffer_m: float = 200.0
    elements: Callable[[list[tuple[float, float]]], DataFrame] | None = None
    #: Build every cell anew, whatever the cache holds.
    fresh: bool = False
    servers: tuple[str, ...] = SERVERS
    #: Requests at a time, and seconds between those of one task.
    at_once: int = 2
    pause_s: float = 0.5

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def answers(self, cells: list[tuple[float, float]]) -> DataFrame:
        """The servers' answers for cells, one row each: cell_lat, cell_lon, answer.

        Executors ask, ``at_once`` of them at a time, each with pauses between
        its cells.  Answers are written beside the cache before anything is made
        of them, so a build that fails, or a task that is tried again after its
        output was committed, asks no cell twice.
        """
        folder, kind = f"{self.path}/_answers", "cell_lat double, cell_lon double, answer string"
        fs, path = self._path(folder)
        have = self.spark.read.schema(kind).parquet(folder) if fs.exists(path) else self.spark.createDataFrame([], kind)
        known = {(r.cell_lat, r.cell_lon) for r in have.select("cell_lat", "cell_lon").collect()}  # cells of a drive
        ask = [(a, b, roads.map_query(a, b, a + self.size, b + self.size)) for a, b in cells if (a, b) not in known]
        servers, pause_s = self.servers, self.pause_s

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lat, lon, query in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    answer = fetch(query, servers)
                    time.sleep(pause_s)
                    yield pa.RecordBatch.from_pylist([{"cell_lat": lat, "cell_lon": lon, "answer": answer}])

        if ask:
            dealt = self.spark.createDataFrame(ask, "cell_lat double, cell_lon double, query string").repartition(min(self.at_once, len(ask)))
            dealt.mapInArrow(run, kind).write.mode("append").parquet(folder)
        return self.spark.read.schema(kind).parquet(folder).filter(F.struct("cell_lat", "cell_lon").isin([F.struct(F.lit(a), F.lit(b)) for a, b in cells]))

    def fetched(self, cells: list[tuple[float, float]]) -> DataFrame:
        rows = self.answers(cells).select(F.explode(F.from_json("answer", readers.ELEMENTS)["elements"]).alias("e"))
        return rows.select("e.*").dropDuplicates(["type", "id"])

    def stored(self) -> DataFrame | None:
        fs, path = self._path(self.path)
        if not fs.exists(path) or not any(s.getPath().getName().startswith("cell_lat=") for s in fs.listStatus(path)):
            return None
        return roads.unchained(self.spark.read.schema(STORED).parquet(self.path).filter(F.col("length_seg") == int(self.length_m)))

    def segments(self, track: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """Segments near a track, from the cache, after what is missing was built."""
        needed = roads.cells_of(track, self.size, lat, lon)
        have = None if self.fresh else self.stored()
        missing = roads.missing_cells(needed, have.select("cell_lat", "cell_lon").distinct()) if have is not None else needed
        cells = sorted((r.cell_lat, r.cell_lon) for r in missing.collect())  # cells of a drive
        if cells:
            wanted = self.spark.createDataFrame(cells, "cell_lat double, cell_lon double")
            found = roads.build_cells((self.elements or self.fetched)(cells), self.length_m, self.size, only=wanted, chained=True)
            placed = found.withColumnsRenamed({"rd_name": "road_name", "rd_type": "highway"}).withColumns({"length_seg": F.lit(int(self.length_m)), "date": F.current_date()})
            writers.write_cells(placed if len(cells) <= writers.OPEN else placed.hint("rebalance", "cell_lat", "cell_lon"), self.path)
            have = self.stored()
            fs, path = self._path(f"{self.path}/_answers")
            fs.delete(path, True)  # they are in the cells now
        near = have.join(needed, ["cell_lat", "cell_lon"], "left_semi").drop("segment_id")
        near = near.withColumnsRenamed({"road_name": "rd_name", "highway": "rd_type"})
        return roads.in_box(roads.segment_table(near), track, self.buffer_m, lat, lon)
