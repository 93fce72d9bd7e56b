"""Fetching with pauses, and the cache of road segments."""

import http.server
import json
import re
import threading
import urllib.parse

import pytest
from pyspark.sql import functions as F

from tracklake.functions.hexagons import hexagon_cells
from tracklake.sources.maps import RoadCache, fetch

KIND = "type string, id long, lat double, lon double, nodes array<long>, tags map<string,string>"


def test_fetch_tries_again():
    asked, waits = [], []

    def send(server, query, timeout):
        asked.append(server)
        if len(asked) < 4:
            raise TimeoutError("busy")
        return "ok"

    assert fetch("q", ("a", "b"), 2, send=send, sleep=waits.append) == "ok"
    assert asked == ["a", "b", "a", "b"] and len(waits) == 3 and all(1 <= w <= 9 for w in waits)
    with pytest.raises(ConnectionError):
        fetch("q", ("a",), 2, send=lambda *_: (_ for _ in ()).throw(OSError("no")), sleep=lambda _: None)


def test_cache_builds_each_cell_once(spark, tmp_path):
    asked = []

    def elements(cells):
        asked.append(cells)
        nodes = [("node", i, 37.85 + i * 0.001, -122.25, None, None) for i in range(120)]
        ways = [("way", 1, None, None, list(range(120)), {"highway": "residential", "name": "A"})]
        return spark.createDataFrame([*nodes, *ways], KIND)

    cache = RoadCache(spark, str(tmp_path / "cache"), elements=elements)
    south = spark.createDataFrame([(37.86, -122.25), (None, None)], "lat double, lon double")
    first = cache.segments(south)
    assert asked == [[(37.8, -122.3)]] and first.count() > 0
    assert first.filter(F.abs(F.col("center_lat") - 37.86) > 0.01).isEmpty()
    assert cache.segments(south).count() == first.count() and len(asked) == 1
    both = spark.createDataFrame([(37.86, -122.25), (37.92, -122.25)], "lat double, lon double")
    assert cache.segments(both).count() > first.count() and asked[1:] == [[(37.9, -122.3)]]


def test_executors_ask_each_cell_once(spark, tmp_path):
    """A server of this machine that is busy at first: every cell is answered once, and not asked again after a failed build."""
    asked = []

    class Server(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            query = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())["data"][0]
            asked.append(re.search(r"\(([0-9.,-]+)\)", query)[1])
            self.send_response(503 if len(asked) == 1 else 200)
            self.end_headers()
            south, west = (float(x) for x in asked[-1].split(",")[:2])
            nodes = [{"type": "node", "id": round(south * 1000) * 10 + i, "lat": south + 0.01 + i * 0.01, "lon": west + 0.05} for i in range(5)]
            way = {"type": "way", "id": round(south * 10), "nodes": [n["id"] for n in nodes], "tags": {"highway": "residential", "name": "A"}}
            self.wfile.write(json.dumps({"elements": [*nodes, way]}).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    cache = RoadCache(spark, str(tmp_path / "cache"), servers=(f"http://127.0.0.1:{server.server_port}/",), pause_s=0.0)
    track = spark.createDataFrame([(37.85, -122.25), (37.95, -122.25), (38.05, -122.25)], "lat double, lon double")
    cells = [(37.8, -122.3), (37.9, -122.3), (38.0, -122.3)]
    assert cache.answers(cells).count() == 3 and len(asked) == 4  # the first was refused and asked again
    found = cache.segments(track)
    assert len(asked) == 4 and found.count() > 300 and cache.segments(track).count() == found.count()
    assert {r.cell_lat for r in cache.stored().select("cell_lat").distinct().collect()} == {37.8, 37.9, 38.0}
    assert not (tmp_path / "cache/_answers").exists()
    server.shutdown()


def test_hexagons_need_their_library():
    try:
        import h3  # noqa: F401
    except ImportError:
        assert hexagon_cells(12) is None


def test_a_box_meets_few_row_groups(spark, tmp_path):
    """Of a drive laid out along the curve a box meets a few row groups, in the order of time nearly all."""
    import pyarrow.parquet as pq

    from tracklake.sources import readers, writers

    n = 60_000
    track = spark.range(n).select(
        F.col("id").alias("k"), (37.8 + 0.1 * F.abs(F.pmod(F.col("id") / 701.0, F.lit(2.0)) - 1)).alias("lat"), (-122.4 + 0.1 * F.abs(F.pmod(F.col("id") / 997.0, F.lit(2.0)) - 1)).alias("lon")
    ).unionByName(spark.createDataFrame([(-1, None, None), (-2, 37.85, None)], "k long, lat double, lon double"))
    box = (37.82, -122.34, 37.83, -122.33)

    def met(path):
        groups = [f.metadata.row_group(i) for p in path.glob("*.parquet") for f in [pq.ParquetFile(p)] for i in range(f.metadata.num_row_groups)]
        hit = 0
        for g in groups:
            s = [g.column(c).statistics for c in (1, 2)]
            hit += all(x.has_min_max for x in s) and s[0].max > box[0] and s[0].min < box[2] and s[1].max > box[1] and s[1].min < box[3]
        return hit, len(groups)

    writers.write_by_place(track, str(tmp_path / "curve"), files=64)
    track.repartitionByRange(64, "k").sortWithinPartitions("k").write.parquet(str(tmp_path / "time"))
    rows = [sorted(r.k for r in readers.read_box(spark, str(tmp_path / name), *box).collect()) for name in ("curve", "time")]
    assert rows[0] == rows[1] and rows[0] and spark.read.parquet(str(tmp_path / "curve")).count() == n + 2
    (hit, all_), (hit_time, all_time) = met(tmp_path / "curve"), met(tmp_path / "time")
    assert hit * 8 <= all_ and hit_time * 2 >= all_time, (hit, all_, hit_time, all_time)


def test_files_say_which_column_is_a_geometry(spark, tmp_path):
    import json as js

    import pyarrow.parquet as pq

    from tracklake.sources.geoparquet import GeoParquet
    from tracklake.sources.writers import with_line

    spark.dataSource.register(GeoParquet)
    track = spark.range(100).select("id", F.timestamp_seconds("id").alias("datetime"), *((F.lit(v) + F.col("id") / d).alias(c) for c, v, d in (("seg_start_lon", -122.0, 100.0), ("seg_start_lat", 37.0, 50.0), ("seg_end_lon", -121.0, 100.0))), F.when(F.col("id") != 7, 40.0).alias("seg_end_lat"))
    path = tmp_path / "track.parquet"
    for n in (1, 2):
        with_line(track).repartition(3).write.format("geoparquet").mode("append").save(str(path))
        assert len(list(path.iterdir())) == 3 * n
    with_line(track).repartition(4).write.format("geoparquet").mode("overwrite").save(str(path))
    files = list(path.iterdir())
    assert len(files) == 4 and spark.read.parquet(str(path)).filter("length(geometry) = 41").count() == 99
    boxes = []
    for f in files:
        geo = js.loads(pq.ParquetFile(f).metadata.metadata[b"geo"])
        assert geo["primary_column"] == "geometry" and geo["columns"]["geometry"]["encoding"] == "WKB"
        boxes.append(geo["columns"]["geometry"]["bbox"])
    assert [min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)] == pytest.approx([-122.0, 37.0, -120.01, 40.0])
    bad = with_line(track).repartition(3).withColumn("id", F.when(F.col("id") == 50, F.raise_error("no")).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("geoparquet").mode("append").save(str(path))
    assert sorted(f for f in path.iterdir() if f.name[0] != "_") == sorted(files) and spark.read.parquet(str(path)).count() == 100
    with pytest.raises(Exception, match="no column"):
        track.write.format("geoparquet").mode("append").save(str(path))
