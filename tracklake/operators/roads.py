"""Roads: from map elements to short segments, and the cells that are cached."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.geo import DEGREE, bearing, bearings, cell, distances, haversine, line_bearing
from tracklake.functions.numbers import round_even
from tracklake.functions.text import tag
from tracklake.operators import noding
from tracklake.operators.small import small

#: Road classes that are taken from the map (fixed values).
ROAD_CLASSES = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential",
    "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link", "living_street", "service",
)


def map_query(south: float, west: float, north: float, east: float, classes: tuple[str, ...] = ROAD_CLASSES, timeout_s: int = 120) -> str:
    """The query text that a map server answers with the roads in a box."""
    box = f"{south},{west},{north},{east}"
    kinds = "|".join(classes)
    return f'[out:json][timeout:{timeout_s}];(way["highway"~"^({kinds})$"]({box}););(._;>;);out body;'


def parse_roads(elements: DataFrame, classes: tuple[str, ...] = ROAD_CLASSES) -> DataFrame:
    """Roads from map elements (type, id, lat, lon, nodes, tags): one row for each way with two known nodes or more.

    Nodes are joined to the ways' lists and gathered again in order, a way at a
    time; each place keeps its node's id.  A way that is one-way against its
    direction is turned round.
    """
    nodes = elements.filter("type = 'node'").select(F.col("id").alias("node"), "lat", "lon")
    ways = elements.filter("type = 'way'").select(F.col("id").alias("way_id"), "nodes", "tags").filter(tag("tags", "highway").isin(*classes))
    places = ways.select("way_id", F.posexplode("nodes").alias("at", "node")).join(nodes, "node")
    lines = places.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("at", "lat", "lon", "node"))).alias("_p"))
    coords = F.transform("_p", lambda p: F.struct(*(p[c].alias(c) for c in ("lat", "lon", "node"))))
    text = tag("tags", "oneway", "no")
    back = text == "-1"
    roads = ways.join(lines, "way_id").filter(F.size("_p") >= 2).select(
        "way_id", tag("tags", "highway").alias("rd_type"), tag("tags", "name").alias("rd_name"), tag("tags", "service").alias("service"),
        text.isin("yes", "true", "1", "-1").alias("oneway"), F.when(back, F.reverse(coords)).otherwise(coords).alias("coords"),
    )
    return roads.withColumn("rd_deg", line_bearing(F.col("coords")))


def cluster_directions(roads: DataFrame, threshold: float = 90.0, by: tuple[str, ...] = ("rd_name",), counted: Column | None = None) -> DataFrame:
    """Two clusters of direction within a name of which any way is one-way and the first class is not ``service``; else -1.

    A way joins cluster 1 if it lies more than half the threshold off the
    name's arithmetic mean.  ``by`` are the columns that make a name (also of a
    cell); rows whose ``rd_name`` is null are no group, unless other columns bound
    it.  ``counted`` tells rows that stand for a way, where it has several.
    Names are summed up and joined back, so a name of a whole country is no
    task of its own.
    """
    bounded = set(by) != {"rd_name"}
    named = roads if bounded else roads.filter("rd_name IS NOT NULL")
    sums = named.filter(counted) if counted is not None else named
    stats = sums.groupBy(*by).agg(F.min_by("rd_type", "way_id").alias("_first"), F.max("oneway").alias("_any"), F.avg("rd_deg").alias("_mean"))
    stats = stats.withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.coalesce(F.col(c).cast("string"), F.lit("")) == F.coalesce(F.col(f"_{c}").cast("string"), F.lit("")) for c in by]
    same += [F.col("rd_name").isNull() == F.col("_rd_name").isNull()] if bounded else []
    off = F.abs(F.pmod(F.col("rd_deg") - F.col("_mean") + 180.0, F.lit(360.0)) - 180.0)
    split = F.col("_any") & (F.col("_first") != "service")
    grouped = named.join(stats, same).withColumn("cluster", F.when(split, (off > threshold / 2).cast("int")).otherwise(F.lit(-1))).drop("_first", "_any", "_mean", *(f"_{c}" for c in by))
    if bounded:
        return grouped
    return grouped.unionByName(roads.filter("rd_name IS NULL").withColumn("cluster", F.lit(-1)))


def split_at_crossings(roads: DataFrame, elements: DataFrame | None = None) -> DataFrame:
    """Ways cut at nodes that they share with other ways or with themselves; repeats in a group are dissolved.

    Nodes are those that ``coords`` carry, so turned ways and unknown nodes do
    not move cuts; ``elements`` is not needed.  A group is one class, name,
    ``oneway``, cluster (where there is one) and ``service``; null is a value.
    Of its pieces with the same nodes, in either direction, the first by way and
    place stays.  It stands for the union of a geometry library: lines that
    cross without a shared node stay whole, and ways of other groups cut too.
    """
    group = [c for c in ("rd_type", "rd_name", "oneway", "cluster", "service") if c in roads.columns]
    keyed = roads.withColumn("_g", F.to_json(F.struct(*group)))
    nodes = roads.select("way_id", F.posexplode("coords.node").alias("at", "node"))
    shared = nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select("node")
    cuts = nodes.join(shared, "node").groupBy("way_id").agg(F.collect_set("at").alias("_cuts"))
    last = F.size("coords") - 1
    joined = keyed.join(cuts, "way_id", "left")
    inner = F.filter(F.coalesce("_cuts", F.array().cast("array<int>")), lambda c: (c > 0) & (c < last))
    marks = F.array_sort(F.array_union(inner, F.array(F.lit(0), last)))
    pieces = F.transform(F.sequence(F.lit(1), F.size("_m") - 1), lambda k: F.slice("coords", F.get("_m", k - 1) + 1, F.get("_m", k) - F.get("_m", k - 1) + 1))
    cut = joined.withColumn("_m", marks).select(*joined.columns, F.posexplode(pieces).alias("_at", "_piece")).drop("coords").withColumnRenamed("_piece", "coords")
    same = Window.partitionBy("_g", F.least("coords.node", F.reverse("coords.node"))).orderBy("way_id", "_at")
    cut = cut.withColumn("_n", F.row_number().over(same)).filter("_n = 1").select(*roads.columns)
    return cut.withColumn("rd_deg", line_bearing(F.col("coords")))


def _steps(coords: Column) -> Column:
    """Distances along a line: an array of (d, lat, lon), d from the start to each vertex."""
    zero = F.struct(F.lit(0.0).alias("d"), F.get(coords, 0)["lat"].alias("lat"), F.get(coords, 0)["lon"].alias("lon"))

    def step(done: Column, p: Column) -> Column:
        prev = F.element_at(done, -1)
        d = prev["d"] + haversine(prev["lat"], prev["lon"], p["lat"], p["lon"])
        return F.concat(done, F.array(F.struct(d.alias("d"), p["lat"].alias("lat"), p["lon"].alias("lon"))))

    return F.aggregate(F.slice(coords, F.lit(2), F.greatest(F.size(coords) - 1, F.lit(0))), F.array(zero), step)


def _place(steps: Column, d: Column) -> Column:
    """The number of the vertex before the point at a distance along a line."""
    return F.greatest(F.lit(1), F.least(F.size(F.filter(steps, lambda s: s["d"] < d)), F.size(steps) - 1))


def _point(steps: Column, d: Column, k: Column) -> Column:
    """The point at a distance along a line, behind vertex ``k``."""
    a, b = F.get(steps, k - 1), F.get(steps, k)
    share = F.coalesce(F.try_divide(d - a["d"], b["d"] - a["d"]), F.lit(0.0))
    return F.struct((a["lat"] + share * (b["lat"] - a["lat"])).alias("lat"), (a["lon"] + share * (b["lon"] - a["lon"])).alias("lon"))


def segmentise(roads: DataFrame, length_m: float = 30.0, least_m: float | None = None) -> DataFrame:
    """Cut lines (``coords``) into equal segments of about ``length_m``.

    A line shorter than half that is one segment whose centre is its middle
    vertex.  Adds start, end and centre (six digits), ``bearing_deg`` and the
    position ``part`` of the segment in its line.
    """
    least = length_m / 2 if least_m is None else least_m
    lined = roads.withColumn("_s", _steps(F.col("coords"))).withColumn("_len", F.element_at("_s", -1)["d"])
    n = F.when(F.col("_len") < least, F.lit(1)).otherwise(F.greatest(F.lit(1.0), F.rint(F.col("_len") / length_m))).cast("int")
    parts = lined.withColumn("_n", n).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    size = F.col("_len") / F.col("_n")
    steps = F.col("_s")
    ends = parts.withColumns({"_da": F.col("part") * size, "_db": (F.col("part") + 1) * size, "_dc": (F.col("part") + 0.5) * size})
    ends = ends.withColumns({f"_k{x}": _place(steps, F.col(f"_d{x}")) for x in "abc"})
    ends = ends.withColumns({f"_{x}": _point(steps, F.col(f"_d{x}"), F.col(f"_k{x}")) for x in "abc"})
    middle = F.get("coords", F.floor(F.size("coords") / 2).cast("int"))
    short = F.col("_len") < least
    pick = lambda c, f: F.when(short, middle[f]).otherwise(F.col(c)[f])
    first, last = F.get("coords", 0), F.element_at("coords", -1)
    whole = F.col("_n") == 1
    a = lambda f: F.when(whole, first[f]).otherwise(F.col("_a")[f])
    b = lambda f: F.when(whole, last[f]).otherwise(F.col("_b")[f])
    return ends.withColumns(
        {
            "start_lat": a("lat"), "start_lon": a("lon"), "end_lat": b("lat"), "end_lon": b("lon"),
            "center_lat": round_even(pick("_c", "lat"), 6), "center_lon": round_even(pick("_c", "lon"), 6),
            "bearing_deg": bearing(a("lat"), a("lon"), b("lat"), b("lon")),
        }
    ).drop("_s", "_len", "_n", *(f"{k}{x}" for k in ("_", "_d", "_k") for x in "abc"))


#: What a segment has beside its line's columns.
SEGMENT = T.StructType([T.StructField(c, T.DoubleType()) for c in ("start_lat", "start_lon", "end_lat", "end_lon", "center_lat", "center_lon", "bearing_deg")])


def segments_of(length_m: float = 30.0, least_m: float | None = None) -> noding.Shape:
    """``segmentise`` for lines that a task holds as arrays, all of two vertices or more; columns are those of ``SEGMENT``."""
    least = length_m / 2 if least_m is None else least_m

    def cut(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
        first, last, size = offsets[:-1], offsets[1:] - 1, np.diff(offsets)
        lat, lon = np.ascontiguousarray(points.T)
        step = distances(lat[:-1], lon[:-1], lat[1:], lon[1:])  # those from line to line are not used
        d = np.zeros(len(points))
        by = np.argsort(-size, kind="stable")
        for k in range(1, int(size.max(initial=1))):  # vertex by vertex, so sums are a line's own
            at = first[by[: np.searchsorted(-size[by], -k)]] + k
            d[at] = d[at - 1] + step[at - 1]
        short = d[last] < least
        n = np.where(short, 1, np.maximum(1, np.rint(d[last] / length_m))).astype(int)
        share = d[last] / n

        def place(line: np.ndarray, far: np.ndarray) -> np.ndarray:
            """The points at distances along lines."""
            low, high = np.zeros(len(line), int), size[line]
            while (low < high).any():
                k = (low + high) // 2
                before = (low < high) & (d[np.minimum(first[line] + k, last[line])] < far)
                low, high = np.where(before, k + 1, low), np.where(before, high, np.minimum(high, k))
            q = first[line] + np.maximum(1, np.minimum(low, size[line] - 1))
            gap = d[q] - d[q - 1]
            part = np.divide(far - d[q - 1], gap, out=np.zeros(len(q)), where=gap != 0)
            return points[q - 1] + part[:, None] * (points[q] - points[q - 1])

        total = np.cumsum(n)
        i = 0
        while i < len(n):  # a line, or as many as make ROWS segments
            j = max(i + 1, int(np.searchsorted(total, total[i] - n[i] + noding.ROWS, side="right")))
            line = np.repeat(np.arange(i, j), n[i:j])
            part = np.arange(len(line)) - np.repeat(total[i:j] - n[i:j] - (total[i] - n[i]), n[i:j])
            a, b, c = points[first[line]], points[last[line]], points[first[line] + size[line] // 2]
            some = np.flatnonzero(n[line] > 1)
            a[some], b[some] = (place(line[some], (part[some] + k) * share[line[some]]) for k in (0, 1))
            some = np.flatnonzero(~short[line])
            c[some] = place(line[some], (part[some] + 0.5) * share[line[some]])
            c = np.rint(c * 1e6) / 1e6
            yield line, [pa.array(np.ascontiguousarray(x)) for x in (*a.T, *b.T, *c.T, bearings(*a.T, *b.T))]
            i = j

    return cut


#: Segments in a row, each of which begins where the one before ends, as the cache keeps them.  Ends are whole units of the tenth digit, and as they are
#: (``odd``) where those do not give the same number; centres are what they are off their segment's end, in units of the sixth digit.
CHAIN = T.StructType([
    T.StructField("start_lat", T.DoubleType()), T.StructField("start_lon", T.DoubleType()),
    *(T.StructField(f"{c}_{what}", T.ArrayType(kind)) for what, kind in (("e10", T.LongType()), ("odd", T.DoubleType()), ("off", T.IntegerType())) for c in ("lat", "lon")),
])
#: Segments of a chain at most, as readers hold thousands of rows at a time.
LONG = 256


def chains_of(length_m: float = 30.0, least_m: float | None = None) -> noding.Shape:
    """The segments of ``segments_of`` as chains, for lines that are alike in what is kept of them; columns are those of ``CHAIN``."""
    cut = segments_of(length_m, least_m)

    def chained(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
        for line, columns in cut(points, offsets):
            start, end, centre = ([c.to_numpy() for c in columns[k : k + 2]] for k in (0, 2, 4))
            new = np.concatenate([[True], (start[0][1:] != end[0][:-1]) | (start[1][1:] != end[1][:-1])])
            at = np.flatnonzero(new)
            new |= (np.arange(len(new)) - np.repeat(at, np.diff(np.append(at, len(new))))) % LONG == 0
            at = np.flatnonzero(new)
            bounds = pa.array(np.append(at, len(new)).astype("i4"))
            units = [np.rint(x * 1e10).astype("i8") for x in end]
            exact = [u / 1e10 == x for u, x in zip(units, end, strict=True)]
            off = [(np.rint(c * 1e6) - np.rint(x * 1e6)).astype("i4") for c, x in zip(centre, end, strict=True)]
            lists = [*map(pa.array, units), *(pa.array(x, mask=e) for x, e in zip(end, exact, strict=True)), *map(pa.array, off)]
            yield line[at], [*(pa.array(x[at]) for x in start), *(pa.ListArray.from_arrays(bounds, v) for v in lists)]

    return chained


def unchained(chains: DataFrame) -> DataFrame:
    """The segments of chains, with the columns of ``SEGMENT``; rows that are segments already stay."""
    rows = chains.select("*", F.posexplode_outer("lat_e10").alias("_i", "_u"))
    i = F.col("_i")
    place = lambda c, k: F.coalesce(F.get(f"{c}_odd", k), F.get(f"{c}_e10", k) / F.lit(1e10))
    a = {c: F.when(i > 0, place(c, i - 1)).otherwise(F.col(f"start_{c}")) for c in ("lat", "lon")}
    b = {c: F.coalesce(place(c, i), F.col(f"end_{c}")) for c in ("lat", "lon")}
    centre = {c: F.coalesce((F.rint(place(c, i) * 1e6) + F.get(f"{c}_off", i)) / F.lit(1e6), F.col(f"center_{c}")) for c in ("lat", "lon")}
    made = {f"{k}_{c}": v[c] for k, v in (("start", a), ("end", b), ("center", centre)) for c in ("lat", "lon")}
    made["bearing_deg"] = F.coalesce("bearing_deg", bearing(a["lat"], a["lon"], b["lat"], b["lon"]))
    return rows.select(*(c for c in chains.columns if c not in {*CHAIN.names, *SEGMENT.names}), *(v.alias(k) for k, v in made.items()))


def number_segments(segments: DataFrame) -> DataFrame:
    """Segments with a number from 0 by (centre, class, name, start), the same on every run.

    Numbers come from counts of cells and places within a cell, so no single
    task sees all segments.
    """
    celled = segments.withColumns({"_i": F.floor(F.col("center_lat") * 10), "_j": F.floor(F.col("center_lon") * 10)})
    order = ["center_lat", "center_lon", "rd_type", "rd_name", "start_lat", "start_lon", "end_lat", "end_lon"]
    within = Window.partitionBy("_i", "_j").orderBy(*order)
    sizes = celled.groupBy("_i", "_j").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_i", "_j").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a cell
    numbered = celled.withColumn("_r", F.row_number().over(within) - 1).join(small(before.drop("_n")), ["_i", "_j"])
    return numbered.withColumn("segment_id", (F.col("_base") + F.col("_r")).cast("bigint")).drop("_i", "_j", "_r", "_base")


def segment_table(segments: DataFrame) -> DataFrame:
    """The columns that matching needs."""
    return number_segments(segments).select(
        "segment_id", F.col("rd_name").alias("road_name"), F.col("rd_type").alias("highway"), "oneway", "service",
        "start_lat", "start_lon", "end_lat", "end_lon", "center_lat", "center_lon", "bearing_deg",
    )


def build_segments(elements: DataFrame, length_m: float = 30.0, classes: tuple[str, ...] = ROAD_CLASSES, split: bool = True) -> DataFrame:
    """Map elements to matchable segments, without a geometry library."""
    roads = cluster_directions(parse_roads(elements, classes))
    return segment_table(segmentise(split_at_crossings(roads, elements) if split else roads, length_m))


def build_cells(elements: DataFrame, length_m: float = 30.0, size: float = 0.1, classes: tuple[str, ...] = ROAD_CLASSES, only: DataFrame | None = None, chained: bool = False) -> DataFrame:
    """Map elements to segments of whole cells, with ``cell_lat`` and ``cell_lon``; ``chained``: to chains of them.

    Each cell is built from the roads that pass it and from nothing else: ways
    are clustered by name among those of the cell, clipped to it, noded with
    their group in it and cut into segments.  So a cell's segments are the same
    whatever else is built with it, provided its elements are whole; ``only``
    names the cells that are built, by default all.
    """
    clipped = noding.clip_to_cells(parse_roads(elements, classes), size)
    cells = ("cell_lat", "cell_lon")
    wanted = clipped if only is None else clipped.join(small(only), list(cells), "left_semi")
    clustered = cluster_directions(wanted, by=(*cells, "rd_name"), counted=F.col("run") == 0)
    keep = [*cells, "rd_name", "rd_type", "oneway", "service"]
    shape = (chains_of(length_m), CHAIN) if chained else (segments_of(length_m), SEGMENT)
    return noding.node_cells(clustered, keep, *shape).drop("piece")


def without_service(segments: DataFrame) -> DataFrame:
    """Roads that are not service roads, and named service roads without a kind."""
    return segments.filter((F.col("highway") != "service") | (F.col("road_name").isNotNull() & F.col("service").isNull()))


def in_box(segments: DataFrame, track: DataFrame, buffer_m: float = 200.0, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Segments whose centre lies in the track's box, widened by one and a half buffers."""
    d = buffer_m / DEGREE * 1.5
    box = track.agg((F.min(lat) - d).alias("_s"), (F.max(lat) + d).alias("_n"), (F.min(lon) - d).alias("_w"), (F.max(lon) + d).alias("_e"))
    inside = F.col("center_lat").between(F.col("_s"), F.col("_n")) & F.col("center_lon").between(F.col("_w"), F.col("_e"))
    return segments.join(F.broadcast(box), inside).drop("_s", "_n", "_w", "_e")  # one row


def cells_of(track: DataFrame, size: float = 0.1, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The grid cells that a track touches."""
    good = track.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return good.select(cell(F.col(lat), size).alias("cell_lat"), cell(F.col(lon), size).alias("cell_lon")).distinct()


def missing_cells(needed: DataFrame, cached: DataFrame) -> DataFrame:
    """Cells that are needed and not in the cache."""
    key = ["cell_lat", "cell_lon"]
    return needed.select(*key).distinct().join(cached.select(*key), key, "left_anti")


def newest_cells(summary: DataFrame) -> DataFrame:
    """Of each cell and segment length the newest entry."""
    key = ["cell_lat", "cell_lon", "length_seg"]
    order = Window.partitionBy(*key).orderBy(F.desc("date"), F.desc("file"))
    return summary.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def cell_file(lat: Column, lon: Column, length_seg: Column) -> Column:
    """The name of a cell's file."""
    return F.format_string("segments_%.1f_%.1f_%dm", lat, lon, length_seg.cast("int"))
