"""Clipping and noding against exact fractions, and cells that do not depend on their neighbours."""

import itertools
import math
import random
import time
from fractions import Fraction as Q

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracklake import road_queries
from tracklake.operators import noding, roads
from tracklake.queries import ORACLE_SQL
from tracklake.sources.maps import RoadCache

LINES = "way_id long, rd_name string, coords array<struct<lat:double,lon:double>>"
KIND = "type string, id long, lat double, lon double, nodes array<long>, tags map<string,string>"
UNIT = 0.0007


def cross(o, p, q):
    return (p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])


def meet(e, f):
    """All points where two edges meet at a point, or the ends of what they share."""
    (a, b), (c, d) = e, f
    den = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
    if den == 0:
        within = lambda p, u, v: cross(u, v, p) == 0 and min(u, v) <= p <= max(u, v)
        return {p for p in (a, b) if within(p, c, d)} | {p for p in (c, d) if within(p, a, b)}
    s = Q((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0]), den)
    t = Q((c[0] - a[0]) * (b[1] - a[1]) - (c[1] - a[1]) * (b[0] - a[0]), den)
    return {(a[0] + s * (b[0] - a[0]), a[1] + s * (b[1] - a[1]))} if 0 <= s <= 1 and 0 <= t <= 1 else set()


def exact(lines):
    """Undirected parts between nodes and vertices, and the nodes, by all pairs of edges."""
    edges = [(k, i, e) for k, line in enumerate(lines) for i, e in enumerate(itertools.pairwise(line)) if e[0] != e[1]]
    on, nodes = {(k, i): set(e) for k, i, e in edges}, set()
    for line in lines:
        nodes |= {line[0], line[-1]}
    for (k, i, e), (m, j, f) in itertools.combinations(edges, 2):
        for p in meet(e, f):
            if k == m and j == i + 1 and p == e[1] == f[0]:
                continue
            on[k, i].add(p)
            on[m, j].add(p)
            nodes.add(p)
    parts = set()
    for k, i, (a, b) in edges:
        for p, q in itertools.pairwise(sorted(on[k, i])):
            parts.add((p, q))
    return parts, nodes


def made(spark, groups):
    rows = [(100 * g + k, f"g{g}", [(float(p[0] * UNIT), float(p[1] * UNIT)) for p in line]) for g, lines in enumerate(groups) for k, line in enumerate(lines)]
    return spark.createDataFrame(rows, LINES)


def near(p):
    return round(float(p[0]) * UNIT, 8), round(float(p[1]) * UNIT, 8)


def test_lines_are_noded_as_exact_fractions_say(spark):
    rng = random.Random(3)
    groups = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            line = [(rng.randrange(8), rng.randrange(8))]
            for _ in range(rng.randrange(1, 5)):
                p = (rng.randrange(8), rng.randrange(8))
                if p != line[-1] and (len(line) < 2 or cross(line[-2], line[-1], p)):  # an edge never turns back into itself
                    line.append(p)
            if len(line) > 1:
                lines.append(line)
        groups.append(lines or [[(0, 0), (1, 1)]])
    got = {}
    for r in noding.node_lines(made(spark, groups), ["way_id"], ["rd_name"]).collect():
        got.setdefault(int(r.rd_name[1:]), []).append([(round(p.lat, 8), round(p.lon, 8)) for p in r.coords])
    for g, lines in enumerate(groups):
        parts, nodes = exact(lines)
        ours = [tuple(sorted(e)) for piece in got[g] for e in itertools.pairwise(piece)]
        assert len(ours) == len(set(ours)) and set(ours) == {tuple(sorted(map(near, e))) for e in parts}, (g, lines)
        marks = {near(p) for p in nodes}
        for piece in got[g]:
            assert {piece[0], piece[-1]} <= marks and not set(piece[1:-1]) & marks, (g, lines, piece)


def test_groups_do_not_meet_and_odd_lines_go(spark):
    lines = made(spark, [[[(0, 0), (4, 4)]], [[(0, 4), (4, 0)]]]).unionByName(spark.createDataFrame([(900, None, [(0.1, 0.1)]), (901, None, []), (902, None, None), (903, None, [(0.2, 0.2), (0.2, 0.2)])], LINES))
    assert sorted((r.way_id, len(r.coords)) for r in noding.node_lines(lines, ["way_id"], ["rd_name"]).collect()) == [(0, 2), (100, 2)]
    assert noding.node_lines(lines.limit(0), ["way_id"], ["rd_name"]).collect() == []


def test_clipped_lines_cover_the_line_once(spark):
    rng = random.Random(9)
    rows = [(k, "x", [(rng.uniform(-0.35, 0.35), rng.uniform(-0.35, 0.35)) for _ in range(rng.randrange(2, 8))]) for k in range(60)]
    rows += [(100, "x", [(0.05, -0.25), (0.05, 0.25)]), (101, "x", [(0.1, 0.02), (0.1, 0.18)]), (102, "x", [(-0.3, -0.3), (0.3, 0.3)])]
    length = lambda c: sum(((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5 for a, b in itertools.pairwise(c))
    total, ends = {}, {}
    for r in noding.clip_to_cells(spark.createDataFrame(rows, LINES)).collect():
        for p in r.coords:
            assert r.cell_lat <= p.lat <= round(r.cell_lat + 0.1, 10) and r.cell_lon <= p.lon <= round(r.cell_lon + 0.1, 10), r
        total[r.way_id] = total.get(r.way_id, 0) + length(r.coords)
        ends.setdefault(r.way_id, []).extend([tuple(r.coords[0]), tuple(r.coords[-1])])
    for k, _, c in rows:
        assert total[k] == pytest.approx(length(c), abs=1e-7)
        inner = [p for p in ends[k] if p not in (tuple(c[0]), tuple(c[-1]))]
        assert all(inner.count(p) == 2 for p in inner), k  # the same bits on either side of a border
    assert {r.cell_lat for r in noding.clip_to_cells(spark.createDataFrame(rows[61:62], LINES)).collect()} == {0.1}


def town():
    """A road over two cells, a street that crosses it without a node in the northern one only, and one-way ways."""
    nodes = [("node", i, 37.85 + i * 0.001, -122.25, None, None) for i in range(100)]
    nodes += [("node", 200, 37.92, -122.26, None, None), ("node", 201, 37.92, -122.24, None, None), ("node", 202, 37.93, -122.26, None, None), ("node", 203, 37.9305, -122.24, None, None)]
    ways = [
        ("way", 1, None, None, list(range(100)), {"highway": "residential", "name": "A"}),
        ("way", 2, None, None, [200, 201], {"highway": "residential", "name": "A"}),
        ("way", 3, None, None, [202, 203], {"highway": "primary", "name": "B", "oneway": "yes"}),
        ("way", 4, None, None, [203, 202], {"highway": "primary", "name": "B", "oneway": "yes"}),
    ]
    return [*nodes, *ways]


def test_cells_do_not_depend_on_what_else_is_built(spark, tmp_path):
    here = {(37.8, -122.3): (37.86, -122.25), (37.9, -122.3): (37.93, -122.25)}

    def built(name, orders):
        cache = RoadCache(spark, str(tmp_path / name), elements=lambda cells: spark.createDataFrame(town(), KIND))
        for cells in orders:
            cache.segments(spark.createDataFrame([here[c] for c in cells], "lat double, lon double"))
        return sorted(map(str, cache.stored().drop("date").select(sorted(set(cache.stored().columns) - {"date"})).collect()))

    south, north = here
    once = built("once", [[south, north]])
    assert built("south", [[south], [north]]) == once == built("north", [[north], [south]])
    assert all(a == b for a, b in zip(once, sorted(set(once)), strict=True))


def test_crossings_without_a_node_are_cut(spark):
    found = roads.build_cells(spark.createDataFrame(town(), KIND), 30.0)
    at = F.abs(F.col("start_lat") - 37.92) + F.abs(F.col("start_lon") + 122.25)
    assert found.filter(at < 1e-9).count() == 2  # both roads begin anew where they cross
    assert {r[0] for r in found.filter("rd_name = 'A'").select("cell_lat").distinct().collect()} == {37.8, 37.9}
    box = found.filter("center_lat < cell_lat or center_lat > cell_lat + 0.1000001 or end_lat > cell_lat + 0.1000001")
    assert box.isEmpty()
    assert found.filter("rd_name = 'B'").select("bearing_deg").distinct().count() > 1  # opposite ways are two clusters


def test_rings_by_their_edges_in_a_cell(spark):
    """Rings of three sizes, concave, open and with round coordinates, against every edge of every ring."""
    from tracklake.functions.geo import in_ring
    from tracklake.operators import output

    rng = random.Random(21)

    def star(lat, lon, radius, n):
        turn = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        return [(lat + radius * rng.uniform(0.3, 1) * math.sin(t), lon + radius * rng.uniform(0.3, 1) * math.cos(t)) for t in turn]

    rings = [star(rng.uniform(30, 31), rng.uniform(-1, 1), r, n) for r, n in ((0.03, 5), (0.05, 40), (0.5, 60), (0.7, 200), (20.0, 90))]
    rings = [[*r, r[0]] for r in rings] + [[(30.0, 0.0), (30.0, 0.5), (30.25, 0.5), (30.25, 0.0), (30.0, 0.0)], [(30.5, 0.5), (30.5, 0.625), (30.75, 0.5), (30.5, 0.5)]]
    df = spark.createDataFrame([(r,) for r in rings], "ring array<struct<lat:double,lon:double>>")
    points = [(k, rng.uniform(29.5, 31.5), rng.uniform(-1.5, 1.5)) for k in range(4000)] + [(5000, None, 1.0), (5001, 30.1, None), (5002, 89.0, 179.0)]
    rows = spark.createDataFrame(points, "k long, latitude double, longitude double")
    for chosen in ([0, 1, 2, 3, 5, 6], [4], range(7)):
        some = df.filter(F.xxhash64("ring").isin([r[0] for r in spark.createDataFrame([(rings[i],) for i in chosen], df.schema).select(F.xxhash64("ring")).collect()]))
        plain = rows.crossJoin(F.broadcast(some)).filter(in_ring(F.col("latitude"), F.col("longitude"), F.col("ring"))).select("k").distinct()
        want = {k for k, *_ in points} - {r.k for r in plain.collect()}
        assert {r.k for r in output.outside(rows, some).collect()} == want
        assert 0 < len(want) < len(points) or len(chosen) == 1
    opened = spark.createDataFrame([([p for p in rings[5][:-1]],), (None,), ([],)], df.schema)
    assert {r.k for r in output.outside(rows, opened).collect()} == {k for k, a, o in points if a is None or o is None or not (30.0 < a < 30.25 and 0.0 < o < 0.5)}


def test_a_dense_tile_is_paired_in_blocks(spark):
    """Streets of one name that all cross within one tile: 1.4 million crossings."""
    n, step = 1200, 1.6e-6
    k = F.col("id") % n
    at, far = F.lit(0.00005) + k * step, F.lit(0.00199)
    point = lambda lat, lon: F.struct(lat.alias("lat"), lon.alias("lon"))
    coords = F.when(F.col("id") < n, F.array(point(at, F.lit(0.00001)), point(at, far))).otherwise(F.array(point(F.lit(0.00001), at), point(far, at)))
    lines = spark.range(2 * n).select(F.col("id").alias("way_id"), F.lit("x").alias("rd_name"), coords.alias("coords"))
    start = time.monotonic()
    found = noding.node_lines(lines, ["way_id"], ["rd_name"]).agg(F.count("*"), F.sum(F.size("coords")), F.max("piece")).first()
    assert tuple(found) == (2 * n * (n + 1), 4 * n * (n + 1), n)
    assert time.monotonic() - start < 60


def test_marks_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    e = np.column_stack([rng.integers(0, 9, (150, 4)) * 2e-4 + 1e-4, np.zeros((150, 2))])
    e = e[(e[:, :2] != e[:, 2:4]).any(1)]
    line, at = np.repeat(np.arange(75), 2)[: len(e)], np.tile([0, 1], 75)[: len(e)]
    told = lambda: sorted((int(i), *map(float, m)) for edges, marks in noding._met_in_tile(e, line, at, 0.002) for i, m in zip(edges, marks, strict=True) if m[0] >= 0)
    whole = told()
    monkeypatch.setattr(noding, "PAIRS", 64)
    assert told() == whole and len(whole) > 1000


def test_few_parts_are_compared_across_lines():
    """All parts with the ends of another are suspects, and of edges that cross densely hardly any others are."""
    rng = np.random.default_rng(8)

    def parts(e):
        held = [[] for _ in e]
        for edges, marks in noding._met_in_tile(np.column_stack([e, np.zeros((len(e), 2))]), np.arange(len(e)), np.zeros(len(e), int), 0.002):
            for i, m in zip(edges, marks, strict=True):
                held[i].append(m)
        rows = [(f"{k:05d}", *e[k], None) for k in range(len(e))] + [(f"{k:05d}", None, None, None, None, np.array(m).tobytes()) for k, m in enumerate(held) if m]
        return noding._parts(pa.Table.from_pylist([dict(zip(("_l", "_ax", "_ay", "_bx", "_by", "_marks"), r, strict=True)) for r in sorted(rows, key=lambda r: (r[0], r[5] is not None))]))

    dense = parts(rng.uniform(1e-5, 1.99e-3, (900, 4)))
    assert len(dense["row"]) > 100_000 and dense["suspect"].mean() < 0.03
    low = rng.integers(0, 6, (120, 2)) * 3e-4 + 1e-4  # edges of few directions, many of them in one another or turned by a little
    turn = np.array([[3e-4, 0], [0, 3e-4], [3e-4, 3e-4], [6e-4, 3e-4 + 2e-10], [6e-4, 3e-4 + 1e-7], [6e-4, 3e-4]])[rng.integers(0, 6, 120)]
    level = parts(np.column_stack([low, low + turn]))
    ends = [tuple(sorted([tuple(a), tuple(b)])) for a, b in zip(level["a"], level["b"], strict=True)]
    twice = np.array([ends.count(x) > 1 for x in ends])
    assert twice.sum() > 50 and level["suspect"][twice].all()


def test_segments_are_those_of_the_column_operator(spark):
    rng = random.Random(12)
    lines = [[(37 + rng.uniform(0, 1) * far, -122 + rng.uniform(0, 1) * far) for _ in range(n)] for n in (2, 2, 3, 5, 40) for far in (1e-5, 1e-4, 2e-4, 1e-3, 2e-2) for _ in range(8)]
    lines += [[(37.0, -122.0)] * 2, [(37.0, -122.0)] * 3, [(37.0, -122.0), (37.0, -122.0), (37.01, -122.0), (37.01, -122.0)]]
    names = roads.SEGMENT.names
    df = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "k long, coords array<struct<lat:double,lon:double>>")
    want = [tuple(r) for r in roads.segmentise(df).orderBy("k", "part").select("k", *names).collect()]
    points, offsets = np.array([p for line in lines for p in line]), np.cumsum([0, *map(len, lines)])
    for rows in (7, noding.ROWS):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(noding, "ROWS", rows)
            got = [row for of, columns in roads.segments_of()(points, offsets) for row in zip(of.tolist(), *(c.to_pylist() for c in columns), strict=True)]
        assert [r[0] for r in got] == [r[0] for r in want]
        off = np.abs(np.array(got) - np.array(want))[:, 1:]
        assert off[:, :6].max() < 1e-9 and np.minimum(off[:, 6], 360 - off[:, 6]).max() < 1e-4, off.max(0)  # the shortest are a centimetre long


def test_segments_of_cells_are_made_where_pieces_are_found(spark):
    """Pieces can be many times the roads, so nothing after them shuffles, sorts or walks through lists."""
    wanted = spark.createDataFrame([(37.9, -122.3)], "cell_lat double, cell_lon double")
    found = roads.build_cells(spark.createDataFrame(town(), KIND), 30.0, only=wanted)
    after = found._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    assert not any(x in after for x in ("Exchange", "Sort", "Join", "Generate"))
    whole = roads.build_cells(spark.createDataFrame(town(), KIND), 30.0).filter("cell_lat = 37.9")
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_copies_of_lines_are_noded_as_sql_does(spark, tmp_path, monkeypatch):
    """Four copies of each line, whose later ones may be cut elsewhere by a last digit, in groups of many tasks; marks are not shuffled."""
    other = duckdb.connect()
    other.sql(f"COPY (SELECT i + 80640 * c AS s_suppkey FROM range(500) r(i), range(4) q(c)) TO '{tmp_path}/supplier.parquet'")
    other.sql(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet'")
    monkeypatch.setattr(noding, "EDGES", 16)
    got = road_queries.road_nodes(spark, str(tmp_path))
    want = other.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL['road_nodes']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 30_000
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 2  # the plan is printed twice


def test_equal_edges_are_told_apart_by_their_order():
    """Marks on an edge are those of all pairs, also where a copy before it and one after it meet another edge at two points."""
    rng = np.random.default_rng(6)
    e = rng.integers(0, 60, (40, 4)) * 3.37e-5 + rng.uniform(0, 1e-6, (40, 4))
    e = np.concatenate([e, e[rng.permutation(40)], e[:10, [2, 3, 0, 1]]])
    line, at = np.arange(len(e)), np.zeros(len(e), int)
    found = {k: set() for k in line.tolist()}
    for edge, marks in noding._met_in_tile(e, line, at, 0.002):
        for k, m in zip(edge.tolist(), marks.tolist(), strict=True):
            found[k] |= {tuple(m)} if m[0] >= 0 else set()
    want = {k: set() for k in line.tolist()}
    for i, j in itertools.combinations(line.tolist(), 2):
        for first, k in ((True, i), (False, j)):
            for _, *m in noding._meetings(e[i : i + 1], e[j : j + 1], np.zeros(1, bool), first):
                want[k] |= set(zip(*(c.tolist() for c in m), strict=True))
    assert found == want and sum(map(len, want.values())) > 1000


def test_the_cache_keeps_segments_in_few_bytes(spark, tmp_path):
    """Chains give the same numbers, ends off the tenth digit too; files of plain segments are read; a dense cell takes few bytes a segment."""
    from tracklake.sources import maps

    rng = random.Random(5)
    lines = [[(37 + rng.random() * far, -122 + round(rng.random() * far, digits)) for _ in range(n)] for n in (2, 3, 40) for far in (1e-5, 1e-3, 2e-2) for digits in (6, 10, 17) for _ in range(4)]
    points, offsets = np.array([p for line in lines for p in line]), np.cumsum([0, *map(len, lines)])
    made = lambda shape, names: pa.concat_tables(pa.table([pa.array(of), *columns], names=["k", *names]) for of, columns in shape(points, offsets))
    want = made(roads.segments_of(), roads.SEGMENT.names)
    chains = spark.createDataFrame(made(roads.chains_of(), roads.CHAIN.names))
    plain = spark.createDataFrame(want)
    stored = chains.unionByName(plain, allowMissingColumns=True).select("k", *(f.name for f in maps.STORED.fields if f.name in {*roads.CHAIN.names, *roads.SEGMENT.names}))
    got = [tuple(r[c] for c in roads.SEGMENT.names) for r in roads.unchained(stored).collect()]
    twice = sorted(zip(*(want[c].to_pylist() for c in roads.SEGMENT.names), strict=True)) * 2
    assert len(got) == len(twice) > 3000
    got, twice = np.array(sorted(got)), np.array(sorted(twice))
    assert (got[:, :6] == twice[:, :6]).all() and np.abs(got[:, 6] - twice[:, 6]).max() < 1e-6

    k = F.col("id")
    node = lambda i, lat, lon: spark.range(600).select(F.lit("node").alias("type"), (k * 2 + i).alias("id"), lat.alias("lat"), lon.alias("lon"), F.lit(None).cast("array<long>").alias("nodes"), F.lit(None).cast("map<string,string>").alias("tags"))
    ways = spark.range(600).select(F.lit("way"), k, F.lit(None), F.lit(None), F.array(k * 2, k * 2 + 1), F.create_map(F.lit("highway"), F.lit("residential"), F.lit("name"), F.lit("x")))
    at = lambda i: (k * 7919 + i * 104729) % 9973 / F.lit(1e6)
    elements = node(0, 37.001 + at(1), -122.099 + at(2)).unionByName(node(1, 37.001 + at(5), -122.099 + at(7))).union(ways)
    cache = RoadCache(spark, str(tmp_path / "cells"), elements=lambda cells: elements)
    cache.segments(spark.createDataFrame([(37.05, -122.05)], "lat double, lon double"))
    n = cache.stored().count()
    size = sum(f.stat().st_size for f in (tmp_path / "cells").rglob("*.parquet"))
    assert n > 10_000 and size < 20 * n, (size, n)
    assert cache.stored().filter("bearing_deg IS NULL OR center_lat IS NULL").isEmpty()
