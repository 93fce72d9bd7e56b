"""Queries of roads by cell: clipped, noded, built into the cache.  Lines on the test tables cross without shared nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators import noding
from tracklake.queries import query, r, sql_haversine, sql_r, table
from tracklake.sources.maps import RoadCache
from tracklake.sources.scratch import scratch_path

#: Degrees of the cells.
SIZE = 0.02


def vertices(spark, sf) -> DataFrame:
    """Three vertices for each supplier, somewhere in a sixteenth of a degree."""
    k = F.col("s_suppkey")
    spot = lambda i: F.struct(
        (F.lit(37) + (k * 37 + i * (k % 5 + 1) * 29) % 256 / F.lit(4096.0)).alias("lat"), (F.lit(-122) + (k * 53 + i * i * (k % 7 + 1) * 31) % 256 / F.lit(4096.0)).alias("lon")
    )
    return table(spark, sf, "supplier").select(k.alias("way_id"), F.concat(F.lit("R"), (k % 9).cast("string")).alias("rd_name"), F.array(*(spot(i) for i in range(3))).alias("coords"))


_BORDER = f"round_even({{i}} * {SIZE}::DOUBLE * 1e10, 0) / 1e10"
_CELLS = f"unnest(range(CAST(floor(least({{a}}, {{b}}) / {SIZE}::DOUBLE) AS BIGINT) - 1, CAST(floor(greatest({{a}}, {{b}}) / {SIZE}::DOUBLE) AS BIGINT) + 2))"

#: Parts of edges by cell, gathered into runs.
_CLIPPED = f"""
    pts AS (SELECT s_suppkey AS way, i, 37 + ((s_suppkey * 37 + i * (s_suppkey % 5 + 1) * 29) % 256) / 4096::DOUBLE AS y, -122 + ((s_suppkey * 53 + i * i * (s_suppkey % 7 + 1) * 31) % 256) / 4096::DOUBLE AS x FROM supplier CROSS JOIN (SELECT unnest(range(0, 3)) AS i)),
    ed AS (SELECT way, i AS pos, y AS ay, x AS ax, lead(y) OVER w AS cy, lead(x) OVER w AS cx FROM pts WINDOW w AS (PARTITION BY way ORDER BY i)),
    ci AS (SELECT *, {_CELLS.format(a='ay', b='cy')} AS i FROM ed WHERE cy IS NOT NULL),
    cj AS (SELECT *, {_CELLS.format(a='ax', b='cx')} AS j FROM ci),
    ck AS (SELECT *, {_BORDER.format(i='i')} AS s0, {_BORDER.format(i='(i + 1)')} AS n0, {_BORDER.format(i='j')} AS w0, {_BORDER.format(i='(j + 1)')} AS e0, cy - ay AS dy, cx - ax AS dx FROM cj),
    cl AS (SELECT *, CASE WHEN dy > 0 THEN (s0 - ay) / dy WHEN dy < 0 THEN (n0 - ay) / dy END AS yin, CASE WHEN dy > 0 THEN (n0 - ay) / dy WHEN dy < 0 THEN (s0 - ay) / dy END AS yout,
                  CASE WHEN dx > 0 THEN (w0 - ax) / dx WHEN dx < 0 THEN (e0 - ax) / dx END AS xin, CASE WHEN dx > 0 THEN (e0 - ax) / dx WHEN dx < 0 THEN (w0 - ax) / dx END AS xout FROM ck),
    cm AS (SELECT *, greatest(0::DOUBLE, coalesce(yin, 0), coalesce(xin, 0)) AS s, least(1::DOUBLE, coalesce(yout, 1), coalesce(xout, 1)) AS t FROM cl),
    cn AS (SELECT way, s0 AS cell_lat, w0 AS cell_lon, pos, s, t,
                  CASE WHEN s = 0 THEN ay WHEN s = yin THEN CASE WHEN dy > 0 THEN s0 ELSE n0 END ELSE ay + s * dy END AS ay, CASE WHEN s = 0 THEN ax WHEN s = xin THEN CASE WHEN dx > 0 THEN w0 ELSE e0 END ELSE ax + s * dx END AS ax,
                  CASE WHEN t = 1 THEN cy WHEN t = yout THEN CASE WHEN dy > 0 THEN n0 ELSE s0 END ELSE ay + t * dy END AS cy, CASE WHEN t = 1 THEN cx WHEN t = xout THEN CASE WHEN dx > 0 THEN e0 ELSE w0 END ELSE ax + t * dx END AS cx
           FROM cm WHERE t - s > 1e-9 AND (dy <> 0 OR (s0 <= ay AND ay < n0)) AND (dx <> 0 OR (w0 <= ax AND ax < e0))),
    co AS (SELECT *, CASE WHEN lag(pos) OVER w = pos - 1 AND lag(t) OVER w = 1 AND s = 0 THEN 0 ELSE 1 END AS new FROM cn WINDOW w AS (PARTITION BY way, cell_lat, cell_lon ORDER BY pos, s)),
    runs AS (SELECT *, sum(new) OVER (PARTITION BY way, cell_lat, cell_lon ORDER BY pos, s) - 1 AS run FROM co)"""

_SNAP = "CASE WHEN abs({t}) * {n} <= 1e-10 THEN 0 WHEN abs({t} - 1) * {n} <= 1e-10 THEN 1 ELSE {t} END"
_PICK = "CASE WHEN s = 0 THEN {a} WHEN s = 1 THEN {b} WHEN t = 0 THEN {c} WHEN t = 1 THEN {d} ELSE round_even(({a} + s * {u}) * 1e10, 0) / 1e10 END"


def _beside(first: str, q: str, o: str, v: str) -> str:
    """Marks of one end of an edge on the other, where both lie in one line."""
    along = f"(({q}x - {o}x) * {v}x + ({q}y - {o}y) * {v}y) / (n{v} * n{v})"
    return f"SELECT *, {first} AS first, {_SNAP.format(t=along, n='n' + v)} AS m, {q}y AS py, {q}x AS px FROM pc WHERE abs(den) <= 1e-12::DOUBLE * nu * nv AND abs((cx - ax) * uy - (cy - ay) * ux) / nu <= 1e-10::DOUBLE"


#: Pieces of the runs between the points where lines of a cell and name meet.
_NODED = f"""
    ne AS (SELECT way, cell_lat, cell_lon, run, row_number() OVER (PARTITION BY way, cell_lat, cell_lon, run ORDER BY pos) - 1 AS pos, way % 9 AS g, ay, ax, cy, cx FROM runs),
    nf AS (SELECT * FROM ne WHERE ay <> cy OR ax <> cx),
    pa AS (SELECT x.cell_lat, x.cell_lon, x.way AS way1, x.run AS run1, x.pos AS at1, y.way AS way2, y.run AS run2, y.pos AS at2, x.way = y.way AND x.run = y.run AND x.pos + 1 = y.pos AS joint,
                  x.ay AS ay, x.ax AS ax, x.cy AS hy, x.cx AS hx, y.ay AS cy, y.ax AS cx, y.cy AS dy, y.cx AS dx
           FROM nf x JOIN nf y ON x.cell_lat = y.cell_lat AND x.cell_lon = y.cell_lon AND x.g = y.g AND (x.way, x.run, x.pos) < (y.way, y.run, y.pos)),
    pb AS (SELECT *, hx - ax AS ux, hy - ay AS uy, dx - cx AS vx, dy - cy AS vy FROM pa),
    pc AS (SELECT *, sqrt(ux * ux + uy * uy) AS nu, sqrt(vx * vx + vy * vy) AS nv, ux * vy - uy * vx AS den FROM pb),
    pd AS (SELECT *, {_SNAP.format(t='(((cx - ax) * vy - (cy - ay) * vx) / den)', n='nu')} AS s, {_SNAP.format(t='(((cx - ax) * uy - (cy - ay) * ux) / den)', n='nv')} AS t FROM pc WHERE abs(den) > 1e-12::DOUBLE * nu * nv),
    pe AS (SELECT *, {_PICK.format(a='ay', b='hy', c='cy', d='dy', u='uy')} AS py, {_PICK.format(a='ax', b='hx', c='cx', d='dx', u='ux')} AS px FROM pd WHERE s BETWEEN 0 AND 1 AND t BETWEEN 0 AND 1),
    pf AS (SELECT * FROM (SELECT * EXCLUDE (s, t), true AS first, s AS m FROM pe UNION ALL BY NAME SELECT * EXCLUDE (s, t), false AS first, t AS m FROM pe
           UNION ALL BY NAME {_beside('true', 'c', 'a', 'u')} UNION ALL BY NAME {_beside('true', 'd', 'a', 'u')} UNION ALL BY NAME {_beside('false', 'a', 'c', 'v')} UNION ALL BY NAME {_beside('false', 'h', 'c', 'v')})
           WHERE m BETWEEN 0 AND 1 AND NOT (joint AND py = hy AND px = hx)),
    marks AS (SELECT DISTINCT cell_lat, cell_lon, CASE WHEN first THEN way1 ELSE way2 END AS way, CASE WHEN first THEN run1 ELSE run2 END AS run, CASE WHEN first THEN at1 ELSE at2 END AS pos, m, py, px FROM pf),
    po AS (SELECT cell_lat, cell_lon, way, run, pos, py, px, min(m) AS m FROM (
               SELECT cell_lat, cell_lon, way, run, pos, m, py, px FROM marks WHERE m > 0 AND m < 1
               UNION ALL SELECT cell_lat, cell_lon, way, run, pos, 0, ay, ax FROM nf UNION ALL SELECT cell_lat, cell_lon, way, run, pos, 1, cy, cx FROM nf) GROUP BY ALL),
    pp AS (SELECT *, row_number() OVER w - 1 AS k, lead(py) OVER w AS qy, lead(px) OVER w AS qx, lead(m) OVER w AS qm FROM po WINDOW w AS (PARTITION BY cell_lat, cell_lon, way, run, pos ORDER BY m, py, px)),
    su AS (SELECT pp.*, m > 0 OR EXISTS (SELECT 1 FROM marks x WHERE x.cell_lat = pp.cell_lat AND x.cell_lon = pp.cell_lon AND x.way = pp.way AND x.run = pp.run AND x.pos = pp.pos AND x.m = 0) AS cut,
                  qm < 1 OR EXISTS (SELECT 1 FROM marks x WHERE x.cell_lat = pp.cell_lat AND x.cell_lon = pp.cell_lon AND x.way = pp.way AND x.run = pp.run AND x.pos = pp.pos AND x.m = 1) AS done
           FROM pp WHERE qy IS NOT NULL),
    un AS (SELECT *, CASE WHEN (py, px) < (qy, qx) THEN {{'a': py, 'b': px, 'c': qy, 'd': qx}} ELSE {{'a': qy, 'b': qx, 'c': py, 'd': px}} END AS ends FROM su),
    si AS (SELECT * FROM un QUALIFY row_number() OVER (PARTITION BY cell_lat, cell_lon, way % 9, ends ORDER BY way, run, pos, k) = 1),
    fl AS (SELECT *, CASE WHEN coalesce(cut OR lag(done) OVER w OR lag(qy) OVER w <> py OR lag(qx) OVER w <> px, true) THEN 1 ELSE 0 END AS begins FROM si WINDOW w AS (PARTITION BY cell_lat, cell_lon, way, run ORDER BY pos, k)),
    pieces AS (SELECT *, sum(begins) OVER (PARTITION BY cell_lat, cell_lon, way, run ORDER BY pos, k) - 1 AS piece FROM fl)"""

_ENDS = f"{sql_r('arg_min({y0}, (pos, {k}))', 7)} AS start_lat, {sql_r('arg_min({x0}, (pos, {k}))', 7)} AS start_lon, {sql_r('arg_max({y1}, (pos, {k}))', 7)} AS end_lat, {sql_r('arg_max({x1}, (pos, {k}))', 7)} AS end_lon"


def shown(lines: DataFrame, *names: str) -> DataFrame:
    first, last = F.get("coords", 0), F.element_at("coords", -1)
    ends = {"start_lat": first["lat"], "start_lon": first["lon"], "end_lat": last["lat"], "end_lon": last["lon"]}
    return lines.select("way_id", "cell_lat", "cell_lon", *names, (F.size("coords")).cast("bigint").alias("n"), *(r(c, 7).alias(k) for k, c in ends.items()))


@query(f"""
    WITH {_CLIPPED}
    SELECT way AS way_id, cell_lat, cell_lon, CAST(run AS BIGINT) AS run, count(*) + 1 AS n, {_ENDS.format(y0='ay', x0='ax', y1='cy', x1='cx', k='s')} FROM runs GROUP BY ALL""")
def road_clip(spark, sf):
    return shown(noding.clip_to_cells(vertices(spark, sf), SIZE), "run")


@query(f"""
    WITH {_CLIPPED}, {_NODED}
    SELECT way AS way_id, cell_lat, cell_lon, CAST(run AS BIGINT) AS run, CAST(piece AS BIGINT) AS piece, count(*) + 1 AS n, {_ENDS.format(y0='py', x0='px', y1='qy', x1='qx', k='k')} FROM pieces GROUP BY ALL""")
def road_nodes(spark, sf):
    clipped = noding.clip_to_cells(vertices(spark, sf), SIZE)
    return shown(noding.node_lines(clipped, ["way_id", "cell_lat", "cell_lon", "run"], ["cell_lat", "cell_lon", "rd_name"]), "run", "piece")


@query(f"""
    WITH {_CLIPPED}, {_NODED},
    le AS (SELECT cell_lat, cell_lon, way % 9 AS g, sum({sql_haversine('py', 'px', 'qy', 'qx')} ORDER BY pos, k) AS len FROM pieces GROUP BY cell_lat, cell_lon, way, run, piece)
    SELECT cell_lat, cell_lon, 'R' || CAST(g AS VARCHAR) AS road_name, CAST(sum(CASE WHEN len < 15 THEN 1 ELSE greatest(1, CAST(round_even(len / 30, 0) AS BIGINT)) END) AS BIGINT) AS segments FROM le GROUP BY cell_lat, cell_lon, g""")
def road_cache(spark, sf):
    """Cells near a track that covers them all, built from map elements and written to the cache, read from there."""
    lines = vertices(spark, sf)
    kind = "map<string,string>"
    node = lambda i: F.col("way_id") * 3 + i
    nodes = lines.select("way_id", F.posexplode("coords").alias("i", "p")).select(
        F.lit("node").alias("type"), node(F.col("i")).alias("id"), "p.lat", "p.lon", F.lit(None).cast("array<bigint>").alias("nodes"), F.lit(None).cast(kind).alias("tags")
    )
    ways = lines.select(
        F.lit("way").alias("type"), F.col("way_id").alias("id"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"),
        F.array(*(node(i) for i in range(3))).alias("nodes"), F.create_map(F.lit("highway"), F.lit("residential"), F.lit("name"), F.col("rd_name")).alias("tags"),
    )
    cache = RoadCache(spark, scratch_path(spark, "cells"), size=SIZE, elements=lambda cells: nodes.unionByName(ways))
    points = lines.select(F.explode("coords").alias("p")).withColumn("d", F.explode(F.array(*(F.lit(d * SIZE) for d in (-1, 0, 1)))))  # the roads' cells and those beside them
    track = points.select((F.col("p.lat") + F.col("d")).alias("lat"), (F.col("p.lon") - F.col("d")).alias("lon"))
    cache.segments(track)
    return cache.stored().groupBy("cell_lat", "cell_lon", "road_name").agg(F.count("*").alias("segments"))
