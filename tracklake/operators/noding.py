"""Roads by grid cell: lines clipped to cells, and cut where lines of a group meet."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.operators.gps import whole_groups

#: Degrees within which a point lies on a line or is a vertex: a hundredth of a millimetre.
NEAR = 1e-10
#: Parts of an edge, as a share of it, that are too short to lie in a cell.
SLIVER = 1e-9
#: Degrees of the strips by which edges are ordered, so that those tried together lie together.
TILE = 0.002
#: Two points within ``NEAR`` of two edges are the ends of a part of each: such parts are no longer, in degrees, or the edges turn no more from each other (sine).
#: Of edges that cross, about one part in ten thousand is so short; nearly level ones tell the stretch where they lie together.
SHORT, SLANT = 5e-8, 2e-2
#: Pairs that are tried at a time, marks that are held at a time unless a line has more, rows that are given on at a time.
PAIRS, MARKS, ROWS = 1 << 17, 1 << 19, 1 << 16
#: Edges of a group for which there is a task more, and the most tasks of a group: each cuts its lines and holds the edges of all.
EDGES, TASKS = 1024, 64


def _point(lat: Column, lon: Column) -> Column:
    return F.struct(lat.alias("lat"), lon.alias("lon"))


def _let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """``body`` of a struct of values, each worked out once.

    Columns of their own would not do: filters on them are pushed below and
    carry whole expressions along.
    """
    return F.get(F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), body), 0)


def border(index: Column, size: float) -> Column:
    """The lower border of a grid cell, to ten digits: the same number from either side."""
    return F.rint(index * F.lit(size) * 1e10) / 1e10


def index(v: Column, size: float) -> Column:
    """The number of the cell whose lower border is the last at or below a coordinate; a billionth of a cell below it counts as on it."""
    return F.floor(v / F.lit(size) + 1e-9).cast("long")


def edges_of(lines: DataFrame, keep: Iterable[str]) -> DataFrame:
    """The edges of lines (``coords``) with their place ``at`` and ends ``a`` and ``b``."""
    n = F.size("coords") - 1
    ends = F.arrays_zip(F.slice("coords", F.lit(1), F.greatest(n, F.lit(0))).alias("a"), F.slice("coords", F.lit(2), F.greatest(n, F.lit(0))).alias("b"))
    return lines.select(*keep, F.posexplode(ends).alias("at", "e")).select(*keep, "at", *(_point(F.col(f"e.{p}.lat"), F.col(f"e.{p}.lon")).alias(p) for p in "ab"))


def through(edges: DataFrame, size: float, slack: float) -> DataFrame:
    """Each edge with the rows ``i`` and columns ``j`` of the grid that it passes: row by row, so a slanting edge costs what it passes."""
    (y0, x0), (y1, x1) = ((F.col(f"{p}.lat"), F.col(f"{p}.lon")) for p in "ab")
    span = lambda p, q, slack: _let({"l": F.least(p, q) - slack, "h": F.greatest(p, q) + slack}, lambda v: F.sequence(index(v["l"], size), index(v["h"], size)))
    rows = edges.withColumn("i", F.explode(span(y0, y1, F.lit(slack))))
    share = lambda y: F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(y - y0, y1 - y0))), F.lit(0.0))
    ends = {"s": share(border(F.col("i"), size)), "t": share(border(F.col("i") + 1, size))}
    tip = F.lit(slack) + F.abs(x1 - x0) * 1e-9
    columns = F.when(y0 == y1, span(x0, x1, tip)).otherwise(_let(ends, lambda e: span(x0 + e["s"] * (x1 - x0), x0 + e["t"] * (x1 - x0), tip)))
    return rows.withColumn("j", F.explode(columns))


def clip_to_cells(roads: DataFrame, size: float = 0.1, key: str = "way_id") -> DataFrame:
    """Lines clipped to the grid's cells: a row for each run of a line within a cell.

    A line's edges enter and leave cells on their own, by columns alone; the
    runs are gathered a line and cell at a time.  Where an edge meets a border
    the point is the same in both cells, and lies on the border exactly.  An
    edge along a border belongs to the cell north or east of it; a line that
    only touches a cell has no run there.

    Returns the columns of ``roads`` with new ``coords``, and ``cell_lat``,
    ``cell_lon`` (lower borders) and ``run``, the number of the run in its cell.
    """
    keep = [c for c in roads.columns if c != "coords"]
    parts = through(edges_of(roads, keep), size, 0.0)
    found = F.filter(F.array(_inside(size)), lambda p: p["here"] & (p["t"] - p["s"] > SLIVER))
    parts = parts.select(*keep, border(F.col("i"), size).alias("cell_lat"), border(F.col("j"), size).alias("cell_lon"), "at", F.explode(found).alias("p"))
    parts = parts.select(*keep, "cell_lat", "cell_lon", "at", F.col("p.s").alias("_s"), F.col("p.t").alias("_t"), "p.a", "p.b")
    place = [key, "cell_lat", "cell_lon"]
    line = Window.partitionBy(*place).orderBy("at", "_s")
    follows = (F.lag("at").over(line) == F.col("at") - 1) & (F.lag("_t").over(line) == 1.0) & (F.col("_s") == 0.0)
    parts = parts.withColumn("_new", (~F.coalesce(follows, F.lit(False))).cast("int"))
    parts = parts.withColumn("run", F.sum("_new").over(line) - 1)
    rest = [c for c in keep if c != key]
    runs = parts.groupBy(*place, "run").agg(*(F.first(c).alias(c) for c in rest), F.array_sort(F.collect_list(F.struct("at", "a", "b"))).alias("_e"))
    return runs.withColumn("coords", _joined("_e")).select(*keep, "coords", "cell_lat", "cell_lon", "run")


def _inside(size: float) -> Column:
    """The part of an edge in cell (``i``, ``j``): shares s and t where it begins and ends, the points there, and whether an edge along a border belongs ``here``."""
    i, j = F.col("i"), F.col("j")
    given = {
        "y": F.col("a.lat"), "x": F.col("a.lon"), "v": F.col("b.lat"), "u": F.col("b.lon"), "dy": F.col("b.lat") - F.col("a.lat"), "dx": F.col("b.lon") - F.col("a.lon"),
        "south": border(i, size), "north": border(i + 1, size), "west": border(j, size), "east": border(j + 1, size),
    }

    def cut(e: Column) -> Column:
        up = lambda d, low, high: F.when(e[d] > 0, e[low]).otherwise(e[high])
        doors = {"iny": up("dy", "south", "north"), "outy": up("dy", "north", "south"), "inx": up("dx", "west", "east"), "outx": up("dx", "east", "west")}
        return _let(doors, lambda d: _let({f"{k}{a}": F.when(e[f"d{a}"] != 0, F.try_divide(d[f"{k}{a}"] - e[a], e[f"d{a}"])) for k in ("in", "out") for a in "yx"}, lambda m: ends(e, d, m)))

    def ends(e: Column, d: Column, m: Column) -> Column:
        at = lambda t, k, a: F.when(t == m[f"{k}{a}"], d[f"{k}{a}"]).otherwise(e[a] + t * e[f"d{a}"])  # noqa: E731  on a border exactly
        here = ((e["dy"] != 0) | ((e["south"] <= e["y"]) & (e["y"] < e["north"]))) & ((e["dx"] != 0) | ((e["west"] <= e["x"]) & (e["x"] < e["east"])))
        start = lambda s: F.when(s > 0, _point(at(s, "in", "y"), at(s, "in", "x"))).otherwise(_point(e["y"], e["x"]))
        stop = lambda t: F.when(t < 1, _point(at(t, "out", "y"), at(t, "out", "x"))).otherwise(_point(e["v"], e["u"]))
        shares = {"s": F.greatest(F.lit(0.0), m["iny"], m["inx"]), "t": F.least(F.lit(1.0), m["outy"], m["outx"])}
        return _let(shares, lambda h: F.struct(here.alias("here"), h["s"].alias("s"), h["t"].alias("t"), start(h["s"]).alias("a"), stop(h["t"]).alias("b")))

    return _let(given, cut)


def _joined(edges: str) -> Column:
    """The vertices of edges in a row."""
    return F.concat(F.array(F.get(edges, 0)["a"]), F.transform(edges, lambda e: e["b"]))


def _meetings(x: np.ndarray, y: np.ndarray, joint: np.ndarray, of_first: bool) -> list[tuple[np.ndarray, ...]]:
    """The marks of pairs of edges on the first of each, or on the second: (pair, share, lat, lon).

    ``x`` and ``y`` have a row of (ax, ay, bx, by) for each pair, ``x`` that of the edge that comes first in order.
    ``joint``: they follow each other, and their common end is no meeting.
    """
    (ax, ay, bx, by), (cx, cy, dx, dy) = x.T, y.T
    ux, uy, vx, vy, rx, ry = bx - ax, by - ay, dx - cx, dy - cy, cx - ax, cy - ay
    nu, nv, den, side = np.sqrt(ux * ux + uy * uy), np.sqrt(vx * vx + vy * vy), ux * vy - uy * vx, rx * uy - ry * ux
    snap = lambda t, n: np.where(np.abs(t) * n <= NEAR, 0.0, np.where(np.abs(t - 1) * n <= NEAR, 1.0, t))
    within = lambda t: (t >= 0) & (t <= 1)
    level = np.abs(den) <= 1e-12 * nu * nv
    out = []

    def add(i: np.ndarray, t: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        good = within(t) & ~(joint[i] & (lat == by[i]) & (lon == bx[i]))
        out.append((i[good], t[good], lat[good], lon[good]))

    i = np.flatnonzero(~level)
    with np.errstate(over="ignore"):
        s, t = (rx * vy - ry * vx)[i] / den[i], side[i] / den[i]
    met = np.flatnonzero((np.abs(s - 0.5) * nu[i] <= 0.5 * nu[i] + 2 * NEAR) & (np.abs(t - 0.5) * nv[i] <= 0.5 * nv[i] + 2 * NEAR))  # most do not
    i, s, t = i[met], s[met], t[met]
    s, t = snap(s, nu[i]), snap(t, nv[i])
    met = within(s) & within(t)
    i, s, t = i[met], s[met], t[met]
    ends = [s == 0, s == 1, t == 0, t == 1]
    lat = np.select(ends, [ay[i], by[i], cy[i], dy[i]], np.rint((ay[i] + s * uy[i]) * 1e10) / 1e10)
    lon = np.select(ends, [ax[i], bx[i], cx[i], dx[i]], np.rint((ax[i] + s * ux[i]) * 1e10) / 1e10)
    add(i, s if of_first else t, lat, lon)
    i = np.flatnonzero(level)
    i = i[np.abs(side[i]) / nu[i] <= NEAR]  # in one line: the ends of each that lie on the other
    for qx, qy, ox, oy, wx, wy, n in ((cx, cy, ax, ay, ux, uy, nu), (dx, dy, ax, ay, ux, uy, nu)) if of_first else ((ax, ay, cx, cy, vx, vy, nv), (bx, by, cx, cy, vx, vy, nv)):
        along = ((qx[i] - ox[i]) * wx[i] + (qy[i] - oy[i]) * wy[i]) / (n[i] * n[i])
        add(i, snap(along, n[i]), qy[i], qx[i])
    return out


def _beside(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of edges that lie so near each other, over some length, that parts of both can have the same ends, and the shares between which they do, on the first and on the second."""
    (ax, ay, bx, by), (cx, cy, dx, dy) = x.T, y.T
    ux, uy, vx, vy = bx - ax, by - ay, dx - cx, dy - cy
    pairs = np.flatnonzero(np.square(ux * vy - uy * vx) <= SLANT**2 * (ux * ux + uy * uy) * (vx * vx + vy * vy))

    def stretch(e: np.ndarray, f: np.ndarray) -> np.ndarray:
        """Between which shares the second edge is within reach of the first one's line; the greater share comes first if it is nowhere."""
        u, r, q = e[:, 2:] - e[:, :2], f[:, :2] - e[:, :2], f[:, 2:] - e[:, :2]
        n = np.hypot(*u.T)
        c, d = (r[:, 0] * u[:, 1] - r[:, 1] * u[:, 0]) / n, (q[:, 0] * u[:, 1] - q[:, 1] * u[:, 0]) / n
        with np.errstate(divide="ignore", invalid="ignore"):
            ends = np.sort(np.column_stack([-10 * NEAR - c, 10 * NEAR - c]) / (d - c)[:, None], axis=1)
        ends[c == d] = np.where(np.abs(c[c == d]) <= 10 * NEAR, 0.0, 2.0)[:, None] + [0.0, 1.0]
        return np.column_stack([np.maximum(ends[:, 0], 0.0), np.minimum(ends[:, 1], 1.0)])

    s, t = stretch(y[pairs], x[pairs]), stretch(x[pairs], y[pairs])
    good = (s[:, 0] <= s[:, 1]) & (t[:, 0] <= t[:, 1])
    return pairs[good], s[good], t[good]


class Edges:
    """The edges of a group in order, which meet each other; equal ones are tried as one.

    ``e`` has a row of (ax, ay, bx, by) for each.
    """

    def __init__(self, e: np.ndarray, line: np.ndarray, at: np.ndarray, tile: float) -> None:
        self.e, self.columns, self.line, self.at, self.tile = e, np.ascontiguousarray(e.T), line, at, tile
        _, self.first, self.kind, self.count = np.unique(e + 0.0, axis=0, return_index=True, return_inverse=True, return_counts=True)
        self.kind = self.kind.reshape(-1)
        self.members = np.argsort(self.kind, kind="stable")  # of each kind, in order
        self.begins = np.concatenate([[0], np.cumsum(self.count)])
        self.last = self.members[self.begins[1:] - 1]
        self.own = self.columns[:, self.first]
        self.low, self.high = np.minimum(self.own[:2], self.own[2:]), np.maximum(self.own[:2], self.own[2:])

    def met(self, mine: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The marks of all edges on those numbered ``mine``, by blocks of pairs: (place in ``mine``, marks of (share, lat, lon), kinds).

        An edge with a near companion gets marks of -1 and the shares between
        which it is near; of these alone the kind of the companion is told.  A
        crossing is worked out from the edge that comes first, so one with equal
        edges before and after another can meet it at two points.
        """
        x = self.columns[:, mine]
        order = np.lexsort((x[0] + x[2], np.floor((x[1] + x[3]) / (2 * self.tile))))
        low, high = np.minimum(x[:2], x[2:]), np.maximum(x[:2], x[2:])
        k = 0
        while k < len(mine):
            b = order[k : k + 64]
            near = np.ones(len(self.first), bool)
            for c in (0, 1):
                near &= (self.low[c] <= high[c, b].max() + 10 * NEAR) & (self.high[c] >= low[c, b].min() - 10 * NEAR)
            near = np.flatnonzero(near)
            b = b[: max(1, PAIRS // max(1, len(near)))]
            k += len(b)
            over = np.ones((len(b), len(near)), bool)
            for c in (0, 1):
                over &= (low[c][b][:, None] <= self.high[c][near] + 10 * NEAR) & (self.low[c][near] <= high[c][b][:, None] + 10 * NEAR)
            i, j = np.nonzero(over)
            i, j = b[i], near[j]
            other = (self.kind[mine[i]] != j) | (self.count[j] > 1)
            i, j = i[other], j[other]
            p, q = x[:, i].T, self.own[:, j].T
            beside, s, _ = _beside(p, q)
            yield i[beside], np.column_stack([np.full(len(beside), -1.0), s]), j[beside]
            rank, first = mine[i], self.first[j]
            step = np.where((self.count[j] == 1) & (self.line[rank] == self.line[first]), self.at[first] - self.at[rank], 0)
            for of_first, some in ((True, rank < self.last[j]), (False, first < rank)):
                some = np.flatnonzero(some)
                u, v = x[:, i[some]].T, self.own[:, j[some]].T
                for pair, t, lat, lon in _meetings(u, v, step[some] == 1, True) if of_first else _meetings(v, u, step[some] == -1, False):
                    yield i[some[pair]], np.column_stack([t, lat, lon]), np.zeros(0, int)

    def marks(self, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All of them: places, marks, and pairs of a place and the kind of a near companion."""
        told = list(self.met(mine))
        place, marks = (np.concatenate([t[k] for t in told]) for k in (0, 1))
        pairs = np.column_stack([np.concatenate([t[0] for t in told if len(t[2])] or [np.zeros(0, int)]), np.concatenate([t[2] for t in told] or [np.zeros(0, int)])])
        return place, marks, pairs

    def passing(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which kinds pass both of two points (lat, lon), as (pair of points, kind)."""
        found = [(np.zeros(0, int), np.zeros(0, int))]
        ax, ay, bx, by = self.own
        ux, uy = bx - ax, by - ay
        n = np.hypot(ux, uy)
        step = max(1, PAIRS // max(1, len(n)))
        for k in range(0, len(low), step):
            over = np.ones((len(low[k : k + step]), len(n)), bool)
            for points in (low, high):
                y, x = points[k : k + step, 0, None], points[k : k + step, 1, None]
                over &= (self.low[0] <= x + 10 * NEAR) & (x <= self.high[0] + 10 * NEAR) & (self.low[1] <= y + 10 * NEAR) & (y <= self.high[1] + 10 * NEAR)
            i, j = np.nonzero(over)
            for points in (low, high):
                y, x = points[k + i, 0], points[k + i, 1]
                good = np.abs((x - ax[j]) * uy[j] - (y - ay[j]) * ux[j]) <= 10 * NEAR * n[j]
                i, j = i[good], j[good]
            found.append((k + i, j))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def repeated(self, mine: np.ndarray, p: dict[str, np.ndarray], pairs: np.ndarray) -> np.ndarray:
        """Which parts of ``mine`` an edge that comes first has, too, in either direction.

        Only suspects are compared, with those of the edges beside them, or that
        pass both ends of a short one; equal edges after the first are asked
        only where the first has not the part.
        """
        gone, some = np.zeros(len(p["edge"]), bool), np.flatnonzero(p["suspect"])
        if not len(some):
            return gone
        short = some[np.hypot(*(p["b"][some] - p["a"][some]).T) <= SHORT]
        part, kind = self.passing(p["a"][short], p["b"][short])
        pairs = np.concatenate([pairs, np.column_stack([p["edge"][short[part]], kind])])
        mine_ends, ends, rank = _ends(p, some), [], []
        asked = np.zeros(0, int)
        for k in (0, 1):
            left = np.bincount(p["edge"][some[~gone[some]]], minlength=len(mine)) > 0
            pairs = np.unique(pairs[left[pairs[:, 0]]], axis=0)
            if k == 0:
                need = self.first[pairs[:, 1]][self.first[pairs[:, 1]] < mine[pairs[:, 0]]]
            else:
                latest = np.zeros(len(self.first), int)
                np.maximum.at(latest, pairs[:, 1], mine[pairs[:, 0]])
                need = np.concatenate([m[m < latest[j]] for j in np.flatnonzero(latest).tolist() if len(m := self.members[self.begins[j] + 1 : self.begins[j + 1]])] or [need[:0]])
            others = np.setdiff1d(np.unique(need), np.concatenate([mine, asked]))
            for i in range(0, len(others), 64):
                ask = others[i : i + 64]
                place, marks, _ = self.marks(ask)
                o = _cut(np.arange(len(ask)), *_both(self.e[ask]), place, marks)
                their = np.flatnonzero(o["suspect"])
                ends.append(_ends(o, their))
                rank.append(ask[o["edge"][their]])
            asked = np.concatenate([asked, others])
            if k == 0 or len(others):
                gone[some] = _later(np.concatenate([mine_ends, *ends]), np.concatenate([mine[p["edge"][some]], *rank]))[: len(some)]
        return gone


def _both(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both ends of edges, as (lat, lon)."""
    return e[:, 1::-1], e[:, 3:1:-1]


def _ends(p: dict[str, np.ndarray], some: np.ndarray) -> np.ndarray:
    """The ends of parts, the lower one first."""
    a, b = p["a"][some], p["b"][some]
    turned = (a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] > b[:, 1]))
    return np.where(turned[:, None], np.column_stack([b, a]), np.column_stack([a, b])) + 0.0


def _later(ends: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which rows have the ends of another one of lower rank; rows are ordered by a hash, and by all ends should two share it."""
    bits = np.ascontiguousarray(ends).view("u8")
    h = np.zeros(len(bits), "u8")
    for c in bits.T:
        h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.lexsort((rank, h))
    same = (ends[order[1:]] == ends[order[:-1]]).all(1)
    if (same != (h[order[1:]] == h[order[:-1]])).any():
        order = np.lexsort((rank, *ends.T))
        same = (ends[order[1:]] == ends[order[:-1]]).all(1)
    out = np.zeros(len(rank), bool)
    out[order[1:][same]] = True
    return out


def _met_in_tile(e: np.ndarray, line: np.ndarray, at: np.ndarray, tile: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The marks of edges on each other, by blocks of pairs: (edge, marks of (share, lat, lon)), as ``Edges.met`` has them."""
    for edge, marks, _ in Edges(e[:, :4], line, at, tile).met(np.arange(len(e))):
        yield edge, marks


def _strings_differ(c: pa.ChunkedArray) -> np.ndarray:
    """Whether each entry differs from the one before."""
    v = c.to_numpy()
    return np.concatenate([[True], v[1:] != v[:-1]]) if len(v) else np.zeros(0, bool)


def _doubles(c: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of binary entries one after another, and how many each has; null has none."""
    parts = [x for x in c.chunks if len(x)]
    sizes = [pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False) for x in parts]
    held = [np.frombuffer(b"".join(v for v in x.to_pylist() if v), "<f8").reshape(-1, 3) for x in parts]
    return (np.concatenate(held), np.concatenate(sizes) // 24) if parts else (np.zeros((0, 3)), np.zeros(0, int))


def _parts(whole: pa.Table) -> dict[str, np.ndarray]:
    """The parts between the marks of whole lines' edges, in order; rows are an edge (``_marks`` null), then its marks."""
    is_edge = whole.column("_marks").is_null().to_numpy()
    rows = np.flatnonzero(is_edge)
    line = np.cumsum(_strings_differ(whole.column("_l"))[rows] if len(rows) else np.zeros(0, int)) - 1
    a, b = (np.column_stack([whole.column(f"_{e}{c}").to_numpy()[rows] for c in "yx"]) for e in "ab")
    marks, counts = _doubles(whole.column("_marks"))
    p = _cut(line, a, b, np.repeat(np.cumsum(is_edge) - 1, counts), marks)
    return p | {"row": rows[p["edge"]]}


def _cut(line: np.ndarray, a: np.ndarray, b: np.ndarray, owner: np.ndarray, marks: np.ndarray) -> dict[str, np.ndarray]:
    """The parts between the marks of edges, in order; ``line`` is each edge's line, ``owner`` each mark's edge."""
    n = len(line)

    def has(t: float) -> np.ndarray:
        out = np.zeros(n, bool)
        out[owner[marks[:, 0] == t]] = True
        return out

    starts, ends = has(0.0), has(1.0)
    inner = (marks[:, 0] > 0) & (marks[:, 0] < 1)
    edge = np.concatenate([np.arange(n), owner[inner], np.arange(n)])
    t = np.concatenate([np.full(n, -1.0), marks[inner, 0], np.full(n, 2.0)])
    p = np.concatenate([a, marks[inner, 1:], b])
    order = _along(edge, t, p)
    edge, t, p = edge[order], t[order], p[order]
    kept = _first_of_each(edge, p)
    edge, t, p = edge[kept], t[kept], p[kept]
    same = edge[1:] == edge[:-1]
    first = np.flatnonzero(same)
    edge = edge[first]
    begins = np.concatenate([[True], edge[1:] != edge[:-1]]) if len(edge) else np.zeros(0, bool)
    k = np.arange(len(edge)) - np.repeat(np.flatnonzero(begins), np.diff(np.append(np.flatnonzero(begins), len(edge))))
    last = np.append(begins[1:], True) if len(edge) else begins
    a, b = p[first], p[first + 1]
    t = np.clip(t, 0.0, 1.0)
    near = marks[:, 0] < 0  # parts within a stretch where another edge is near: those from ``low`` up to ``high``
    low = np.searchsorted(edge + t[first], owner[near] + marks[near, 1] - 1e-9, side="left")
    high = np.searchsorted(edge + t[first + 1], owner[near] + marks[near, 2] + 1e-9, side="right")
    some = low < high
    beside = np.cumsum(np.bincount(low[some], minlength=len(edge) + 1) - np.bincount(high[some], minlength=len(edge) + 1))[:-1] > 0
    close = np.hypot(*(b - a).T) <= SHORT
    return {"edge": edge, "line": line[edge], "k": k, "a": a, "b": b, "cut": starts[edge] | ~begins, "done": ends[edge] | ~last, "suspect": beside | close}


def _along(edge: np.ndarray, t: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The order of points by edge, share, latitude and longitude; shares go from -1 to 2.

    One number of edge and share orders nearly all of them; those that share it are put in order by the rest.
    """
    bits = min(50, 62 - int(edge.max(initial=0)).bit_length())  # of a share
    key = (edge.astype("i8") << bits) + ((t + 1.0) * (1 << bits - 2)).astype("i8")
    order = np.argsort(key)
    same = key[order]
    same = same[1:] == same[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    some = order[tied]
    order[tied] = some[np.lexsort((p[some, 1], p[some, 0], t[some], edge[some]))]
    return order


def _first_of_each(edge: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which of an edge's points, in order along it, are there for the first time; repeats lie within a run of points that nearly coincide."""
    if not len(p):
        return np.zeros(0, bool)
    kept = np.ones(len(p), bool)
    near = (edge[1:] == edge[:-1]) & (np.abs(p[1:] - p[:-1]).max(1) <= 100 * NEAR)
    kept[1:] = ~(near & (p[1:] == p[:-1]).all(1))
    twice = np.flatnonzero(near[1:] & near[:-1])  # of three or more in a run, others may lie between equal ones
    at = -1
    for s in twice.tolist():
        if s < at:
            continue
        at, seen = s, set()
        while at < len(p) and (at == s or near[at - 1]):
            place = (p[at, 0], p[at, 1])
            kept[at] = place not in seen
            seen.add(place)
            at += 1
    return kept


#: Lines as points (lat, lon) one after another and the places where each begins, the last one's end added, to rows: the line that each is of, and its columns.
Shape = Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, list[pa.Array]]]]

_COORDS = T.StructType([T.StructField("coords", T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("lat", "lon")])))])


def _whole(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, list[pa.Array]]]:
    """A row for each line, with its points."""
    yield np.arange(len(offsets) - 1), [pa.ListArray.from_arrays(pa.array(offsets.astype("i4")), pa.StructArray.from_arrays([pa.array(c) for c in points.T], ["lat", "lon"]))]


def node_lines(lines: DataFrame, key: list[str], group: list[str], tile: float = TILE, keep: list[str] | None = None, shape: Shape = _whole, adds: T.StructType = _COORDS) -> DataFrame:
    """Lines cut at every point where lines of their group meet; what coincides stays once.

    ``key`` names a line, ``group`` the lines that see each other (null is a
    value).  Lines meet where edges cross, where a vertex lies on another edge,
    and at vertices that they share; a line meets itself, too, but not at the
    vertices where its edges follow each other.  Edges that lie in one another
    are cut at each other's ends.  Of parts with the same ends, in either
    direction, the first by key and place stays.

    A task cuts some lines of a group and holds the edges of all, ordered by
    place, so edges try those near them in blocks; a large group has more tasks,
    and edges are all that is shuffled.  Marks, which can be many times the
    edges, are found on either side of a pair and stay in the task, some lines'
    at a time.  Only parts that can have the ends of another, since they are very
    short or their edge nearly lies in another one, are compared across lines:
    the task cuts those edges, too.
    Returns the columns of ``lines`` (or ``keep`` of them) with new ``coords``,
    and ``piece``.  Lines of fewer than two vertices, or of no length, go.
    ``shape`` makes other rows of the pieces where they are found, with the
    columns ``adds`` in place of ``coords``: pieces can be many times the lines,
    and costly to carry as lists of points.
    """
    keep = [c for c in lines.columns if c != "coords"] if keep is None else keep
    carry = list(dict.fromkeys([*key, *group, *keep]))
    text = lambda names: F.to_json(F.struct(*(F.col(c).cast("string") for c in names)), {"ignoreNullFields": "false"})
    ends = {f"_{e}{c}": F.col(f"{e}.{name}") for e in "ab" for c, name in (("x", "lon"), ("y", "lat"))}
    placed = lines.withColumn("_h", F.xxhash64(F.get("coords", 0)["lat"], F.get("coords", 0)["lon"]))  # lines that begin together are cut by one task
    edges = edges_of(placed, [*carry, "_h"]).filter("a <> b").withColumns({"_g": text(group), "_l": text(key)})
    sizes = edges.groupBy("_g").agg(F.least(F.lit(TASKS), F.ceil(F.count("*") / EDGES)).cast("int").alias("_c"))
    dealt = edges.join(sizes, "_g").withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
    mine = (F.pmod("_h", "_c") == F.col("_k")).alias("_own")
    dealt = dealt.select(F.concat_ws("|", "_k", "_g").alias("_t"), mine, "_l", "at", *dict.fromkeys([*key, *keep]), *(c.alias(k) for k, c in ends.items()))
    kinds = {f.name: f.dataType for f in dealt.schema.fields}
    fields = T.StructType([*(T.StructField(c, kinds[c]) for c in keep), T.StructField("piece", T.LongType()), *adds.fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(whole: pa.Table, bounds: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            for i, j in bounds:
                yield from _noded(whole.slice(i, j - i).combine_chunks(), tile, keep, shape, adds.names)

        return whole_groups(batches, "_t", done)

    session = lines.sparkSession
    parts = 4 * max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)  # edges are few bytes for what is made of them
    return dealt.repartition(parts, "_t").sortWithinPartitions("_t", *key, "at").mapInArrow(cut, fields)


def _noded(edges: pa.Table, tile: float, keep: list[str], shape: Shape, adds: list[str]) -> Iterator[pa.RecordBatch]:
    """The pieces of a group's lines that are the task's own, as rows by ``shape``; ``edges`` are those of the whole group in order."""
    own = np.flatnonzero(edges.column("_own").to_numpy())
    if not len(own):
        return
    line, at = np.cumsum(_strings_differ(edges.column("_l"))), edges.column("at").to_numpy()
    group = Edges(np.column_stack([edges.column(c).to_numpy() for c in ("_ax", "_ay", "_bx", "_by")]), line, at, tile)
    first = np.flatnonzero(np.concatenate([[True], line[own][1:] != line[own][:-1]]))
    size = np.diff(np.append(first, len(own)))
    x, y = group.columns[:2, own[first]]
    order = np.lexsort((group.kind[own[first]], x, np.floor(y / tile)))
    i, take = 0, 16
    while i < len(order):
        some = order[i : i + take]
        n = size[some]
        mine = own[np.repeat(first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        place, marks, pairs = group.marks(mine)
        p = _cut(np.repeat(np.arange(len(some)), n), *_both(group.e[mine]), place, marks)
        yield from _pieces(edges, mine, p, group.repeated(mine, p, pairs), keep, shape, adds)
        i += take
        take = max(1, min(4 * take, MARKS * len(some) // max(1, len(marks))))


def _pieces(edges: pa.Table, mine: np.ndarray, p: dict[str, np.ndarray], gone: np.ndarray, keep: list[str], shape: Shape, adds: list[str]) -> Iterator[pa.RecordBatch]:
    """Whole lines' parts, without those that are gone, joined to pieces up to the next cut; rows of them by ``shape``."""
    row, line, a, b, cut, done = (x[~gone] for x in (mine[p["edge"]], *(p[c] for c in ("line", "a", "b", "cut", "done"))))
    if not len(row):
        return
    fresh = np.concatenate([[True], line[1:] != line[:-1]])
    new = cut | fresh
    new[1:] |= done[:-1] | (b[:-1] != a[1:]).any(1)
    at = np.flatnonzero(new)
    count = np.cumsum(new)
    first = count[fresh]
    piece = count[at] - np.repeat(first, np.diff(np.append(first, count[-1] + 1)))
    # of each piece the first vertex, then the ends of its parts
    size = np.diff(np.append(at, len(row))) + 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    coords = np.empty((offsets[-1], 2))
    coords[offsets[:-1]] = a[at]
    coords[np.arange(len(row)) + count] = b
    for i in range(0, len(at), ROWS):
        j = min(len(at), i + ROWS)
        for of, columns in shape(coords[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
            same = edges.select(keep).take(row[at[i:j]][of])
            yield from pa.table([*same.columns, pa.array(piece[i:j][of]), *columns], names=[*keep, "piece", *adds]).combine_chunks().to_batches()


#: Lines that are united with each other: of one cell, class, name, direction and kind.
GROUP = ("rd_type", "rd_name", "oneway", "cluster", "service")


def node_cells(lines: DataFrame, keep: list[str] | None = None, shape: Shape = _whole, adds: T.StructType = _COORDS) -> DataFrame:
    """Clipped, clustered roads noded within their cell and group; other arguments are those of ``node_lines``."""
    cells = ["cell_lat", "cell_lon"]
    return node_lines(lines, ["way_id", *cells, "run"], [*cells, *(c for c in GROUP if c in lines.columns)], keep=keep, shape=shape, adds=adds)
