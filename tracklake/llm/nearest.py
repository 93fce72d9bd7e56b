"""Nearest neighbours by collision counting over projections."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialize

#: Projections, the share of them that must collide, and the growth of the windows.
PROJECTIONS, THRESHOLD, GROWTH = 24, 0.75, 1.25
NEED = int(np.ceil(THRESHOLD * PROJECTIONS))
#: Numbers in a block of the index.
BLOCK = 1 << 20
#: Leaves of a tree, and rows and numbers of the sample that it is fitted on, at most;
#: lengths of vectors that have a tree, at most (other lengths are one leaf each).
LEAVES, SAMPLE_ROWS, SAMPLE_NUMBERS, TREES = 256, 4096, 1 << 19, 8
#: A search ends when its k-th distance is within this many window half-widths.
#: A vector at that distance then collides in 0.89 of the projections on average
#: (a normal value within 1 / REACH), well over the threshold.
REACH = 0.62
#: Steps of a window's growth, after which all that is left of a block is verified.
STEPS = 200
#: Projected values stay within this bound, so that windows are always finite.
FAR = 1e100


@functools.lru_cache(16)
def lines(dim: int) -> np.ndarray:
    return np.random.default_rng([11, dim]).standard_normal((dim, PROJECTIONS))


def projected(v: np.ndarray, scale: float) -> np.ndarray:
    """Values of vectors on each line, in units of ``scale``; huge and tiny numbers neither overflow nor vanish on the way."""
    top = np.abs(v).max(axis=1, keepdims=True)
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        p = (v / top) @ lines(v.shape[1]) * (top / scale)
    return np.clip(np.nan_to_num(p, nan=0.0, posinf=FAR, neginf=-FAR), -FAR, FAR)


def slack(p: np.ndarray) -> np.ndarray:
    """What projected values of one vector may differ by, as sums are rounded in another order in another batch."""
    return 1e-9 * (1.0 + np.abs(p))


def distances(v: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; where squares overflow or vanish they are taken in units of the largest difference."""
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        d = v - query
        out = np.sqrt(np.square(d).sum(axis=1))
        odd = ~(np.isfinite(out) & (out > 1e-150))
        if odd.any():
            top = np.abs(d[odd]).max(axis=1)
            top[~np.isfinite(top) | (top == 0)] = 1.0
            out[odd] = top * np.sqrt(np.square(d[odd] / top[:, None]).sum(axis=1))
    return out


@dataclass
class Tree:
    """Splits of the projected space, fitted on a sample; leaf numbers are global, so near vectors share blocks."""

    scale: float = 1.0
    depth: int = 0
    axis: np.ndarray | None = None
    cut: np.ndarray | None = None

    @classmethod
    def fit(cls, v: np.ndarray, leaves: int) -> Tree:
        scale = float(np.median(np.abs(v).max(axis=1)))
        p, depth = projected(v, scale), max(0, leaves.bit_length() - 1)
        axis, cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
        parts = [p]
        for node in range(len(axis)):
            part = parts[node]
            if len(part):
                low, high = np.quantile(part, (0.25, 0.75), axis=0)
                axis[node] = np.argmax(high - low)
                cut[node] = np.median(part[:, axis[node]])
            right = part[:, axis[node]] > cut[node]
            parts += [part[~right], part[right]]
        return cls(scale, depth, axis, cut)

    def leaf(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (p[np.arange(len(p)), self.axis[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)


class BlockIndex:
    """One block of vectors: for each projection a sorted array of values and whose they are."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, values: np.ndarray) -> None:
        self.ids, self.vectors, self.order, self.values = ids, vectors, order, values
        n = len(ids)
        spread = float(np.median(values[:, 3 * n // 4] - values[:, n // 4])) / 32
        spread = spread or float(np.median(values[:, -1] - values[:, 0])) / 64
        self.width = spread or 1.0

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, scale: float, copies: int | None = None) -> BlockIndex:
        """Sort the projections; of identical vectors keep the ``copies`` smallest ids, the only ones that answers can hold."""
        p = projected(vectors, scale)
        if copies is not None:
            near = np.argsort(p[:, 0], kind="stable")
            same = np.flatnonzero(p[near[1:], 0] - p[near[:-1], 0] <= slack(p[near[1:], 0]))
            some = np.unique(np.concatenate((near[same], near[same + 1])))
            if len(some) > copies:
                _, group = np.unique(np.array([r.tobytes() for r in vectors[some] + 0.0], dtype=object), return_inverse=True)
                by = np.lexsort((ids[some], group))
                first = np.searchsorted(group[by], group[by], side="left")
                keep = np.ones(len(ids), bool)
                keep[some[by[np.arange(len(by)) - first >= copies]]] = False
                ids, vectors, p = ids[keep], vectors[keep], p[keep]
        order = np.argsort(p, axis=0, kind="stable").T.astype(np.int32)
        return cls(ids, vectors, order, np.take_along_axis(p.T, order, axis=1))

    def search(self, own: int, query: np.ndarray, scale: float, k: int, bound: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact distances of the k nearest found, nearest first, ties to the smaller id.

        A window around the query's value grows in each projection (virtual
        rehashing); a vector that falls into enough of the windows is verified.
        Where ``bound``, a k-th distance known from another block, is given, the
        windows have the width that belongs to it at once.  After ``STEPS``
        steps, or once the windows cover all, every vector is verified, so the
        search always ends.
        """
        n = len(self.ids)
        centre = projected(query[None, :], scale)[0]
        hits = np.zeros(n, np.int32)
        seen = self.ids == own
        a = b = np.array([np.searchsorted(v, c) for v, c in zip(self.values, centre, strict=True)])
        half = self.width if np.isinf(bound) else bound / scale / REACH
        ids, dist = np.empty(0, self.ids.dtype), np.empty(0)
        for step in range(STEPS + 1):
            low, high = centre - half - slack(centre), centre + half + slack(centre)
            a2 = np.array([np.searchsorted(v, c, "left") for v, c in zip(self.values, low, strict=True)])
            b2 = np.array([np.searchsorted(v, c, "right") for v, c in zip(self.values, high, strict=True)])
            a2, b2 = np.minimum(a2, a), np.maximum(b2, b)
            new = [o[i:j] for o, i, j in zip(self.order, a2, a, strict=True)]
            new += [o[i:j] for o, i, j in zip(self.order, b, b2, strict=True)]
            hits += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
            a, b = a2, b2
            over = step == STEPS or (a.max() == 0 and b.min() == n)
            at = np.flatnonzero(~seen if over else (hits >= NEED) & ~seen)
            if len(at):
                seen[at] = True
                d = distances(self.vectors[at], query)
                ids, dist = np.concatenate((ids, self.ids[at])), np.concatenate((dist, d))
                best = np.lexsort((ids, dist))[:k]
                ids, dist = ids[best], dist[best]
            if over or not np.isinf(bound) or (len(dist) == k and dist[-1] <= REACH * half * scale):
                break
            half *= GROWTH
        close = dist <= bound
        return ids[close], dist[close]


def _usable(vector: Column) -> Column:
    """No null, zero or non-finite vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def _place(trees: dict[int, Tree]):
    """Give each vector its leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            leaf, v = np.zeros(len(dims), np.int32), np.empty(len(dims), object)
            flat, ends = batch.column("v").flatten().to_numpy(), np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                rows = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                v[at] = [r.tobytes() for r in rows]
                if dim in trees:
                    leaf[at] = trees[dim].leaf(projected(rows, trees[dim].scale))
            cols = [batch.column(c) for c in ("id", "dim", "q", "salt")]
            yield pa.record_batch([*cols, pa.array(leaf), pa.array(v, pa.binary())], names=["id", "dim", "q", "salt", "leaf", "v"])

    return run


def _build(trees: dict[int, Tree], copies: int):
    """One row for each block: its ids, vectors and sorted projections in binary, and the projections' bounds."""

    def run(frame: pa.Table) -> pa.Table:
        dim = frame.column("dim")[0].as_py()
        ids = frame.column("id").to_numpy().astype(np.int64)
        v = np.frombuffer(b"".join(frame.column("v").to_pylist())).reshape(-1, dim)
        made = BlockIndex.build(ids, v, trees.get(dim, Tree()).scale, copies)
        cols = {c: frame.column(c)[:1] for c in ("dim", "leaf", "block")}
        for name, x in (("ids", made.ids), ("v", made.vectors), ("places", made.order), ("values", made.values)):
            cols[name] = pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
        for name, k in (("low", 0), ("high", -1)):
            cols[name] = pa.array([made.values[:, k].tolist()], pa.list_(pa.float64()))
        return pa.table(cols)

    return run


_BLOCK = "dim int, leaf int, block long, ids binary, v binary, places binary, values binary, low array<double>, high array<double>"


def _answer(trees: dict[int, Tree], k: int):
    """Answer queries from blocks; rows come sorted, so that each block is followed by the queries that it is asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, key, scale = None, None, 1.0
        for batch in batches:
            salt, query, found, score = [], [], [], []
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "leaf", "block")), strict=True))
            asked, own, row_salt, bound = (batch.column(c).to_pylist() for c in ("asks", "id", "salt", "bound"))
            for i, ask in enumerate(asked):
                v = np.frombuffer(batch.column("v")[i].as_py()).reshape(-1, keys[i][0])
                if not ask:
                    ids, order, values = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("ids", np.int64), ("places", np.int32), ("values", float)))
                    key, block = keys[i], BlockIndex(ids, v, order.reshape(PROJECTIONS, -1), values.reshape(PROJECTIONS, -1))
                    scale = trees.get(key[0], Tree()).scale
                elif keys[i] == key:
                    ids, dist = block.search(own[i], v[0], scale, k, bound[i])
                    salt += [row_salt[i]] * len(ids)
                    query += [own[i]] * len(ids)
                    found.append(ids)
                    score.append(dist)
            if found:
                cols = [pa.array(salt, pa.int64()), pa.array(query, pa.int64()), pa.array(np.concatenate(found)), pa.array(np.concatenate(score))]
                yield pa.record_batch(cols, names=["salt", "query_id", "id", "score"])

    return run


def _visits(trees: dict[int, Tree], bounds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """The leaves that a query must visit: those whose bounds its windows meet in enough projections to collide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, limit = batch.column("dim").to_numpy(), batch.column("bound").to_numpy()
            at, leaf = [], []
            for i, (dim, r) in enumerate(zip(dims.tolist(), limit.tolist(), strict=True)):
                if dim not in bounds:
                    at.append(i)
                    leaf.append(0)
                    continue
                number, low, high = bounds[dim]
                scale = trees[dim].scale
                c = projected(np.frombuffer(batch.column("v")[i].as_py())[None, :], scale)
                half = r / scale / REACH + slack(c)
                go = number[((low - half <= c) & (high + half >= c)).sum(axis=1) >= NEED]
                at += [i] * len(go)
                leaf += go.tolist()
            cols = batch.take(pa.array(at, pa.int64()))
            yield pa.record_batch([*cols.columns, pa.array(leaf, pa.int32())], names=[*cols.schema.names, "leaf"])

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For each query row its ``k`` nearest other rows by Euclidean distance.

    Vectors are projected on a few lines.  A tree over the projected values,
    fitted on a bounded sample, gives every vector a leaf; a leaf is cut by a
    hash of the row into blocks of bounded size, each of which is indexed once:
    a sorted array for each line.  A query first asks one block of its own leaf,
    where windows grow around it.  The k-th distance found there bounds its
    windows elsewhere: it then visits only leaves that its windows meet in
    enough projections for anything there to collide.  Queries travel to
    blocks; a block is shuffled once a round, and its queries stream past it.
    The few best of each block are merged.

    Of identical vectors in a block only the ``k + 1`` smallest ids are kept, as
    no answer can hold another; every row takes part in that choice.

    Returns ``query_id``, ``rank`` from 1, ``id_col`` and ``score``, the exact
    distance in double precision (infinite beyond its range).  Vectors that are
    null, empty, zero or hold null or non-finite numbers take no part, nor do
    rows without an id; vectors of different lengths do not meet.  Rows that
    repeat an id are queries and candidates each, but not of each other.  Fewer
    than ``k`` candidates give fewer rows, an empty table none.  Other columns,
    whatever their names, are ignored.
    """
    v = column(vector_col)
    rows = vectors.filter(column(id_col).isNotNull() & _usable(v)).select(
        column(id_col).cast("long").alias("id"), F.size(v).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("q"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"), F.transform(v, lambda x: x.cast("double")).alias("v"),
    )
    trees = {}
    for dim, n in rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(TREES).collect():
        leaves = min(LEAVES, max(1, n * dim // BLOCK))
        some = min(SAMPLE_ROWS, max(64, SAMPLE_NUMBERS // dim))
        sample = rows.filter(F.col("dim") == dim).orderBy(F.xxhash64("id", "v")).limit(some).select("v").collect()
        trees[dim] = Tree.fit(np.array([r.v for r in sample], float), leaves)
    placed = materialize(rows.mapInArrow(_place(trees), "id long, dim int, q boolean, salt long, leaf int, v binary"), "vectors")
    leaf = ["dim", "leaf"]
    blocks = F.greatest(F.lit(1), F.ceil(F.count("*") * F.col("dim") / BLOCK)).cast("long")
    leaves = materialize(placed.groupBy(*leaf).agg(blocks.alias("blocks")), "leaves")  # one row for each leaf
    own_block = F.pmod("salt", "blocks").alias("block")
    dealt = placed.join(leaves, leaf).select("id", "dim", "leaf", "v", own_block)
    index = materialize(dealt.groupBy(*leaf, "block").applyInArrow(_build(trees, k + 1), _BLOCK), "index")
    total = max(1, leaves.agg(F.sum("blocks")).first()[0] or 0)

    def ask(queries: DataFrame) -> DataFrame:
        """Answers of blocks to queries (dim, leaf, block, id, salt, v, bound)."""
        left = index.drop("low", "high").withColumns({"asks": F.lit(False), "id": F.lit(None).cast("long"), "salt": F.lit(None).cast("long"), "bound": F.lit(None).cast("double")})
        both = left.unionByName(queries.withColumn("asks", F.lit(True)), allowMissingColumns=True)
        met = both.repartition(2 * total, *leaf, "block").sortWithinPartitions(*leaf, "block", "asks")
        return met.mapInArrow(_answer(trees, k), "salt long, query_id long, id long, score double")

    queries = placed.filter("q").select("id", "dim", "leaf", "salt", "v")
    home = queries.join(leaves, leaf).select("id", "dim", "leaf", "salt", "v", own_block, F.lit(float("inf")).alias("bound"))
    first = materialize(ask(home), "first-answers")
    reached = first.groupBy("salt").agg(F.when(F.count("*") >= k, F.max("score")).alias("bound"))
    edge = [f(F.col(c)[j]).alias(f"{c}{j}") for c, f in (("low", F.min), ("high", F.max)) for j in range(PROJECTIONS)]
    bounds = {}
    of_leaf = index.filter(F.col("dim").isin(*trees)).groupBy(*leaf).agg(*edge).orderBy(*leaf).collect()  # TREES * LEAVES rows at most
    for dim in {r.dim for r in of_leaf}:
        own = [r for r in of_leaf if r.dim == dim]
        low, high = (np.array([[r[f"{c}{j}"] for j in range(PROJECTIONS)] for r in own]) for c in ("low", "high"))
        bounds[dim] = (np.array([r.leaf for r in own]), low, high)
    known = queries.withColumnRenamed("leaf", "home").join(reached, "salt", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    known = known.select("id", "dim", "home", "salt", "v", "bound")
    visits = known.mapInArrow(_visits(trees, bounds), "id long, dim int, home int, salt long, v binary, bound double, leaf int")
    visits = visits.join(leaves, leaf).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    visits = visits.filter((F.col("leaf") != F.col("home")) | (F.col("block") != F.pmod("salt", "blocks"))).drop("home", "blocks")
    best = Window.partitionBy("query_id", "salt").orderBy("score", "id")
    return (
        first.unionByName(ask(visits))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
