"""Whitening of embeddings by randomised principal components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialize

#: Components that are returned, random directions beyond them, and power passes over all rows.
COMPONENTS, OVERSAMPLE, PASSES = 32, 10, 2
#: A component's residual against its eigenvalue, beyond which the basis grows to all dimensions.
RESIDUAL = 1e-12
#: An eigenvalue this small against the largest is no variance but rounding.
RANK = 1e-12
#: Sums that one task adds up in a round of the tree.
FAN = 16
#: The largest entry whose scaled floor a double still holds exactly.
LARGEST = 2.0**46
HALF = 26
SEED = 12


@dataclass(frozen=True)
class Whitening:
    """Rows n and sums S of the fit list, components as columns, their eigenvalues and the trace of the covariance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S/n, the whole part taken off in whole numbers, so that nothing is rounded but the rest."""
    near, rest = _near(x, n, sums)
    return near - np.array([r / n for r in rest])


def _near(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, list[int]]:
    """x less whole numbers beside the mean, and n times what the mean is over them."""
    whole = [(s + n // 2) // n for s in sums]
    return x - np.array(whole, np.int64), [s - n * m for s, m in zip(sums, whole, strict=True)]


def usable(df: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    """``vec_id`` and ``x``, the entries as whole numbers floor(64 c) + 1000000, of rows whose vector is whole.

    Vectors that are null or hold null, non-finite or beyond-2^46 entries are
    left out, and so are those of another length than the commonest (of two as
    common, the longer).
    """
    entry = F.transform(column(vector_col), lambda c: c.cast("double"))
    fit = F.coalesce(F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= LARGEST), F.lit(False))), F.lit(False))
    rows = df.select(column(id_col).alias("vec_id"), entry.alias("v")).filter(fit).filter(F.size("v") > 0)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return rows.filter(F.size("v") == d).select("vec_id", F.transform("v", lambda c: F.floor(c * 64).cast("long") + 1_000_000).alias("x"))


def _matrix(column_: pa.ChunkedArray | pa.Array, kind) -> np.ndarray:
    flat = pc.list_flatten(column_).to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column_), -1)


def added(df: DataFrame, partial: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str = "f8") -> np.ndarray:
    """The sum of ``partial`` over all rows of x, each task's part added up in a tree of tasks.

    A task sends on one array of the given shape, however many rows it has, and
    no task, nor the driver, takes more than ``FAN`` of them at a time.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            if batch.num_rows:
                total += partial(_matrix(batch.column("x"), np.int64))
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape, kind), False
        for batch in batches:
            for p in batch.column("part"):
                total, some = total + np.frombuffer(p.as_py(), kind).reshape(shape), True
        if some:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = df.select("x").mapInArrow(first, "part binary")
    tasks = parts.rdd.getNumPartitions()
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        parts = parts.repartition(tasks).mapInArrow(again, "part binary")
    return sum((np.frombuffer(bytes(r["part"]), kind).reshape(shape) for r in parts.collect()), np.zeros(shape, kind))


def fit(rows: DataFrame, components: int = COMPONENTS, oversample: int = OVERSAMPLE, passes: int = PASSES, residual: float = RESIDUAL) -> Whitening | None:
    """Components of the rows' covariance (divisor n) by a randomised range finder; None without rows.

    ``rows`` is what ``usable`` gives, written once, as each pass reads it.
    Every pass goes over all centred rows: random directions, more than are
    wanted, are multiplied by the covariance and made orthonormal once
    and ``passes`` times more; Rayleigh-Ritz on their span gives components.  Where a
    wanted one's residual is over ``residual`` of the largest eigenvalue, the
    span is widened to all dimensions, and Rayleigh-Ritz on it is exact.
    The driver holds arrays of the vector's length times the span's width.
    """
    head = rows.limit(1).collect()
    if not head:
        return None
    d = len(head[0]["x"])
    total = added(rows, lambda x: np.concatenate([[len(x)], *_halves(x)]), (1 + 2 * d,), "i8")
    n = int(total[0])
    sums = tuple(int(high) * 2**HALF + int(low) for high, low in zip(total[1 : 1 + d], total[1 + d :], strict=True))

    def image(basis: np.ndarray) -> tuple[np.ndarray, float]:
        """The covariance times the basis, and the covariance's trace."""

        def partial(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return np.concatenate([c.T @ (c @ basis), np.square(c).sum(axis=0)[:, None]], axis=1)

        total = added(rows, partial, (d, basis.shape[1] + 1)) / n
        return total[:, :-1], float(total[:, -1].sum())

    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, min(d, components + oversample))))[0]
    seen, trace = image(basis)
    if not trace:
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    for _ in range(passes + 1):
        basis = np.linalg.qr(seen)[0]
        seen, _ = image(basis)
    values, vectors, left = _ritz(basis, seen)
    wanted = min(components, d)
    if basis.shape[1] < d and (left > residual * values)[:wanted][values[:wanted] > RANK * values[0]].any():
        more = np.random.default_rng(SEED + 1).standard_normal((d, d - basis.shape[1]))
        basis = np.linalg.qr(np.concatenate([vectors, more], axis=1))[0]
        values, vectors, _ = _ritz(basis, image(basis)[0])
    keep = min(wanted, int((values > RANK * values[0]).sum()))
    values, vectors = values[:keep], vectors[:, :keep]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)] < 0, -1.0, 1.0)
    scaled = vectors / np.sqrt(values)
    moments = added(rows, lambda x: np.concatenate([(w := centred(x, n, sums) @ scaled).sum(axis=0)[None], w.T @ w]), (1 + keep, keep)) / n
    error = np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(keep)).max()
    return Whitening(n, sums, vectors, values, trace, float(error))


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each dimension's upper and lower bits: neither overflows below 2^36 rows."""
    return (x >> HALF).sum(axis=0), (x & ((1 << HALF) - 1)).sum(axis=0)


def _ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and vectors of the covariance on the basis' span, and the norms of their residuals."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = basis @ turn
    return values, vectors, np.linalg.norm(image @ turn - vectors * values, axis=0)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Of each row the exact sum of (n x - S)^2; None where a long can't hold it."""
    near, rest = _near(x, n, sums)
    most = n * (int(np.abs(near).max(initial=0)) + 1)
    if most * most * x.shape[1] < 2**62:
        return np.square(near * n - np.array(rest, np.int64)).sum(axis=1).tolist()
    out = []
    for row in near.tolist():
        total = sum((n * v - r) ** 2 for v, r in zip(row, rest, strict=True))
        out.append(total if total < 2**63 else None)
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, **how) -> DataFrame:
    """Whitened coordinates of every usable vector, a row for each and component.

    Entries become whole numbers floor(64 c) + 1000000.  Which rows are left out
    ``usable`` says; null ids pass, rows that repeat are rows of their own, other
    columns of any names are ignored.  Components are numbered by falling
    eigenvalue; of a component the entry of the largest size is positive.
    Components without variance have no unit scale and are left out, so vectors
    that are all alike, a single one or an empty table give no rows.

    Returns ``vec_id``, ``component`` (from 1), ``n`` rows of the fit list,
    ``deviation``, the exact sum over dimensions of (n x - S)^2 (null where a
    long can't hold it), ``whitened``, ``explained``, the eigenvalue's share of
    the trace, and ``identity_error``, the largest entry of the whitened rows'
    covariance minus the identity, by a pass over all rows.
    """
    rows = materialize(usable(df, vector_col, id_col), "whole-vectors")
    kind = df.schema[id_col].dataType.simpleString()
    found = fit(rows, components, **how)
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None or not found.vectors.shape[1]:
        return df.sparkSession.createDataFrame([], schema)
    k, scaled = found.vectors.shape[1], found.vectors / np.sqrt(found.values)
    n, sums, share, error = found.n, found.sums, found.values / found.trace, found.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _matrix(batch.column("x"), np.int64), batch.num_rows
            if not m:
                continue
            rows_of = np.repeat(np.arange(m), k)
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(rows_of)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(rows_of)), pa.array((centred(x, n, sums) @ scaled).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
