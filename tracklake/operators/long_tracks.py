"""Smoothing of tracks that fit no task: blocks of time apart, then a scan over a summary of each.

What a block's fixes do to the filter is one element, and elements combine
associatively: for a state x before the block, the state at its last fix is
normal with mean A x + b and covariance C, and the block's fixes tell of x by
the information eta and J.  So each block is summed up alone; a scan over a
track's summaries, forwards, gives the filter before each block, and backwards
what all later fixes tell of its last state, which together make that state's
smoothed value; and each block is then filtered and smoothed between those two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.clock import micros
from tracklake.operators.gps import FIRST_VARIANCE, smooth_axis, whole_groups

#: Seconds of a block.
BLOCK_S = 3600.0
AXES = ("lat", "lon")
#: Blocks of no more fixes are finished together, longer ones by themselves.
FEW = 32
#: A, b, C, eta and J of an element, as rows of 2 x 2 matrices; b and eta have a column for each axis.
Element = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
EYE = np.eye(2)


def _solve(m: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Solutions of 2 x 2 systems, in closed form."""
    det = m[..., 0, 0] * m[..., 1, 1] - m[..., 0, 1] * m[..., 1, 0]
    adjoint = np.stack([np.stack([m[..., 1, 1], -m[..., 0, 1]], -1), np.stack([-m[..., 1, 0], m[..., 0, 0]], -1)], -2)
    return adjoint @ y / det[..., None, None]


def _t(m: np.ndarray) -> np.ndarray:
    return np.swapaxes(m, -1, -2)


def step_elements(dt: np.ndarray, z: np.ndarray, process: float, measurement: float) -> Element:
    """Elements of single steps: ``dt`` seconds on, then a fix ``z`` (a column for each axis)."""
    dt = np.where(dt <= 0, 1.0, dt)
    n = len(dt)
    f = np.broadcast_to(EYE, (n, 2, 2)).copy()
    f[:, 0, 1] = dt
    q = process * np.stack([np.stack([dt**3 / 3, dt**2 / 2], -1), np.stack([dt**2 / 2, dt], -1)], -2)
    s = (q[:, 0, 0] + measurement)[:, None, None]
    gain = q[:, :, :1] / s
    keep = np.broadcast_to(EYE, (n, 2, 2)).copy()
    keep[:, :, :1] -= gain
    seen, fix = f[:, :1, :], z[:, None, :]  # the row of F that a fix sees
    return keep @ f, gain @ fix, keep @ q, _t(seen) @ fix / s, _t(seen) @ seen / s


def combined(i: Element, j: Element) -> Element:
    """One element after another."""
    (ai, bi, ci, ei, ji), (aj, bj, cj, ej, jj) = i, j
    fore, back = EYE + ci @ jj, EYE + jj @ ci
    return (
        aj @ _solve(fore, ai), aj @ _solve(fore, bi + ci @ ej) + bj, aj @ _solve(fore, ci @ _t(aj)) + cj,
        _t(ai) @ _solve(back, ej - jj @ bi) + ei, _t(ai) @ _solve(back, jj @ ai) + ji,
    )


def reduced_within(e: Element, of: np.ndarray) -> tuple[Element, np.ndarray]:
    """All elements of each of many blocks as one, neighbours first; ``of`` is the block of each, ascending.  Says the blocks that have one, too."""
    while True:
        fresh = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])[: len(of)])
        place = np.arange(len(of)) - np.repeat(fresh, np.diff(np.append(fresh, len(of))))
        left = np.flatnonzero(place % 2 == 0)
        paired = left + 1 < len(of)
        paired[paired] = of[left[paired] + 1] == of[left[paired]]
        if not paired.any():
            return e, of
        pairs = combined(tuple(x[left[paired]] for x in e), tuple(x[left[paired] + 1] for x in e))
        e = tuple(x[left] for x in e)
        for x, y in zip(e, pairs, strict=True):
            x[paired] = y
        of = of[left]


def reduced(e: Element) -> Element:
    """All elements of an array as one, so an array of n takes log2(n) rounds."""
    return tuple(x[0] for x in reduced_within(e, np.zeros(len(e[0]), int))[0])


def summaries(t: np.ndarray, z: np.ndarray, starts: np.ndarray, process: float, measurement: float) -> Element:
    """Of each block the element of its steps after its first fix, with positions as from that fix, which keeps digits."""
    n, axes = len(starts), z.shape[1]
    e = (np.broadcast_to(EYE, (n, 2, 2)).copy(), np.zeros((n, 2, axes)), np.zeros((n, 2, 2)), np.zeros((n, 2, axes)), np.zeros((n, 2, 2)))
    of = np.repeat(np.arange(n), np.diff(np.append(starts, len(t))))
    later = np.delete(np.arange(len(t)), starts)
    if len(later):
        found, blocks = reduced_within(step_elements(t[later] - t[later - 1], z[later] - z[starts[of[later]]], process, measurement), of[later])
        for x, y in zip(e, found, strict=True):
            x[blocks] = y
    return e


def summary(t: np.ndarray, z: np.ndarray, process: float, measurement: float) -> Element:
    """The element of one block."""
    return tuple(x[0] for x in summaries(t, z, np.zeros(1, int), process, measurement))


def scans(t0: np.ndarray, t1: np.ndarray, z0: np.ndarray, e: Element, starts: np.ndarray, process: float, measurement: float) -> tuple[np.ndarray, np.ndarray]:
    """For each block of many tracks, in order: the filter at the last fix before it (time, state, three numbers of its covariance) and the smoothed state at its own last fix; NaN where there is none.

    Tracks begin at ``starts``; their first blocks are done together, then their second ones, and so on.
    """
    n, axes = z0.shape
    size = np.diff(np.append(starts, n))
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    down = lambda z: np.stack([z, np.zeros_like(z)], 1)  # noqa: E731  positions, no speeds
    going = lambda k: int(np.searchsorted(-size, -k, side="left"))  # noqa: E731  tracks of more than k blocks
    whole = tuple(x.copy() for x in e)
    mean, cov = np.zeros((n, 2, axes)), np.zeros((n, 2, 2))
    most = int(size[0]) if n else 0
    for k in range(most):
        at = starts[: going(k)] + k
        if k:
            step = step_elements(t0[at] - t1[at - 1], np.zeros((len(at), axes)), process, measurement)
            here = combined(step, tuple(x[at] for x in e))
            for x, y in zip(whole, here, strict=True):
                x[at] = y
            m, p = mean[at - 1] - down(z0[at]), cov[at - 1]
        else:
            here, m, p = tuple(x[at] for x in e), np.zeros((len(at), 2, axes)), np.broadcast_to(FIRST_VARIANCE * EYE, (len(at), 2, 2))
        a, b, c, eta, j = here
        known = EYE + p @ j
        p1 = a @ _solve(known, p @ _t(a)) + c
        mean[at] = a @ _solve(known, m + p @ eta) + b + down(z0[at])
        cov[at] = (p1 + _t(p1)) / 2
    ends = np.full((n, 2, axes), np.nan)
    eta, j = np.zeros((len(size), 2, axes)), np.zeros((len(size), 2, 2))
    for back in range(most):
        m = going(back)
        at = starts[:m] + size[:m] - 1 - back
        later = eta[:m]
        if back:  # what comes later was summed up with positions as from the next block's first fix
            shift, p = down(z0[at + 1]), cov[at]
            ends[at] = _solve(EYE + p @ j[:m], mean[at] - shift + p @ eta[:m]) + shift
            later = eta[:m] + j[:m] @ down(z0[at + 1] - z0[at])
        a, b, c, own, info = (x[at] for x in whole)
        known = EYE + j[:m] @ c
        eta[:m], j[:m] = _t(a) @ _solve(known, later - j[:m] @ b) + own, _t(a) @ _solve(known, j[:m] @ a) + info
    before = np.full((n, 4 + 2 * axes), np.nan)
    at = np.setdiff1d(np.arange(n), starts)
    before[at] = np.column_stack([t1[at - 1], mean[at - 1].reshape(len(at), 2 * axes), cov[at - 1, 0, 0], cov[at - 1, 0, 1], cov[at - 1, 1, 1]])
    return before, ends.reshape(n, 2 * axes)


def scan(t0: np.ndarray, t1: np.ndarray, z0: np.ndarray, elements: list[Element], process: float, measurement: float) -> tuple[list, list]:
    """``scans`` of one track, as ``smooth_axis`` takes it: none where there is none."""
    axes = z0.shape[1]
    before, ends = scans(t0, t1, z0, tuple(np.stack(x) for x in zip(*elements, strict=True)), np.zeros(1, int), process, measurement)
    first = [None if np.isnan(b[0]) else (b[0], b[1 : 1 + 2 * axes].reshape(2, axes), tuple(b[1 + 2 * axes :])) for b in before]
    return first, [None if np.isnan(e[0]) else e.reshape(2, axes) for e in ends]


def smooth_blocks(t: np.ndarray, z: np.ndarray, starts: np.ndarray, before: np.ndarray, after: np.ndarray, process: float, measurement: float) -> np.ndarray:
    """``smooth_axis`` for many short blocks: their first steps are done together, then their second ones, and so on.  Times and fixes of a block follow each other."""
    axes, n = z.shape[1], len(starts)
    has, known = ~np.isnan(before[:, 0]), ~np.isnan(after[:, 0])
    steps = np.diff(np.append(starts, len(t))) - ~has
    order = np.argsort(-steps, kind="stable")
    starts, before, after, has, known, steps = (x[order] for x in (starts, before, after, has, known, steps))
    row = starts + ~has - 1  # the row of the state after no step
    x = np.where(has[:, None], before[:, 1 : 1 + axes], z[starts])
    v = np.where(has[:, None], before[:, 1 + axes : 1 + 2 * axes], 0.0)
    a, b, c = (np.where(has, before[:, 1 + 2 * axes + k], start) for k, start in enumerate((FIRST_VARIANCE, 0.0, FIRST_VARIANCE)))
    kept = []
    most = int(steps[0]) if n else 0
    for k in range(1, most + 1):
        m = int(np.searchsorted(-steps, -k, side="right"))
        at = row[:m] + k
        d = t[at] - (np.where(has[:m], before[:m, 0], t[at - 1]) if k == 1 else t[at - 1])
        d[d <= 0] = 1.0
        a0, b0, c0 = a[:m].copy(), b[:m].copy(), c[:m].copy()
        a1, b1, c1 = a0 + d * (2 * b0 + d * c0) + process * d**3 / 3, b0 + d * c0 + process * d**2 / 2, c0 + process * d
        det, p, q = a1 * c1 - b1 * b1, a0 + d * b0, b0 + d * c0
        gains = [((p * c1 - b0 * b1) / det)[:, None], ((b0 * a1 - p * b1) / det)[:, None], ((q * c1 - c0 * b1) / det)[:, None], ((c0 * a1 - q * b1) / det)[:, None]]
        g, h = a1 / (a1 + measurement), b1 / (a1 + measurement)
        a[:m], b[:m], c[:m] = a1 - g * a1, b1 - g * b1, c1 - h * b1
        guess = x[:m] + d[:, None] * v[:m]
        kept.append((x[:m].copy(), v[:m].copy(), guess, gains))
        off = z[at] - guess
        x[:m], v[:m] = guess + g[:, None] * off, v[:m] + h[:, None] * off
    x, v = np.where(known[:, None], after[:, :axes], x), np.where(known[:, None], after[:, axes:], v)
    out = np.empty_like(z, dtype=float)
    for k in range(most, -1, -1):
        m = int(np.searchsorted(-steps, -k, side="right"))
        mine = np.arange(m) if k else np.flatnonzero(~has)
        out[row[mine] + k] = x[mine]
        if k:
            x0, v0, guess, j = kept[k - 1]
            e, f = x[:m] - guess, v[:m] - kept[k - 1][1]
            x[:m], v[:m] = x0 + j[0] * e + j[1] * f, v0 + j[2] * e + j[3] * f
    return out


def smooth(track: DataFrame, by: list[str], time: str = "sample_time", process: float = 1e-9, measurement: float = 1e-10, block_s: float = BLOCK_S) -> DataFrame:
    """``gps.smooth`` for tracks of any length: a group lies in many tasks, by blocks of ``block_s`` seconds.

    Rows are shuffled once, by group and block.  A task holds a block's rows at
    a time, and in the scan a group's summaries, 24 numbers a block.  Times and
    positions are known in all rows, as ``gps.clean_track`` leaves them; nulls
    in ``by`` are values; an empty track gives an empty one.
    """
    names = track.columns
    group = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    rows = track.withColumns({"_us": micros(time), "_k": group})
    rows = rows.withColumn("_block", F.floor(F.col("_us") / F.lit(int(block_s * 1_000_000))).cast("long"))
    rows = rows.withColumn("_g", F.concat_ws("|", F.col("_block").cast("string"), "_k")).repartition("_g")
    fields = T.StructType([*(track.schema[c] for c in names), *(T.StructField(f"{a}_kf", T.DoubleType()) for a in AXES)])
    number = lambda whole, c: whole.column(c).to_numpy().astype(float)

    def fixes(whole: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return number(whole, "_us") / 1e6, np.column_stack([number(whole, a) for a in AXES])

    def lists(values: np.ndarray) -> pa.Array:
        """Rows of numbers as lists, null where they are NaN."""
        n, width = values.shape
        offsets = pa.array(np.arange(n + 1, dtype="i4") * width)
        return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()), mask=pa.array(np.isnan(values[:, 0])))

    def rows_of(c: pa.ChunkedArray, width: int) -> np.ndarray:
        found = np.full((len(c), width), np.nan)
        found[c.is_valid().to_numpy()] = np.concatenate([x.flatten().to_numpy() for x in c.chunks]).reshape(-1, width)
        return found

    def summed(whole: pa.Table, bounds: list[tuple[int, int]]) -> pa.Table:
        t, z = fixes(whole)
        starts, last = np.array([i for i, _ in bounds]), np.array([j - 1 for _, j in bounds])
        found = np.column_stack([x.reshape(len(starts), -1) for x in summaries(t, z, starts, process, measurement)])
        same = [whole.column(c).take(starts) for c in ("_g", "_k", "_block")]
        return pa.table([*same, lists(np.column_stack([t[starts], t[last], z[starts]])), lists(found)], names=["_g", "_k", "_block", "_ends", "_e"])

    def carried(whole: pa.Table, bounds: list[tuple[int, int]]) -> pa.Table:
        ends, e = rows_of(whole.column("_ends"), 2 + len(AXES)), rows_of(whole.column("_e"), 20).reshape(-1, 5, 2, 2)
        before, after = scans(ends[:, 0], ends[:, 1], ends[:, 2:], tuple(e[:, k] for k in range(5)), np.array([i for i, _ in bounds]), process, measurement)
        return pa.table([whole.column("_g"), lists(before), lists(after)], names=["_g", "_before", "_after"])

    def finished(whole: pa.Table, bounds: list[tuple[int, int]]) -> pa.Table:
        t, z = fixes(whole)
        limits = np.array(bounds)
        starts, size = limits[:, 0], limits[:, 1] - limits[:, 0]
        before, after = (rows_of(whole.column(c).take(starts), n) for c, n in (("_before", 8), ("_after", 4)))
        out = np.empty_like(z)
        few = size <= FEW
        if few.any():
            rows = np.flatnonzero(np.repeat(few, size))
            out[rows] = smooth_blocks(t[rows], z[rows], np.concatenate([[0], np.cumsum(size[few])[:-1]]), before[few], after[few], process, measurement)
        for k in np.flatnonzero(~few).tolist():
            i, j = bounds[k]
            b = None if np.isnan(before[k, 0]) else (float(before[k, 0]), before[k, 1:5].reshape(2, 2), tuple(before[k, 5:].tolist()))
            out[i:j] = smooth_axis(t[i:j], z[i:j], process, measurement, b, None if np.isnan(after[k, 0]) else after[k].reshape(2, 2))
        return pa.table([*(whole.column(c) for c in names), pa.array(out[:, 0]), pa.array(out[:, 1])], names=[f.name for f in fields])

    def over(key: str, work):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return whole_groups(batches, key, work)

        return run

    order = ["_g", "_us", *AXES]
    sums = rows.sortWithinPartitions(*order).mapInArrow(over("_g", summed), "_g string, _k string, _block long, _ends array<double>, _e array<double>")
    states = sums.repartition("_k").sortWithinPartitions("_k", "_block").mapInArrow(over("_k", carried), "_g string, _before array<double>, _after array<double>")
    joined = rows.join(states, "_g")
    return joined.sortWithinPartitions(*order).mapInArrow(over("_g", finished), fields)
