"""The GPS track: one row a second, smoothed, with speed, bearing and passes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.clock import micros, nearest_second, seconds_between
from tracklake.functions.geo import bearing, haversine
from tracklake.functions.numbers import known, round_even
from tracklake.operators.ordered import densify, fill_gaps, first_per

#: Parameters of a long log that make up a track (fixed values), and their names in the track.
GPS_PARAMETERS = {"latitude": "lat", "longitude": "lon", "speed": "speed", "direction": "direction"}

#: Miles an hour in a metre a second (fixed value).
MPH = 2.23694


def pivot_track(long: DataFrame, by: list[str], time: str = "sample_time") -> DataFrame:
    """A long log to one row a second: the mean of each GPS parameter; seconds without any go."""
    names = list(GPS_PARAMETERS)
    rows = long.filter(F.col("parameter").isin(names)).withColumn(time, nearest_second(time))
    wide = rows.groupBy(*by, time).pivot("parameter", names).agg(F.avg(known("value")))
    wide = wide.filter(F.coalesce(*names).isNotNull())
    return wide.select(*by, time, *(F.col(k).alias(v) for k, v in GPS_PARAMETERS.items()))


def pivot_last(long: DataFrame, by: list[str], names: list[str], order: list[str]) -> DataFrame:
    """For each group the last known value of each named parameter, in the given order."""
    last = {n: F.max_by("value", F.when((F.col("parameter") == n) & F.col("value").isNotNull(), F.struct(*order))) for n in names}
    wide = long.filter(F.col("parameter").isin(names)).groupBy(*by).agg(*(c.alias(n) for n, c in last.items()))
    return wide.filter(F.coalesce(*(F.col(f"`{n}`") for n in names)).isNotNull())


def clean_track(track: DataFrame, by: list[str], time: str = "sample_time", tiebreak: list[str] | None = None) -> DataFrame:
    """Drop fixes without or with zero coordinates; of equal times keep the first."""
    good = track.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("lat") != 0) & (F.col("lon") != 0))
    return first_per(good, [*by, time], [F.col(c) for c in (tiebreak or ["lat", "lon"])])


#: Variance of position and of speed at a track's first fix (fixed value).
FIRST_VARIANCE = 1e-6


def smooth_axis(t: np.ndarray, z: np.ndarray, process: float, measurement: float, before: tuple | None = None, after: np.ndarray | None = None) -> np.ndarray:
    """Kalman filter forward, Rauch-Tung-Striebel smoother back, for columns of positions.

    The state of a column is position and speed; columns do not interact and
    share their covariance, so gains are computed once for all, as plain
    numbers.  Steps of no or negative length count as one second.

    For a part of a track: ``before`` is the filter at the row before the first
    (its time, position and speed of each column, covariance), ``after`` the
    smoothed position and speed of each column at the last row.
    """
    if before is not None:
        t, z = np.concatenate([[before[0]], t]), np.vstack([before[1][0], z])
    n = len(t)
    if n < 2:
        return z.copy() if after is None else after[:1].copy()
    dt = np.diff(t)
    dt[dt <= 0] = 1.0
    steps = dt.tolist()
    a, b, c = (FIRST_VARIANCE, 0.0, FIRST_VARIANCE) if before is None else before[2]  # covariance of position and speed
    gains, backs = [], []
    for d in steps:
        a1 = a + d * (2 * b + d * c) + process * d**3 / 3
        b1 = b + d * c + process * d**2 / 2
        c1 = c + process * d
        det = a1 * c1 - b1 * b1
        p, q = a + d * b, b + d * c
        backs.append(((p * c1 - b * b1) / det, (b * a1 - p * b1) / det, (q * c1 - c * b1) / det, (c * a1 - q * b1) / det))
        g, h = a1 / (a1 + measurement), b1 / (a1 + measurement)
        gains.append((g, h))
        a, b, c = a1 - g * a1, b1 - g * b1, c1 - h * b1
    out = np.empty_like(z, dtype=float)
    for k in range(z.shape[1]):
        x, v = float(z[0, k]), 0.0 if before is None else float(before[1][1, k])
        at, seen = [(x, v)], [(x, v)]
        for d, (g, h), value in zip(steps, gains, z[1:, k].tolist(), strict=True):
            guess = x + d * v
            at.append((guess, v))
            x, v = guess + g * (value - guess), v + h * (value - guess)
            seen.append((x, v))
        if after is not None:
            x, v = after[:, k].tolist()
        found = [x]
        for i in range(n - 2, -1, -1):
            e, f = x - at[i + 1][0], v - at[i + 1][1]
            j = backs[i]
            x, v = seen[i][0] + j[0] * e + j[1] * f, seen[i][1] + j[2] * e + j[3] * f
            found.append(x)
        out[:, k] = found[::-1]
    return out if before is None else out[1:]


def whole_groups(batches: Iterable[pa.RecordBatch], key: str, work: Callable[[pa.Table, list[tuple[int, int]]], pa.Table | Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by ``key`` to tables of whole groups, for ``work``, with the bounds of each group's rows; no more is held than a group and a batch.

    ``work`` gives a table, or batches one by one where they are many.
    """
    held: list[pa.RecordBatch] = []

    def done() -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        g = whole.column(key).to_numpy()
        cuts = np.flatnonzero(g[1:] != g[:-1]) + 1
        found = work(whole, list(zip([0, *cuts], [*cuts, len(g)], strict=True)))
        yield from found.combine_chunks().to_batches() if isinstance(found, pa.Table) else found

    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(g[1:] != g[:-1])[-1]) + 1 if (g[1:] != g[:-1]).any() else 0
        if not last and held and held[-1].column(key)[0].as_py() != g[0]:
            yield from done()
            held = []
        elif last:
            held.append(batch.slice(0, last))
            yield from done()
            held = []
        held.append(batch.slice(last))
    if held:
        yield from done()


def smooth(track: DataFrame, by: list[str], time: str = "sample_time", process: float = 1e-9, measurement: float = 1e-10) -> DataFrame:
    """Add ``lat_kf`` and ``lon_kf``, the smoothed position.

    The filter runs through a group in order, so a group (a vehicle's day, of
    86,400 rows at most) is one unit of work and is all that is held at a time;
    a task takes its groups one after the other from its sorted rows, however
    many and small they are.
    """
    rows = track.withColumns({"_us": micros(time), "_g": F.to_json(F.struct(*by)) if by else F.lit("")})
    names = [c for c in rows.columns if c not in ("_us", "_g")]
    fields = T.StructType([*(rows.schema[c] for c in names), *(T.StructField(c, T.DoubleType()) for c in ("lat_kf", "lon_kf"))])

    def smoothed(whole: pa.Table, bounds: list[tuple[int, int]]) -> pa.Table:
        t = whole.column("_us").to_numpy() / 1e6
        z = np.column_stack([whole.column(c).to_numpy().astype(float) for c in ("lat", "lon")])
        out = np.concatenate([smooth_axis(t[i:j], z[i:j], process, measurement) for i, j in bounds])
        return pa.table([*(whole.column(c) for c in names), pa.array(out[:, 0]), pa.array(out[:, 1])], names=[f.name for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return whole_groups(batches, "_g", smoothed)

    dealt = rows.repartition(*by) if by else rows.repartition(1)
    return dealt.sortWithinPartitions("_g", "_us").mapInArrow(run, fields)


def guard_displacement(track: DataFrame, most_m: float = 15.0) -> DataFrame:
    """Where smoothing moved a fix by more than ``most_m``, the fix itself counts."""
    far = haversine(F.col("lat"), F.col("lon"), F.col("lat_kf"), F.col("lon_kf")) > most_m
    return track.withColumns({"lat_kf": F.when(far, F.col("lat")).otherwise(F.col("lat_kf")), "lon_kf": F.when(far, F.col("lon")).otherwise(F.col("lon_kf"))})


def speed_bearing(track: DataFrame, by: list[str], time: str = "sample_time", lat: str = "lat_kf", lon: str = "lon_kf", order: list[str] | None = None) -> DataFrame:
    """Speed in miles an hour and bearing from the fix before; the device's own values win.

    The first fix has 0 and 0; steps of no or negative length have speed 0.
    """
    w = Window.partitionBy(*by).orderBy(*(order or [time]))
    a, b = F.lag(lat).over(w), F.lag(lon).over(w)
    dt = seconds_between(F.lag(time).over(w), F.col(time))
    out = track.withColumns({"_dt": dt, "_d": haversine(a, b, F.col(lat), F.col(lon)), "_b": bearing(a, b, F.col(lat), F.col(lon))})
    own = F.when(F.col("_dt").isNull() | (F.col("_dt") <= 0), F.lit(0.0)).otherwise(F.try_divide(F.col("_d"), F.col("_dt")) * MPH)
    turn = F.when(F.col("_dt").isNull(), F.lit(0.0)).otherwise(F.col("_b"))
    device = lambda name: known(F.col(name).cast("double")) if name in track.columns else F.lit(None).cast("double")
    return out.withColumns(
        {"car_speed_mph": F.coalesce(device("speed") * MPH, own), "car_bearing_deg": F.coalesce(device("direction"), turn)}
    ).drop("_dt", "_d", "_b")


def to_1hz(track: DataFrame, by: list[str], time: str = "sample_time", limit_s: float = 5.0) -> DataFrame:
    """One row for every second: means of the fixes in it, gaps filled as far as ``limit_s``.

    Raw coordinates stay null between fixes.  Bearings are averaged and
    interpolated as numbers, also across north.
    """
    values = ["lat", "lon", "lat_kf", "lon_kf", "car_speed_mph", "car_bearing_deg"]
    second = track.withColumn(time, nearest_second(time)).groupBy(*by, time).agg(*(F.avg(v).alias(v) for v in values))
    return fill_gaps(densify(second, by, time), by, time, values[2:], limit_s)


def format_track(matched: DataFrame, by: list[str], time: str = "sample_time", ends: bool = True) -> DataFrame:
    """The published columns of a matched track; segment centres to six digits."""
    names: dict[str, Column | str] = {
        "datetime": time, "lat": "lat", "lon": "lon", "car_mph": "car_speed_mph", "car_deg": "car_bearing_deg",
        "lat_30": round_even("center_lat", 6), "lon_30": round_even("center_lon", 6), "rd_type": "highway", "rd_name": "road_name",
        "drive_pass": "drive_pass", "lat_smooth": "lat_kf", "lon_smooth": "lon_kf", "lat_snap": "snap_lat", "lon_snap": "snap_lon",
    }
    if ends:
        names |= {c: c for c in ("seg_start_lat", "seg_start_lon", "seg_end_lat", "seg_end_lon")}
    return matched.select(*by, *((F.col(c) if isinstance(c, str) else c).alias(k) for k, c in names.items()))


def process_track(long: DataFrame, by: list[str], process: float = 1e-9, measurement: float = 1e-10, most_m: float = 15.0, limit_s: float = 5.0) -> DataFrame:
    """A long log to a complete track of one row a second."""
    steps: list[Callable[[DataFrame], DataFrame]] = [
        lambda d: pivot_track(d, by),
        lambda d: clean_track(d, by),
        lambda d: smooth(d, by, process=process, measurement=measurement),
        lambda d: guard_displacement(d, most_m),
        lambda d: speed_bearing(d, by),
        lambda d: to_1hz(d, by, limit_s=limit_s),
    ]
    for step in steps:
        long = long.transform(step)
    return long


def match_statistics(matched: DataFrame) -> DataFrame:
    """Rows, rows on a road, their share in percent, and the number of passes."""
    on = F.count_if(F.col("segment_id").isNotNull())
    return matched.agg(F.count("*").alias("n_rows"), on.alias("n_matched"), (F.try_divide(on, F.count("*")) * 100).alias("match_pct"), F.max("drive_pass").alias("n_passes"))
