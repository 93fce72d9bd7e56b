"""Matching a track to road segments: a radius join with the nearest segment."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.geo import angle_between, planar, project
from tracklake.operators.ordered import passes


def reference_latitude(segments: DataFrame) -> float:
    """The mean latitude of the segments' centres, about which the plane is laid."""
    return segments.agg(F.avg("center_lat")).first()[0]


def match_segments(track: DataFrame, segments: DataFrame, key: list[str], lat: str = "lat_kf", lon: str = "lon_kf",
                   match_m: float = 15.0, angle_deg: float = 60.0, least_mph: float = 2.0, radius_m: float = 100.0, ref_lat: float | None = None) -> DataFrame:
    """The nearest segment of each row, one whose direction fits first.

    Candidates have their centre within ``radius_m`` and come within ``match_m``.
    A row that moves at ``least_mph`` or more and has a bearing takes the nearest
    candidate within ``angle_deg`` (``direction``), else the nearest
    (``distance_only``), else none (``no_match``); ties go to the lower segment
    number.  ``key`` identifies a row.

    What a segment or a row repeats of another (course and bearing; place,
    bearing and whether it moves) is tried once.  Segments are dealt to the cells
    that they come near, of twice ``match_m``, so the join is on cells with few
    others; each place's best candidate is kept by an aggregation with partial
    results and joined back to its rows.
    """
    empty = None if ref_lat is not None else reference_latitude(segments)
    ref = ref_lat if ref_lat is not None else (empty or 0.0)
    cx, cy = planar(F.col("center_lat"), F.col("center_lon"), ref)
    ax, ay = planar(F.col("start_lat"), F.col("start_lon"), ref)
    bx, by = planar(F.col("end_lat"), F.col("end_lon"), ref)
    shape = {"_cx": cx, "_cy": cy, "_ax": ax, "_ay": ay, "_bx": bx, "_by": by}
    wide = segments.select(
        "segment_id", "road_name", "highway", "oneway", "bearing_deg", "center_lat", "center_lon", "start_lat", "start_lon", "end_lat", "end_lon", *(c.alias(k) for k, c in shape.items())
    ).filter(reduce(and_, (F.abs(F.col(k)) < float("inf") for k in shape)))
    same = ["oneway", "bearing_deg", *shape]
    one = F.min_by(F.struct("segment_id", "road_name", "highway", "center_lat", "center_lon", "start_lat", "start_lon", "end_lat", "end_lon"), F.struct("segment_id"))
    seg = wide.groupBy(*same).agg(one.alias("_s")).select(*same, "_s.*")
    side, reach = F.lit(max(2.0 * match_m, radius_m / 4)), lambda m: F.lit(m * (1 + 1e-6) + 1e-3)  # noqa: E731  wider by more than rounding errors
    cells = lambda v: (
        F.floor(F.greatest(F.least(f"_a{v}", f"_b{v}") - reach(match_m), F.col(f"_c{v}") - reach(radius_m)) / side),
        F.floor(F.least(F.greatest(f"_a{v}", f"_b{v}") + reach(match_m), F.col(f"_c{v}") + reach(radius_m)) / side),
    )
    for v in "xy":
        low, high = cells(v)
        seg = seg.withColumn(f"_g{v}", F.explode(F.when(low <= high, F.sequence(low, high))))
    px, py = planar(F.col(lat), F.col(lon), ref)
    place = {"_px": px, "_py": py, "_fast": F.coalesce(F.col("car_speed_mph") >= least_mph, F.lit(False)), "_deg": F.col("car_bearing_deg")}
    points = track.select(*(c.alias(k) for k, c in place.items())).filter("_px IS NOT NULL AND _py IS NOT NULL").distinct()
    points = points.withColumns({"_gx": F.floor(F.col("_px") / side), "_gy": F.floor(F.col("_py") / side)})
    near = points.join(seg, ["_gx", "_gy"]).filter(F.pow(F.col("_px") - F.col("_cx"), 2) + F.pow(F.col("_py") - F.col("_cy"), 2) <= radius_m**2)
    t, d = project(F.col("_px"), F.col("_py"), F.col("_ax"), F.col("_ay"), F.col("_bx"), F.col("_by"))
    near = near.withColumns({"_t": t, "_d": d}).filter(F.col("_d") <= match_m)
    turn = angle_between(F.col("_deg"), F.col("bearing_deg"), F.col("oneway"))
    fits = F.coalesce(F.col("_fast") & (turn <= angle_deg), F.lit(False))
    at = lambda a, b: F.col(a) + F.col("_t") * (F.col(b) - F.col(a))
    found = F.struct(
        "segment_id", "road_name", "highway", "oneway", F.col("bearing_deg").alias("seg_bearing"), "center_lat", "center_lon",
        F.col("start_lat").alias("seg_start_lat"), F.col("start_lon").alias("seg_start_lon"), F.col("end_lat").alias("seg_end_lat"), F.col("end_lon").alias("seg_end_lon"),
        at("start_lat", "end_lat").alias("snap_lat"), at("start_lon", "end_lon").alias("snap_lon"),
        F.col("_d").alias("match_distance_m"), turn.alias("match_angle_deg"), F.when(fits, "direction").otherwise("distance_only").alias("match_type"),
    )
    rank = F.struct((~fits).alias("a"), "_d", "segment_id")
    best = near.groupBy(*place).agg(F.min_by(found, rank).alias("_m"), F.min(rank).alias("_r")).withColumnsRenamed({k: f"_of{k}" for k in place})
    placed = track.withColumns(place)
    joined = placed.join(best, reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in place)), "left")
    # rows that share a key share the best of their candidates, and a key with a null has none
    known = reduce(and_, (F.col(k).isNotNull() for k in key))
    joined = joined.withColumn("_alone", F.when(~known, F.monotonically_increasing_id()))
    of_key = F.min_by("_m", "_r").over(Window.partitionBy(*key, "_alone"))
    joined = joined.withColumn("_m", F.when(known, of_key)).select(*track.columns, "_m.*")
    return joined.withColumn("match_type", F.coalesce("match_type", F.lit("no_match")))


def match_and_count(track: DataFrame, segments: DataFrame, by: list[str], time: str = "sample_time", **how) -> DataFrame:
    """Match a track and number its passes."""
    return passes(match_segments(track, segments, [*by, time], **how), by, [time], "center_lat", "center_lon")


def cells_for_radius(radius_m: float, lat: float) -> tuple[float, float]:
    """Degrees of latitude and longitude that a radius spans at a latitude."""
    return radius_m / 111_000.0, radius_m / (111_000.0 * math.cos(math.radians(lat)))
