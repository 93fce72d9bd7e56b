"""Hand-made cases for the rules that tables do not reach, and properties against plain versions."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracklake.functions import clock, geo, numbers
from tracklake.operators import calibration, gps, matching, ordered, output, quality, roads, targets


def t(s):
    return datetime(2025, 7, 15) + timedelta(seconds=s)


def column(df, name="x"):
    return [r[name] for r in df.collect()]


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(1.000005,), (2.5e-5,), (0.5,), (None,), (-1.5e-5,)], "v double")
    assert column(df.select(numbers.round_even("v", 5).alias("x"))) == [1.0, 2e-05, 0.5, None, -2e-05]
    half = spark.createDataFrame([(datetime(2025, 1, 1, 0, 0, 0, 500000),), (datetime(2025, 1, 1, 0, 0, 1, 500000),)], "v timestamp_ntz")
    assert [x.second for x in column(half.select(clock.nearest_second("v").cast("timestamp_ntz").alias("x")))] == [0, 2]


def test_local_times_that_are_skipped_or_repeated_are_null(spark):
    texts = ["2025-03-09 02:30:00", "2025-11-02 01:30:00", "2025-07-01 12:00:00", "2025-03-09 03:00:00", "2025-11-02 02:00:00"]
    df = spark.createDataFrame([(x,) for x in texts], "v string")
    got = column(df.select(clock.local_to_utc(F.col("v").cast("timestamp_ntz"), "America/Los_Angeles").cast("timestamp_ntz").alias("x")))
    assert got == [None, None, datetime(2025, 7, 1, 19), datetime(2025, 3, 9, 10), datetime(2025, 11, 2, 10)]


def test_mixed_times_and_file_names(spark):
    df = spark.createDataFrame([("2026-01-09T08:31:14.499858Z",), ("2025-04-12 07:27:51.499991",), ("2025-04-12",), ("oops",)], "v string")
    got = column(df.select(clock.parse_mixed("v").cast("timestamp_ntz").alias("x")))
    assert got == [datetime(2026, 1, 9, 8, 31, 14, 499858), datetime(2025, 4, 12, 7, 27, 51, 499991), datetime(2025, 4, 12), None]
    names = spark.createDataFrame([("/a/b/xx20250715_180001_p.h5",), ("none.h5",)], "v string")
    assert column(names.select(clock.name_time("v").cast("timestamp_ntz").alias("x"))) == [datetime(2025, 7, 15, 18, 0, 1), None]


def test_gap_exactly_at_the_limit(spark):
    df = spark.createDataFrame([("a", t(s)) for s in (0, 3, 6, 10, 40, 71)], "k string, ts timestamp")
    number = lambda gap, inclusive: column(ordered.sessions(df, ["k"], "ts", gap, inclusive).orderBy("ts"), "period")
    assert number(3, True) == [1, 2, 3, 4, 5, 6]
    assert number(3, False) == [1, 1, 1, 2, 3, 4]
    assert number(30, False) == [1, 1, 1, 1, 1, 2]


def test_long_gaps_are_filled_in_part(spark):
    known = {0: 0.0, 6: 6.0, 20: 20.0, 26: None}
    rows = [("a", t(s), known.get(s)) for s in range(-2, 33)]
    rows[0] = ("a", t(-2), None)
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    got = {int((r.ts - t(0)).total_seconds()): r.v for r in ordered.fill_gaps(df, ["k"], "ts", ["v"], 5.0).collect()}
    assert got[-1] is None
    assert [got[s] for s in range(6)] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert got[11] == 11.0 and got[12] is None and got[19] is None
    assert got[25] == 20.0 and got[26] is None


def test_fill_gaps_like_pandas(spark):
    rng = np.random.default_rng(0)
    v = np.where(rng.random(300) < 0.4, rng.normal(size=300), np.nan)
    df = spark.createDataFrame([("a", t(i), None if math.isnan(x) else float(x)) for i, x in enumerate(v)], "k string, ts timestamp, v double")
    got = [r.v for r in ordered.fill_gaps(df, ["k"], "ts", ["v"], 5.0).orderBy("ts").collect()]
    s = pd.Series(v)
    full = s.interpolate(method="linear", limit_area=None)
    run = s.isna().groupby(s.notna().cumsum()).cumsum()
    want = full.where(~((run > 5) & s.isna()))
    assert all((a is None and math.isnan(b)) or abs(a - b) < 1e-12 for a, b in zip(got, want))


def test_two_state_smoother_is_the_four_state_one():
    rng = np.random.default_rng(1)
    n, q, r = 120, 1e-9, 1e-10
    times = np.cumsum(rng.integers(0, 3, n)).astype(float)
    z = np.cumsum(rng.normal(size=(n, 2)) * 1e-5, axis=0) + [37.8, -122.3]
    h, rr = np.eye(2, 4), np.eye(2) * r
    x, p, xs, ps, xp, pp, fs = np.r_[z[0], 0, 0], np.eye(4) * 1e-6, [], [], [], [], []
    xs.append(x), ps.append(p), xp.append(x), pp.append(p), fs.append(None)
    for k in range(1, n):
        d = times[k] - times[k - 1]
        d = d if d > 0 else 1.0
        f = np.eye(4)
        f[0, 2] = f[1, 3] = d
        qq = q * np.kron(np.array([[d**3 / 3, d**2 / 2], [d**2 / 2, d]]), np.eye(2))
        a, b = f @ x, f @ p @ f.T + qq
        g = b @ h.T @ np.linalg.inv(h @ b @ h.T + rr)
        x, p = a + g @ (z[k] - h @ a), (np.eye(4) - g @ h) @ b
        xs.append(x), ps.append(p), xp.append(a), pp.append(b), fs.append(f)
    for k in range(n - 2, -1, -1):
        g = ps[k] @ fs[k + 1].T @ np.linalg.inv(pp[k + 1])
        xs[k] = xs[k] + g @ (xs[k + 1] - xp[k + 1])
    got = gps.smooth_axis(times, z, q, r)
    assert np.abs(got - np.array(xs)[:, :2]).max() < 1e-9
    assert (gps.smooth_axis(times[:1], z[:1], q, r) == z[:1]).all()


def test_rma_is_the_orthogonal_fit(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(5):
        x = rng.normal(size=30)
        rows += [(g, float(a), float(b)) for a, b in zip(x, (g - 2) * x + 3 + rng.normal(size=30) * 0.3)]
    rows += [(9, 1.0, 1.0), (10, 1.0, 5.0), (10, 2.0, 5.0), (11, 1.0, 2.0), (11, 1.0, 3.0), (12, float("nan"), 1.0), (12, 1.0, 2.0), (12, 2.0, None)]
    slope, intercept = calibration.rma("y", "x")
    got = {r.g: (r.s, r.i) for r in spark.createDataFrame(rows, "g int, x double, y double").groupBy("g").agg(slope.alias("s"), intercept.alias("i")).collect()}
    assert got[9] == (None, None) and got[10] == (0.0, 5.0) and got[11] == (None, None) and got[12] == (None, None)
    for g in (0, 1, 3, 4):
        x, y = (np.array([r[k] for r in rows if r[0] == g]) for k in (1, 2))
        cost = lambda s: np.sum((y - y.mean() - s * (x - x.mean())) ** 2 / (y.var() + s * s * x.var()))
        grid = np.linspace(got[g][0] - 0.5, got[g][0] + 0.5, 2001)
        assert abs(grid[np.argmin([cost(s) for s in grid])] - got[g][0]) < 1e-3


def test_brackets(spark):
    rows = [("i", p, t(s), 10.0) for p in ("both", "left", "right", "none", "inside") for s in (100, 150, 200)]
    cals = [("i", "both", t(0), 1.0, 0.0), ("i", "both", t(300), 4.0, 3.0), ("i", "both", t(150), 99.0, 99.0), ("i", "left", t(50), 2.0, None), ("i", "right", t(250), 3.0, 1.0), ("i", "inside", t(120), 7.0, 7.0)]
    out = calibration.bracket_runs(
        spark.createDataFrame(rows, "instrument string, parameter string, sample_time timestamp, value double"),
        spark.createDataFrame(cals, "instrument string, parameter string, sample_time timestamp, slope double, intercept double"),
        ["instrument", "parameter"],
    )
    got = {(r.parameter, int((r.sample_time - t(0)).total_seconds())): (r.slope, r.intercept) for r in out.collect()}
    assert got["both", 150] == (2.5, 1.5) and got["left", 100] == (2.0, 0.0) and got["right", 200] == (3.0, 1.0)
    assert got["none", 100] == (1.0, 0.0) and got["inside", 150] == (1.0, 0.0)


def test_zeros_like_searchsorted(spark):
    rng = np.random.default_rng(3)
    zt, zv = np.sort(rng.integers(0, 1000, 6)), rng.normal(size=6)
    zeros = [("Vocus-PTR-ToF", "C6H7", t(int(a)), float(b)) for a, b in zip(zt, zv)] + [("Vocus-PTR-ToF", "C7H9", t(5), 1.0)]
    at = list(range(-50, 1100, 7))
    rows = [("Vocus-PTR-ToF", "C6H7", t(s)) for s in at] + [("Vocus-PTR-ToF", "C7H9", t(0)), ("other", "C6H7", t(0)), ("Vocus-PTR-ToF", "zero_flow", t(0))]
    out = calibration.with_zeros(
        spark.createDataFrame(rows, "instrument string, parameter string, sample_time timestamp"),
        spark.createDataFrame(zeros, "instrument string, parameter string, sample_time timestamp, zero double"),
    ).collect()
    got = {int((r.sample_time - t(0)).total_seconds()): r.zero for r in out if r.instrument != "other" and r.parameter == "C6H7"}
    for s in at:
        k = min(max(np.searchsorted(zt, s), 1), 5)
        want = zv[k - 1] if zt[k] == zt[k - 1] else zv[k - 1] + (zv[k] - zv[k - 1]) * (s - zt[k - 1]) / (zt[k] - zt[k - 1])
        assert abs(got[s] - want) < 1e-9
    assert all(r.zero == 0.0 for r in out if r.parameter != "C6H7" or r.instrument == "other")


def test_flags(spark):
    rows = [(t(0), "A", "x", float("nan"), None), (t(0), "A", "y", 100.0, None), (t(0), "A", "z", 101.0, None), (t(0), "A", "Status", 1.0, "12"), (t(0), "A", "Status", 1.0, "bad"), (t(1), "A", "x", 5.0, None), (t(1), "A", None, 5.0, None), (t(0), "EcoPhysics_NOX", "NO2", 1.0, None), (t(0), "CAPS_NO2", "NO2", 1.0, None)]
    limits = [("A", "x", 0.0, 10.0, 2), ("A", "y", 0.0, 100.0, 4), ("A", "z", 0.0, 100.0, 16), ("A", "Status", 0.0, 11.0, 8), ("CAPS_NO2", "NO2", None, 0.0, 2)]
    out = quality.flag_readings(
        spark.createDataFrame(rows, "sample_time timestamp, instrument string, parameter string, value double, string string"),
        spark.createDataFrame(limits, "instrument string, parameter string, range_start double, range_end double, flag_value int"),
    ).collect()
    assert {r.summary_flag for r in out if r.instrument == "A" and r.sample_time == t(0)} == {"8,16"}
    assert {r.summary_flag for r in out if r.sample_time == t(1)} == {"0"}
    assert {(r.instrument, r.parameter) for r in out if r.instrument != "A"} == {("CAPS_NO2", "NO2")}
    assert all(r.parameter is not None for r in out)


def test_lags_and_windows(spark):
    rows = spark.createDataFrame([("A", t(0)), ("B", t(0))], "instrument string, sample_time timestamp")
    lags = spark.createDataFrame([(datetime(2025, 7, 1), "A", 4)], "month timestamp, instrument string, lag_s int")
    assert {r.instrument: r.sample_time for r in quality.apply_lags(rows, lags).collect()} == {"A": t(-4), "B": t(0)}
    assert [tuple(r) for r in quality.lag_counts(rows, lags).collect()] == [("A", 1)]
    with pytest.raises(ValueError):
        targets.requested(spark, ["A"], [])
    with pytest.raises(ValueError):
        ordered.tail_rows(rows, ["instrument"], ["sample_time"], 5, 5)


def test_matching_against_brute_force(spark):
    rng = np.random.default_rng(4)
    seg = []
    for i in range(300):
        a, o = 37.8 + rng.random() * 0.01, -122.3 + rng.random() * 0.01
        da, do = (rng.normal(size=2) * 1e-4).tolist()
        seg.append((i, "r", "residential", bool(i % 2), a, o, a + da, o + do, a + da / 2, o + do / 2, float(rng.random() * 360)))
    seg.append((300, *seg[5][1:]))  # a tie
    pts = [(k, 37.8 + rng.random() * 0.01, -122.3 + rng.random() * 0.01, float(rng.random() * 4), float(rng.random() * 360)) for k in range(300)]
    s = spark.createDataFrame(seg, "segment_id long, road_name string, highway string, oneway boolean, start_lat double, start_lon double, end_lat double, end_lon double, center_lat double, center_lon double, bearing_deg double")
    p = spark.createDataFrame(pts, "k long, lat_kf double, lon_kf double, car_speed_mph double, car_bearing_deg double")
    got = {r.k: (r.match_type, r.segment_id) for r in matching.match_segments(p, s, ["k"]).collect()}
    c = math.cos(math.radians(np.mean([x[8] for x in seg])))
    for k, lat, lon, mph, deg in pts:
        best = []
        for i, _, _, one, a1, o1, a2, o2, ca, co, b in seg:
            kx, ky = 111000 * c, 111000
            if (lon * kx - co * kx) ** 2 + (lat * ky - ca * ky) ** 2 > 1e4:
                continue
            dx, dy = (o2 - o1) * kx, (a2 - a1) * ky
            u = min(1, max(0, ((lon - o1) * kx * dx + (lat - a1) * ky * dy) / (dx * dx + dy * dy or 1)))
            d = math.hypot((lon - o1) * kx - u * dx, (lat - a1) * ky - u * dy)
            if d <= 15:
                turn = lambda x, y: min((x - y) % 360, (y - x) % 360)
                w = turn(deg, b) if one else min(turn(deg, b), turn(deg, b + 180))
                best.append((not (mph >= 2 and w <= 60), d, i))
        want = ("no_match", None) if not best else ("distance_only" if min(best)[0] else "direction", min(best)[2])
        assert got[k] == want
    assert {r.match_type for r in matching.match_segments(p, s.limit(0), ["k"]).collect()} == {"no_match"}


def test_roads(spark):
    kind = "type string, id long, lat double, lon double, nodes array<long>, tags map<string,string>"
    nodes = [("node", i, 37.8, -122.3 + i * 0.001, None, None) for i in range(6)] + [("node", 10, 37.801, -122.298, None, None)]
    ways = [
        ("way", 100, None, None, [0, 1, 2, 3], {"highway": "residential", "name": "A", "oneway": "-1"}),
        ("way", 101, None, None, [2, 10], {"highway": "residential", "name": "B"}),
        ("way", 102, None, None, [4, 99], {"highway": "residential"}),
        ("way", 103, None, None, [4, 5], {"highway": "path"}),
        ("way", 104, None, None, [4, 5], {"highway": "service", "service": "alley", "name": "C"}),
    ]
    el = spark.createDataFrame([*nodes, *ways], kind)
    got = {r.way_id: r for r in roads.cluster_directions(roads.parse_roads(el)).collect()}
    assert set(got) == {100, 101, 104}
    assert got[100].oneway and got[100].coords[0].lon == pytest.approx(-122.297) and abs(got[100].rd_deg - 270) < 1
    assert got[101].cluster == -1 and got[100].cluster == 0
    table = roads.build_segments(el, 30.0).orderBy("segment_id").collect()
    assert [r.segment_id for r in table] == list(range(len(table)))
    assert sum(r.highway == "service" for r in roads.without_service(roads.build_segments(el)).collect()) == 0
    cut = roads.split_at_crossings(roads.parse_roads(el), el)
    assert sorted(len(r.coords) for r in cut.filter("way_id = 100").collect()) == [2, 3]
    short = spark.createDataFrame([([(37.8, -122.3), (37.80001, -122.3), (37.80002, -122.3)],)], "coords array<struct<lat:double,lon:double>>")
    one = roads.segmentise(short.withColumns({"rd_type": F.lit("x"), "rd_name": F.lit("x")})).collect()
    assert len(one) == 1 and one[0].center_lat == 37.80001


def test_cuts_follow_nodes_and_repeats_dissolve(spark):
    kind = "type string, id long, lat double, lon double, nodes array<long>, tags map<string,string>"
    nodes = [("node", i, 37.8, -122.0 + i * 0.001, None, None) for i in range(12)]
    a, b, c = ({"highway": "residential", "name": n, "oneway": o} for n, o in (("A", "-1"), ("B", "no"), ("C", "no")))
    ways = [
        (1, [0, 1, 2, 3], a), (2, [4, 2], a),  # turned, share node 2
        (3, [5, 99, 6, 7, 8], b), (4, [9, 7], b),  # node 99 is unknown, 6 and 7 are shared
        (5, [6, 11], c),  # shares node 6 with a way of another group
        (6, [8, 7, 9], b),  # repeats both a part of 3 and all of 4
    ]
    el = spark.createDataFrame([*nodes, *(("way", k, None, None, n, t) for k, n, t in ways)], kind)
    cut = roads.split_at_crossings(roads.cluster_directions(roads.parse_roads(el)), el).collect()
    got = sorted((r.way_id, [round((p.lon + 122) * 1000) for p in r.coords]) for r in cut)
    assert got == [(1, [2, 1, 0]), (1, [3, 2]), (2, [2, 4]), (3, [5, 6]), (3, [6, 7]), (3, [7, 8]), (4, [9, 7]), (5, [6, 11])]


def test_geometry(spark):
    one = spark.range(1)
    x = lambda c: one.select(c.alias("x")).first()[0]
    lit = lambda *v: [F.lit(float(k)) for k in v]
    assert x(geo.haversine(*lit(0, 0, 0, 1))) == pytest.approx(111194.93, abs=0.01)
    assert x(geo.bearing(*lit(0, 0, 0, 1))) == pytest.approx(90)
    assert x(geo.angle_between(*lit(350, 10), F.lit(True))) == 20
    assert x(geo.angle_between(*lit(350, 190), F.lit(False))) == pytest.approx(20)
    assert x(geo.cell(F.lit(-122.31), 0.1)) == -122.4
    assert len(x(geo.ring(*lit(1, 2), 0.1))) == 5


def test_outside_keeps_unplaced_rows(spark):
    rings = spark.createDataFrame([([(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)],)], "ring array<struct<lat:double,lon:double>>")
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 1.0), (3, None, None)], "k int, latitude double, longitude double")
    assert sorted(column(output.outside(df, rings), "k")) == [2, 3]
    assert sorted(column(output.outside(df, rings.limit(0)), "k")) == [1, 2, 3]


def test_find_targets(spark):
    rows = []
    for s in range(200):
        on = 1.0 if 50 <= s < 150 else 0.0
        for p, v in (("cal_valve", on), ("zero_valve", on), ("cal_flow", 1.0), ("zero_flow", 500.0), ("C6H7", 7.0)):
            rows.append(("d", t(s), "Vocus-PTR-ToF", p, v))
        for p, v in (("Inlet_Number", on), ("CH4", 2.5)):
            rows.append(("d", t(s), "Aeris_CH4_C2H6", p, v))
    df = spark.createDataFrame(rows, "day string, sample_time timestamp, instrument string, parameter string, value double")
    standards = spark.createDataFrame([("c1", "C6H7", 1000.0), ("c1", "CH4", 2000.0), ("c1", "CO", 0.0)], "cylinder_number string, species string, cal_concs double")
    want = targets.requested(spark, ["Vocus-PTR-ToF", "Aeris_CH4_C2H6"], ["c1", "c1"])
    got = targets.find_targets(df, want, standards, ["day"]).collect()
    ion = [r for r in got if r.instrument == "Vocus-PTR-ToF"]
    assert len(ion) == 61 and ion[0].val == pytest.approx(7.0 - 1000 / 501)
    other = [r for r in got if r.instrument != "Vocus-PTR-ToF"]
    assert len(other) == 61 and {round(r.val, 9) for r in other if r.parameter == "CH4"} == {0.5}


def test_calibrate_derives_no2_and_keeps_one(spark):
    rows = [("d", t(0), "EcoPhysics_NOX", "NO", 1.0, "0"), ("d", t(0), "EcoPhysics_NOX", "NOx", 4.0, "2"), ("d", t(0), "EcoPhysics_NOX", "NO", 3.0, "0"), ("d", t(1), "EcoPhysics_NOX", "NO", 1.0, "0")]
    df = spark.createDataFrame(rows, "day string, sample_time timestamp, instrument string, parameter string, value double, summary_flag string")
    cals = spark.createDataFrame([], "instrument string, parameter string, sample_time timestamp, slope double, intercept double")
    zeros = spark.createDataFrame([], "instrument string, parameter string, sample_time timestamp, zero double")
    got = sorted((r.sample_time, r.parameter, r.value) for r in calibration.calibrate(df, cals, zeros, ["day"], ["summary_flag"]).collect())
    assert got == [(t(0), "NO", 1.0), (t(0), "NO2", 2.0), (t(0), "NOx", 4.0), (t(1), "NO", 1.0)]


def test_dates():
    from tracklake.sources.readers import log_name, parse_day

    assert parse_day("20250715") == parse_day("2025-07-15") == date(2025, 7, 15)
    assert "no-geolocations" in log_name(date(2025, 6, 29)) and "drive_range" in log_name(date(2025, 6, 30))


def test_gaps_of_a_whole_day_are_filled_in_one_pass(spark):
    """86,400 seconds, four columns, every third second known: the work must not grow with the square."""
    import time

    day = spark.range(86_400).select(F.lit("d").alias("by"), F.timestamp_seconds("id").alias("t"), *(F.when(F.col("id") % 3 == 0, F.col("id") * (k + 1.0)).alias(f"v{k}") for k in range(4)))
    began = time.time()
    wrong = ordered.fill_gaps(day, ["by"], "t", [f"v{k}" for k in range(4)], 5.0).filter("abs(v3 - 4 * unix_timestamp(t)) > 1e-6 AND unix_timestamp(t) < 86397").count()
    assert wrong == 0 and time.time() - began < 60


def test_groups_are_smoothed_alone_however_batches_cut_them(spark):
    rng = np.random.default_rng(5)
    rows = [(k, None if k == 3 else f"d{k % 2}", float(t), *rng.normal(size=2).tolist()) for k in range(4) for t in range((1, 50, 13, 7)[k])]
    df = spark.createDataFrame(rows, "k int, day string, s double, lat double, lon double").withColumn("at", F.timestamp_seconds("s")).repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = {(r.k, r.s): (r.lat_kf, r.lon_kf) for r in gps.smooth(df, ["day", "k"], "at").collect()}
        whole = gps.smooth(df.filter("k = 1"), [], "at").orderBy("s").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert len(got) == len(rows)
    for k in range(4):
        own = [r for r in rows if r[0] == k]
        want = gps.smooth_axis(np.array([r[2] for r in own]), np.array([r[3:] for r in own]), 1e-9, 1e-10)
        assert all(got[k, r[2]] == pytest.approx(tuple(w), abs=1e-12) for r, w in zip(own, want))
        if k == 1:
            assert [r.lat_kf for r in whole] == pytest.approx(want[:, 0].tolist(), abs=1e-12)
