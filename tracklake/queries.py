"""Queries of the library's operators on the test tables, each with its SQL.

``events`` stands for readings: its type is the instrument, its user modulo four
the parameter, and the user the vehicle.  Positions, calibrations and segments
are arithmetic on keys.  Numbers are compared after rounding half to even.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.functions import clock, geo, numbers, text
from tracklake.operators import calibration, gps, long_tracks, matching, ordered, output, quality, roads, segmented, targets
from tracklake.plans.pipeline import summarise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

INSTRUMENTS = ("click", "error", "purchase", "signup", "view")


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def r(c: Column | str, places: int = 4) -> Column:
    return numbers.round_even(c, places)


def sql_r(e: str, places: int = 4) -> str:
    return f"round_even(({e}) * 1e{places}::DOUBLE, 0) / 1e{places}::DOUBLE"


def readings(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        "event_id", ntz(F.date_trunc("second", "ts")).alias("sample_time"), F.col("event_type").alias("instrument"),
        F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("parameter"), "value", "user_id",
    )


READINGS = """readings AS (
    SELECT event_id, date_trunc('second', ts) AS sample_time, event_type AS instrument,
           'p' || CAST(user_id % 4 AS VARCHAR) AS parameter, value, user_id
    FROM events)"""


def lat_lon(key: str = "event_id", a: int = 37, b: int = 53, scale: float = 1e5) -> tuple[Column, Column]:
    return F.lit(37.8) + (F.col(key) * a % 1000) / F.lit(scale), F.lit(-122.3) + (F.col(key) * b % 1000) / F.lit(scale)


def sql_lat_lon(key: str = "event_id", a: int = 37, b: int = 53, scale: float = 1e5) -> tuple[str, str]:
    return f"(37.8::DOUBLE + ({key} * {a} % 1000) / {scale}::DOUBLE)", f"(-122.3::DOUBLE + ({key} * {b} % 1000) / {scale}::DOUBLE)"


#: Nodes of the map lie on no decimal grid: there, middles of segments would be ties of rounding to six digits.
NODES = ("c_custkey", 7, 11, 99_973.0)


LAT, LON = sql_lat_lon()
THRESHOLDS = [(i, f"p{k}", None if (n, k) == (1, 3) else 2.0 * k + n, 80.0 + 20.0 * k, 2 ** (k + 1)) for n, i in enumerate(INSTRUMENTS) for k in range(4)]
SQL_THRESHOLDS = "thresholds(instrument, parameter, range_start, range_end, flag_value) AS (VALUES " + ", ".join(
    f"('{i}', '{p}', {'NULL' if a is None else a}::DOUBLE, {b}::DOUBLE, {f})" for i, p, a, b, f in THRESHOLDS
) + ")"
SQL_FLAG = "CASE WHEN range_start IS NOT NULL AND range_end IS NOT NULL AND (value < range_start OR value > range_end) THEN flag_value ELSE 0 END"
SQL_FLAG_TEXT = "coalesce(nullif(list_aggregate(list_sort(list_distinct(list(flag) FILTER (WHERE flag <> 0))), 'string_agg', ','), ''), '0')"


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "instrument string, parameter string, range_start double, range_end double, flag_value int")


# flags, lags, filters


@query(f"""
    WITH {READINGS}, {SQL_THRESHOLDS},
    f AS (SELECT r.*, {SQL_FLAG} AS flag FROM readings r LEFT JOIN thresholds t USING (instrument, parameter))
    SELECT CAST(sample_time AS DATE) AS drive_date, instrument, {SQL_FLAG_TEXT} AS summary_flag FROM f GROUP BY ALL""")
def flag_summary(spark, sf):
    rows = quality.with_flags(readings(spark, sf), thresholds(spark))
    return quality.summary_flags(rows.withColumn("drive_date", F.to_date("sample_time")), ["drive_date", "instrument"])


@query(f"""
    WITH {READINGS}, {SQL_THRESHOLDS}
    SELECT event_id, CAST({SQL_FLAG} AS INTEGER) AS flag FROM readings r LEFT JOIN thresholds t USING (instrument, parameter)""")
def range_flags(spark, sf):
    return quality.with_flags(readings(spark, sf), thresholds(spark)).select("event_id", F.col("flag").cast("int").alias("flag"))


@query(f"""
    WITH {READINGS}, {SQL_THRESHOLDS},
    m AS (SELECT *, date_trunc('hour', sample_time) AS hour FROM readings),
    f AS (SELECT m.*, {SQL_FLAG} AS flag FROM m LEFT JOIN thresholds t USING (instrument, parameter)),
    s AS (SELECT hour, instrument, {SQL_FLAG_TEXT} AS summary_flag FROM f GROUP BY ALL)
    SELECT event_id, hour AS sample_time, instrument, parameter, summary_flag FROM f JOIN s USING (hour, instrument)""")
def flag_readings(spark, sf):
    rows = readings(spark, sf).withColumn("sample_time", ntz(F.date_trunc("hour", "sample_time"))).withColumn("string", F.lit(None).cast("string"))
    return quality.flag_readings(rows, thresholds(spark)).select("event_id", "sample_time", "instrument", "parameter", "summary_flag")


LAGS = [("2024-01-01", i, 3 * n) for n, i in enumerate(INSTRUMENTS[:4])]


@query(f"""
    WITH {READINGS}, lags(month, instrument, lag_s) AS (VALUES {", ".join(f"(TIMESTAMP '{m}', '{i}', {s})" for m, i, s in LAGS)})
    SELECT event_id, sample_time - to_seconds(coalesce(lag_s, 0)) AS sample_time, instrument, value
    FROM readings r LEFT JOIN lags l ON date_trunc('month', r.sample_time) = l.month AND r.instrument = l.instrument""".replace("instrument, value", "r.instrument AS instrument, value"))
def lag_shift_month(spark, sf):
    lags = spark.createDataFrame(LAGS, "month string, instrument string, lag_s int").withColumn("month", F.col("month").cast("timestamp"))
    moved = quality.apply_lags(readings(spark, sf), lags)
    return moved.select("event_id", ntz("sample_time").alias("sample_time"), "instrument", "value")


@query("""
    SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS DOUBLE) ELSE value END AS value
    FROM events""")
def status_values(spark, sf):
    e = table(spark, sf, "events")
    shaped = e.select("event_id", "event_type", F.when(F.col("event_type") == "error", "Status").otherwise("x").alias("parameter"), "value",
                      F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("user_id").cast("string"))).alias("string"))
    return quality.status_numbers(shaped).select("event_id", "event_type", "value")


@query("""
    WITH b AS (SELECT user_id, min(ts) AS low, max(ts) AS high FROM events WHERE event_type = 'click' GROUP BY user_id)
    SELECT e.event_id, e.user_id, e.ts FROM events e JOIN b USING (user_id) WHERE e.ts BETWEEN b.low AND b.high""")
def time_window_closed(spark, sf):
    e = table(spark, sf, "events")
    return quality.within_track(e, e.filter("event_type = 'click'"), ["user_id"], "ts").select("event_id", "user_id", "ts")


@query(f"""
    WITH {READINGS}, track AS (SELECT user_id, date_trunc('minute', ts) AS sample_time, max({LAT}) AS lat_smooth, max({LON}) AS lon_smooth FROM events GROUP BY ALL)
    SELECT r.event_id, r.user_id, {sql_r('lat_smooth', 5)} AS lat_smooth, {sql_r('lon_smooth', 5)} AS lon_smooth
    FROM readings r JOIN track t ON r.user_id = t.user_id AND date_trunc('minute', r.sample_time) = t.sample_time""")
def track_join(spark, sf):
    lat, lon = lat_lon()
    e = table(spark, sf, "events").withColumns({"lat": lat, "lon": lon, "sample_time": ntz(F.date_trunc("minute", "ts"))})
    track = e.groupBy("user_id", "sample_time").agg(F.max("lat").alias("lat_smooth"), F.max("lon").alias("lon_smooth"))
    rows = readings(spark, sf).withColumn("sample_time", ntz(F.date_trunc("minute", "sample_time")))
    joined = quality.join_track(rows, track, ["user_id"])
    return joined.select("event_id", "user_id", r("lat_smooth", 5).alias("lat_smooth"), r("lon_smooth", 5).alias("lon_smooth"))


# pivots and cleaning


@query(f"""
    WITH m AS (SELECT make_timestamp(CAST(round_even(epoch_us(ts) / 1e6::DOUBLE, 0) AS BIGINT) * 1000000) AS sample_time, user_id % 4 AS p, value FROM events)
    SELECT sample_time, {", ".join(f"{sql_r(f'avg(value) FILTER (WHERE p = {k})')} AS {n}" for k, n in enumerate(gps.GPS_PARAMETERS.values()))}
    FROM m GROUP BY sample_time""")
def pivot_second_mean(spark, sf):
    names = F.array(*map(F.lit, gps.GPS_PARAMETERS))
    long = table(spark, sf, "events").select(F.col("ts").alias("sample_time"), F.get(names, (F.col("user_id") % 4).cast("int")).alias("parameter"), "value")
    return gps.pivot_track(long, []).select(ntz("sample_time").alias("sample_time"), *(r(c).alias(c) for c in gps.GPS_PARAMETERS.values()))


@query(f"""
    WITH {READINGS}
    SELECT CAST(sample_time AS DATE) AS day, instrument, {", ".join(f"arg_max(value, event_id) FILTER (WHERE parameter = 'p{k}') AS p{k}" for k in range(4))}
    FROM readings GROUP BY ALL""")
def pivot_last(spark, sf):
    rows = readings(spark, sf).withColumn("day", F.to_date("sample_time"))
    return gps.pivot_last(rows, ["day", "instrument"], ["p0", "p1", "p2", "p3"], ["event_id"])


@query(f"""
    WITH m AS (SELECT event_id, date_trunc('hour', ts) AS sample_time, CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 13 = 0 THEN NULL ELSE {LAT} END AS lat, {LON} AS lon FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY sample_time ORDER BY event_id) AS k FROM m WHERE lat IS NOT NULL AND lat <> 0 AND lon <> 0)
    SELECT event_id, sample_time, {sql_r('lat', 5)} AS lat, {sql_r('lon', 5)} AS lon FROM n WHERE k = 1""")
def coord_clean_dedup(spark, sf):
    lat, lon = lat_lon()
    lat = F.when(F.col("event_id") % 11 == 0, F.lit(0.0)).when(F.col("event_id") % 13 != 0, lat)
    e = table(spark, sf, "events").select("event_id", ntz(F.date_trunc("hour", "ts")).alias("sample_time"), lat.alias("lat"), lon.alias("lon"))
    return gps.clean_track(e, [], tiebreak=["event_id"]).select("event_id", "sample_time", r("lat", 5).alias("lat"), r("lon", 5).alias("lon"))


# grids and gaps

GRID = """m AS (SELECT CAST(ts AS DATE) AS day, date_trunc('minute', ts) AS t, avg(value) AS value FROM events GROUP BY ALL),
    b AS (SELECT day, min(t) AS low, max(t) AS high FROM m GROUP BY day),
    g AS (SELECT day, unnest(generate_series(low, high, INTERVAL 1 MINUTE)) AS t FROM b),
    d AS (SELECT g.day, g.t, m.value FROM g LEFT JOIN m ON g.day = m.day AND g.t = m.t)"""


def minutes(spark, sf):
    e = table(spark, sf, "events").select(F.to_date("ts").alias("day"), F.date_trunc("minute", "ts").alias("t"), "value")
    return ordered.densify(e.groupBy("day", "t").agg(F.avg("value").alias("value")), ["day"], "t", 60)


@query(f"WITH {GRID} SELECT day, t, {sql_r('value')} AS value FROM d")
def densify_left(spark, sf):
    return minutes(spark, sf).select("day", ntz("t").alias("t"), r("value").alias("value"))


@query(f"""
    WITH {GRID},
    a AS (SELECT *, CASE WHEN value IS NOT NULL THEN t END AS ta FROM d),
    w AS (SELECT *, last_value(ta IGNORE NULLS) OVER p AS tp, last_value(value IGNORE NULLS) OVER p AS vp, first_value(ta IGNORE NULLS) OVER n AS tn, first_value(value IGNORE NULLS) OVER n AS vn
          FROM a WINDOW p AS (PARTITION BY day ORDER BY t ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY day ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    v AS (SELECT day, t, CASE WHEN value IS NOT NULL THEN value WHEN tp IS NULL OR (epoch_us(t) - epoch_us(tp)) / 1e6::DOUBLE > 300 THEN NULL WHEN tn IS NULL THEN vp
          ELSE vp + (vn - vp) * ((epoch_us(t) - epoch_us(tp))::DOUBLE / (epoch_us(tn) - epoch_us(tp))::DOUBLE) END AS value FROM w)
    SELECT day, t, {sql_r('value')} AS value FROM v""")
def gap_interp(spark, sf):
    return ordered.fill_gaps(minutes(spark, sf), ["day"], "t", ["value"], 300.0).select("day", ntz("t").alias("t"), r("value").alias("value"))


@query(ORACLE_SQL["gap_interp"])
def gap_interp_scan(spark, sf):
    """A day's rows over many tasks."""
    return segmented.fill_gaps(minutes(spark, sf), ["day"], "t", ["value"], 300.0).select("day", ntz("t").alias("t"), r("value").alias("value"))


# sessions


def _sessions_sql(op: str, seconds: int) -> str:
    return f"""g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
    s AS (SELECT *, sum(CASE WHEN prev IS NULL OR (epoch_us(ts) - epoch_us(prev)) / 1e6::DOUBLE {op} {seconds} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS period FROM g)"""


@query(f"WITH {_sessions_sql('>=', 3600)} SELECT event_id, CAST(period AS BIGINT) AS period FROM s")
def periods_ge(spark, sf):
    return ordered.sessions(table(spark, sf, "events"), ["user_id"], "ts", 3600, True, ["ts", "event_id"]).select("event_id", F.col("period").cast("bigint").alias("period"))


@query(f"WITH {_sessions_sql('>', 3600)} SELECT user_id, CAST(period AS BIGINT) AS period, count(*) AS n, min(ts) AS first, max(ts) AS last FROM s GROUP BY ALL")
def sessions_gt(spark, sf):
    numbered = ordered.sessions(table(spark, sf, "events"), ["user_id"], "ts", 3600, False, ["ts", "event_id"])
    return numbered.groupBy("user_id", F.col("period").cast("bigint").alias("period")).agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query(ORACLE_SQL["sessions_gt"])
def sessions_gt_scan(spark, sf):
    """A user's rows over many tasks."""
    numbered = segmented.sessions(table(spark, sf, "events"), ["user_id"], "ts", 3600, False, ["ts", "event_id"], bucket_s=86_400.0)
    return numbered.groupBy("user_id", F.col("period").cast("bigint").alias("period")).agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query(f"""
    WITH {_sessions_sql('>', 21600)},
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id, period ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY user_id, period) AS m FROM s)
    SELECT user_id, CAST(period AS BIGINT) AS flag, {sql_r('avg(value)')} AS value, make_timestamp(CAST(floor(avg(epoch_us(ts))) AS BIGINT)) AS ts
    FROM n WHERE m >= 7 AND k BETWEEN 2 AND 7 GROUP BY user_id, period""")
def session_tail_mean(spark, sf):
    out = ordered.session_means(table(spark, sf, "events"), ["user_id"], "ts", 21600, 7, 6, ["value"], ["ts", "event_id"])
    return out.select("user_id", F.col("flag").cast("bigint").alias("flag"), r("value").alias("value"), ntz("ts").alias("ts"))


@query(f"""
    WITH {_sessions_sql('>=', 10800)}, e AS (SELECT *, max(ts) OVER (PARTITION BY user_id, period) AS last FROM s)
    SELECT event_id, user_id, CAST(period AS BIGINT) AS period FROM e WHERE (epoch_us(last) - epoch_us(ts)) / 1e6::DOUBLE BETWEEN 600 AND 4200""")
def period_tail_window(spark, sf):
    numbered = ordered.sessions(table(spark, sf, "events"), ["user_id"], "ts", 10800, True, ["ts", "event_id"])
    return ordered.tail_seconds(numbered, ["user_id", "period"], "ts", 3600, 600).select("event_id", "user_id", F.col("period").cast("bigint").alias("period"))


@query("""
    WITH g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6::DOUBLE AS gap_s FROM events)
    SELECT event_id, user_id, gap_s FROM g""")
def lagged_difference(spark, sf):
    return ordered.since_previous(table(spark, sf, "events"), ["user_id"], "ts", ["ts", "event_id"]).select("event_id", "user_id", "gap_s")


# tracks


@query("""
    WITH k AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 5 <> 0 THEN event_id % 3 END AS c FROM events),
    m AS (SELECT *, c IS NOT NULL AND c IS DISTINCT FROM lag(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS fresh FROM k),
    s AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM m)
    SELECT event_id, CAST(CASE WHEN c IS NOT NULL THEN n END AS BIGINT) AS drive_pass FROM s""")
def drive_pass(spark, sf):
    c = F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 3)
    e = table(spark, sf, "events").withColumns({"lat": c / 1000.0, "lon": c / 500.0})
    return ordered.passes(e, ["user_id"], ["ts", "event_id"], "lat", "lon").select("event_id", F.col("drive_pass").cast("bigint").alias("drive_pass"))


@query(f"""
    WITH f AS (SELECT user_id % 4 AS car, make_timestamp(1704067200000000 + CAST(round_even(event_id * 2 / 5::DOUBLE, 0) AS BIGINT) * 1000000) AS t, value FROM events),
    m AS (SELECT car, t, avg(value) AS value FROM f GROUP BY ALL),
    g AS (SELECT car, unnest(generate_series(min(t), max(t), INTERVAL 1 SECOND)) AS t FROM m GROUP BY car),
    d AS (SELECT g.car AS car, g.t AS t, value, CASE WHEN value IS NOT NULL THEN g.t END AS ta FROM g LEFT JOIN m ON m.car = g.car AND m.t = g.t),
    w AS (SELECT *, last_value(ta IGNORE NULLS) OVER p AS tp, last_value(value IGNORE NULLS) OVER p AS vp, first_value(ta IGNORE NULLS) OVER n AS tn, first_value(value IGNORE NULLS) OVER n AS vn
          FROM d WINDOW p AS (PARTITION BY car ORDER BY t ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY car ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT car, t AS sample_time, {sql_r('value')} AS lat, {sql_r("""CASE WHEN value IS NOT NULL THEN value WHEN (epoch_us(t) - epoch_us(tp)) / 1e6::DOUBLE > 5 THEN NULL
           ELSE vp + (vn - vp) * ((epoch_us(t) - epoch_us(tp))::DOUBLE / (epoch_us(tn) - epoch_us(tp))::DOUBLE) END""")} AS lat_kf FROM w""")
def track_1hz(spark, sf):
    """Several fixes a second and gaps of many: means, and what is filled in between."""
    at = F.timestamp_micros(F.lit(1704067200000000) + F.col("event_id") * 400_000)
    names = ("lat", "lon", "lat_kf", "lon_kf", "car_speed_mph", "car_bearing_deg")
    e = table(spark, sf, "events").select((F.col("user_id") % 4).alias("car"), at.alias("sample_time"), *(F.col("value").alias(n) for n in names))
    return gps.to_1hz(e, ["car"]).select("car", ntz("sample_time").alias("sample_time"), r("lat").alias("lat"), r("lat_kf").alias("lat_kf"))


@query(ORACLE_SQL["drive_pass"])
def drive_pass_scan(spark, sf):
    """A user's rows over many tasks."""
    c = F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 3)
    e = table(spark, sf, "events").withColumns({"lat": c / 1000.0, "lon": c / 500.0})
    return segmented.passes(e, ["user_id"], ["ts", "event_id"], "lat", "lon", bucket_s=86_400.0).select("event_id", F.col("drive_pass").cast("bigint").alias("drive_pass"))


def sql_haversine(a1: str, o1: str, a2: str, o2: str) -> str:
    s = f"(pow(sin(radians(({a2}) - ({a1})) / 2), 2) + cos(radians({a1})) * cos(radians({a2})) * pow(sin(radians(({o2}) - ({o1})) / 2), 2))"
    return f"(12742000.0::DOUBLE * atan2(sqrt({s}), sqrt(1 - {s})))"


def sql_bearing(a1: str, o1: str, a2: str, o2: str) -> str:
    d = f"radians(({o2}) - ({o1}))"
    y = f"cos(radians({a1})) * sin(radians({a2})) - sin(radians({a1})) * cos(radians({a2})) * cos({d})"
    return f"(degrees(atan2(sin({d}) * cos(radians({a2})), {y})) + 360) % 360"


@query(f"""
    WITH p AS (SELECT event_id, user_id, ts, {LAT} AS lat, {LON} AS lon FROM events),
    l AS (SELECT *, lag(lat) OVER w AS la, lag(lon) OVER w AS lo, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6::DOUBLE AS dt FROM p WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, {sql_r(f"CASE WHEN dt IS NULL OR dt <= 0 THEN 0 ELSE {sql_haversine('la', 'lo', 'lat', 'lon')} / dt * 2.23694::DOUBLE END")} AS car_speed_mph,
           {sql_r(f"CASE WHEN dt IS NULL THEN 0 ELSE {sql_bearing('la', 'lo', 'lat', 'lon')} END", 3)} AS car_bearing_deg
    FROM l""")
def speed_bearing(spark, sf):
    lat, lon = lat_lon()
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", lat.alias("lat_kf"), lon.alias("lon_kf"))
    out = gps.speed_bearing(e, ["user_id"], "ts", order=["ts", "event_id"])
    return out.select("event_id", r("car_speed_mph").alias("car_speed_mph"), r("car_bearing_deg", 3).alias("car_bearing_deg"))


LAT2, LON2 = sql_lat_lon("event_id", 39, 51)


@query(f"""
    WITH p AS (SELECT event_id, {LAT} AS lat, {LON} AS lon, {LAT2} AS a, {LON2} AS o FROM events),
    d AS (SELECT *, {sql_haversine('lat', 'lon', 'a', 'o')} > 15 AS far FROM p)
    SELECT event_id, {sql_r('CASE WHEN far THEN lat ELSE a END', 5)} AS lat_kf, {sql_r('CASE WHEN far THEN lon ELSE o END', 5)} AS lon_kf FROM d""")
def displacement_guard(spark, sf):
    (lat, lon), (a, o) = lat_lon(), lat_lon("event_id", 39, 51)
    e = table(spark, sf, "events").select("event_id", lat.alias("lat"), lon.alias("lon"), a.alias("lat_kf"), o.alias("lon_kf"))
    return gps.guard_displacement(e).select("event_id", r("lat_kf", 5).alias("lat_kf"), r("lon_kf", 5).alias("lon_kf"))


@query(f"""
    WITH RECURSIVE p AS (SELECT event_id, CAST(ts AS DATE) AS day, user_id, epoch_us(ts) / 1e6::DOUBLE AS t, {LAT} AS lat, {LON} AS lon FROM events),
    s AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY day, user_id) AS n, CASE WHEN t > lag(t) OVER w THEN t - lag(t) OVER w ELSE 1 END AS dt FROM p WINDOW w AS (PARTITION BY day, user_id ORDER BY t)),
    f AS (
        SELECT day, user_id, k, n, event_id, dt, lat AS x, 0::DOUBLE AS v, lon AS y, 0::DOUBLE AS w, 1e-6::DOUBLE AS a, 0::DOUBLE AS b, 1e-6::DOUBLE AS c,
               lat AS gx, 0::DOUBLE AS gv, lon AS gy, 0::DOUBLE AS gw, 0::DOUBLE AS a1, 0::DOUBLE AS b1, 0::DOUBLE AS c1 FROM s WHERE k = 1
        UNION ALL
        SELECT day, user_id, k, n, event_id, dt, gx + a1 / (a1 + 1e-10) * (lat - gx), gv + b1 / (a1 + 1e-10) * (lat - gx), gy + a1 / (a1 + 1e-10) * (lon - gy), gw + b1 / (a1 + 1e-10) * (lon - gy),
               a1 - a1 * a1 / (a1 + 1e-10), b1 - b1 * a1 / (a1 + 1e-10), c1 - b1 * b1 / (a1 + 1e-10), gx, gv, gy, gw, a1, b1, c1
        FROM (SELECT s.*, f.x + f.v * s.dt AS gx, f.v AS gv, f.y + f.w * s.dt AS gy, f.w AS gw, f.a + s.dt * (2 * f.b + s.dt * f.c) + 1e-9 * s.dt * s.dt * s.dt / 3 AS a1,
                     f.b + s.dt * f.c + 1e-9 * s.dt * s.dt / 2 AS b1, f.c + 1e-9 * s.dt AS c1
              FROM f JOIN s ON f.day = s.day AND f.user_id = s.user_id AND s.k = f.k + 1)),
    r AS (
        SELECT day, user_id, k, event_id, x AS rx, v AS rv, y AS ry, w AS rw, gx, gv, gy, gw, a1, b1, c1, dt FROM f WHERE k = n
        UNION ALL
        SELECT day, user_id, k, event_id, x + j1 * ex + j2 * ev, v + j3 * ex + j4 * ev, y + j1 * ey + j2 * ew, w + j3 * ey + j4 * ew, gx, gv, gy, gw, a1, b1, c1, dt
        FROM (SELECT f.*, r.rx - r.gx AS ex, r.rv - r.gv AS ev, r.ry - r.gy AS ey, r.rw - r.gw AS ew,
                     ((f.a + r.dt * f.b) * r.c1 - f.b * r.b1) / (r.a1 * r.c1 - r.b1 * r.b1) AS j1, (f.b * r.a1 - (f.a + r.dt * f.b) * r.b1) / (r.a1 * r.c1 - r.b1 * r.b1) AS j2,
                     ((f.b + r.dt * f.c) * r.c1 - f.c * r.b1) / (r.a1 * r.c1 - r.b1 * r.b1) AS j3, (f.c * r.a1 - (f.b + r.dt * f.c) * r.b1) / (r.a1 * r.c1 - r.b1 * r.b1) AS j4
              FROM r JOIN f ON f.day = r.day AND f.user_id = r.user_id AND f.k = r.k - 1))
    SELECT event_id, {sql_r('rx', 5)} AS lat_kf, {sql_r('ry', 5)} AS lon_kf FROM r""")
def kalman_rts(spark, sf):
    lat, lon = lat_lon()
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"), "user_id", F.col("ts").alias("sample_time"), lat.alias("lat"), lon.alias("lon"))
    return gps.smooth(e, ["day", "user_id"]).select("event_id", r("lat_kf", 5).alias("lat_kf"), r("lon_kf", 5).alias("lon_kf"))


@query(ORACLE_SQL["kalman_rts"])
def kalman_rts_blocks(spark, sf):
    """Tracks by blocks of six hours, which meet in the summaries of a day."""
    lat, lon = lat_lon()
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"), "user_id", F.col("ts").alias("sample_time"), lat.alias("lat"), lon.alias("lon"))
    return long_tracks.smooth(e, ["day", "user_id"], block_s=21_600).select("event_id", r("lat_kf", 5).alias("lat_kf"), r("lon_kf", 5).alias("lon_kf"))


REF = 37.805


def segments(spark, sf):
    lat, lon = lat_lon("s_suppkey", 41, 59)
    s = table(spark, sf, "supplier").withColumns({"a": lat, "o": lon})
    half = F.lit(0.0002)
    return s.select(
        F.col("s_suppkey").alias("segment_id"), F.col("s_name").alias("road_name"), F.lit("residential").alias("highway"), (F.col("s_suppkey") % 2 == 0).alias("oneway"),
        (F.col("a") - half).alias("start_lat"), F.col("o").alias("start_lon"), (F.col("a") + half).alias("end_lat"), (F.col("o") + half).alias("end_lon"),
        F.col("a").alias("center_lat"), (F.col("o") + half / 2).alias("center_lon"), (F.col("s_suppkey") * 31 % 360).cast("double").alias("bearing_deg"),
    )


_SA, _SO = sql_lat_lon("s_suppkey", 41, 59)
_TURN = "least((deg - b + 720) % 360, (b - deg + 720) % 360)"
_TURN2 = "least((deg - b + 540) % 360, (b + 180 - deg + 720) % 360)"


@query(f"""
    WITH p AS (SELECT event_id, {LAT} AS lat, {LON} AS lon, value / 10 AS mph, CAST(event_id * 7 % 360 AS DOUBLE) AS deg FROM events),
    s AS (SELECT s_suppkey AS segment_id, {_SA} AS a, {_SO} AS o, s_suppkey % 2 = 0 AS oneway, CAST(s_suppkey * 31 % 360 AS DOUBLE) AS b FROM supplier),
    c AS (SELECT *, 111000.0::DOUBLE * cos(radians({REF}::DOUBLE)) AS kx, 111000.0::DOUBLE AS ky FROM p CROSS JOIN s),
    x AS (SELECT *, lon * kx AS px, lat * ky AS py, (o + 0.0002::DOUBLE / 2) * kx AS cx, a * ky AS cy, o * kx AS ax, (a - 0.0002::DOUBLE) * ky AS ay, (o + 0.0002::DOUBLE) * kx AS bx, (a + 0.0002::DOUBLE) * ky AS byy FROM c),
    n AS (SELECT *, greatest(0, least(1, ((px - ax) * (bx - ax) + (py - ay) * (byy - ay)) / ((bx - ax) * (bx - ax) + (byy - ay) * (byy - ay)))) AS t FROM x WHERE pow(px - cx, 2) + pow(py - cy, 2) <= 10000),
    d AS (SELECT *, sqrt(pow(px - (ax + t * (bx - ax)), 2) + pow(py - (ay + t * (byy - ay)), 2)) AS dist, CASE WHEN oneway THEN {_TURN} ELSE least({_TURN}, {_TURN2}) END AS turn FROM n),
    f AS (SELECT *, mph >= 2 AND turn <= 60 AS fits FROM d WHERE dist <= 15),
    k AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY NOT fits, dist, segment_id) AS rank FROM f)
    SELECT p.event_id, k.segment_id, CASE WHEN k.event_id IS NULL THEN 'no_match' WHEN k.fits THEN 'direction' ELSE 'distance_only' END AS match_type, {sql_r('k.dist', 3)} AS match_distance_m
    FROM p LEFT JOIN k ON p.event_id = k.event_id AND k.rank = 1""")
def haversine_nearest(spark, sf):
    lat, lon = lat_lon()
    e = table(spark, sf, "events").select("event_id", lat.alias("lat_kf"), lon.alias("lon_kf"), (F.col("value") / 10).alias("car_speed_mph"), (F.col("event_id") * 7 % 360).cast("double").alias("car_bearing_deg"))
    out = matching.match_segments(e, segments(spark, sf), ["event_id"], ref_lat=REF)
    return out.select("event_id", "segment_id", "match_type", r("match_distance_m", 3).alias("match_distance_m"))


@query(f"""
    WITH a AS (SELECT event_id, CAST(event_id * 7 % 360 AS DOUBLE) AS deg, CAST(user_id * 31 % 360 AS DOUBLE) AS b, event_id % 2 = 0 AS oneway FROM events)
    SELECT event_id, CASE WHEN oneway THEN {_TURN} ELSE least({_TURN}, {_TURN2}) END AS turn FROM a""")
def angle_match(spark, sf):
    a, b = (F.col("event_id") * 7 % 360).cast("double"), (F.col("user_id") * 31 % 360).cast("double")
    return table(spark, sf, "events").select("event_id", geo.angle_between(a, b, F.col("event_id") % 2 == 0).alias("turn"))


RINGS = [[(37.801, -122.299), (37.8, -122.296), (37.804, -122.295), (37.805, -122.298), (37.801, -122.299)], [(37.806, -122.2985), (37.806, -122.2925), (37.8088, -122.2955), (37.806, -122.2985)]]


def _sql_ring(ring) -> str:
    edges = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for (a, b), (c, d) in zip(ring, ring[1:]))
    return f"(SELECT count(*) FILTER (WHERE (a1 > lat) <> (a2 > lat) AND lon < o1 + (lat - a1) * (o2 - o1) / (a2 - a1)) % 2 = 1 FROM (VALUES {edges}) v(a1, o1, a2, o2))"


@query(f"WITH p AS (SELECT event_id, {LAT} AS lat, {LON} AS lon FROM events) SELECT event_id FROM p WHERE NOT {_sql_ring(RINGS[0])} AND NOT {_sql_ring(RINGS[1])}")
def point_in_polygon(spark, sf):
    lat, lon = lat_lon()
    rings = spark.createDataFrame([(x,) for x in RINGS], "ring array<struct<lat:double,lon:double>>")
    return output.outside(table(spark, sf, "events").select("event_id", lat.alias("latitude"), lon.alias("longitude")), rings).select("event_id")


@query("""
    WITH p AS (SELECT 30 + user_id * 0.037::DOUBLE AS lat, -120 - user_id * 0.051::DOUBLE AS lon FROM events)
    SELECT DISTINCT round_even(floor(lat / 0.1::DOUBLE) * 0.1::DOUBLE * 10, 0) / 10 AS cell_lat, round_even(floor(lon / 0.1::DOUBLE) * 0.1::DOUBLE * 10, 0) / 10 AS cell_lon FROM p""")
def grid_cells(spark, sf):
    u = F.col("user_id")
    return roads.cells_of(table(spark, sf, "events").select((F.lit(30) + u * F.lit(0.037)).alias("lat"), (F.lit(-120) - u * F.lit(0.051)).alias("lon")))


# calibration


def calibrations(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.get(F.array(*map(F.lit, INSTRUMENTS)), (k % 5).cast("int")).alias("instrument"), F.concat(F.lit("p"), (F.floor(k / 5) % 4).cast("string")).alias("parameter"),
        ntz(F.timestamp_micros(F.lit(1703894400000000) + k * 25200000000)).alias("sample_time"), (1 + F.col("s_acctbal") / 1e5).alias("slope"), (k / 100.0).alias("intercept"), (k % 17 / 10.0).alias("zero"),
    )


CALS = f"""cals AS (SELECT ({list(INSTRUMENTS)})[CAST(s_suppkey % 5 AS INTEGER) + 1] AS instrument, 'p' || CAST((s_suppkey // 5) % 4 AS VARCHAR) AS parameter,
    make_timestamp(1703894400000000 + s_suppkey * 25200000000) AS t, 1 + s_acctbal / 1e5::DOUBLE AS slope, s_suppkey / 100.0::DOUBLE AS intercept, (s_suppkey % 17) / 10.0::DOUBLE AS zero FROM supplier)"""


@query(f"""
    WITH {READINGS}, {CALS},
    b AS (SELECT CAST(sample_time AS DATE) AS day, instrument, parameter, min(sample_time) AS low, max(sample_time) AS high FROM readings GROUP BY ALL),
    a AS (SELECT b.day, b.instrument, b.parameter, arg_max(struct_pack(t := t, s := slope, i := intercept), t) FILTER (WHERE t < low) AS x, arg_min(struct_pack(t := t, s := slope, i := intercept), t) FILTER (WHERE t > high) AS y
          FROM b JOIN cals c ON b.instrument = c.instrument AND b.parameter = c.parameter GROUP BY ALL),
    j AS (SELECT r.*, x, y, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN (epoch_us(sample_time) - epoch_us(x.t))::DOUBLE / (epoch_us(y.t) - epoch_us(x.t))::DOUBLE END AS w
          FROM readings r LEFT JOIN a ON CAST(r.sample_time AS DATE) = a.day AND r.instrument = a.instrument AND r.parameter = a.parameter),
    v AS (SELECT event_id, value, CASE WHEN x IS NULL AND y IS NULL THEN 1 WHEN w IS NOT NULL THEN x.s + (y.s - x.s) * w ELSE coalesce(x, y).s END AS slope,
          CASE WHEN x IS NULL AND y IS NULL THEN 0 WHEN w IS NOT NULL THEN x.i + (y.i - x.i) * w ELSE coalesce(x, y).i END AS intercept FROM j)
    SELECT event_id, {sql_r('slope', 6)} AS slope, {sql_r('intercept', 6)} AS intercept, {sql_r('(value - 0 - intercept) / slope')} AS value FROM v""")
def cal_bracket_run(spark, sf):
    rows = readings(spark, sf).withColumn("day", F.to_date("sample_time"))
    out = calibration.bracket_runs(rows, calibrations(spark, sf), ["day", "instrument", "parameter"])
    value = numbers.calibrated(F.col("value"), F.lit(0.0), F.col("intercept"), F.col("slope"))
    return out.select("event_id", r("slope", 6).alias("slope"), r("intercept", 6).alias("intercept"), r(value).alias("value"))


@query(f"""
    WITH {READINGS}, {CALS},
    z AS (SELECT instrument, parameter, t, zero, lead(t) OVER w AS t2, lead(zero) OVER w AS z2, row_number() OVER w AS k, count(*) OVER (PARTITION BY instrument, parameter) AS n FROM cals WINDOW w AS (PARTITION BY instrument, parameter ORDER BY t)),
    i AS (SELECT *, CASE WHEN k > 1 THEN t END AS low, CASE WHEN k < n - 1 THEN t2 END AS high FROM z WHERE n >= 2 AND t2 IS NOT NULL),
    j AS (SELECT r.event_id, i.t, i.zero, i.t2, i.z2, r.sample_time FROM readings r LEFT JOIN i ON r.instrument = i.instrument AND r.parameter = i.parameter AND (low IS NULL OR r.sample_time > low) AND (high IS NULL OR r.sample_time <= high))
    SELECT event_id, {sql_r("coalesce(zero + (z2 - zero) * ((epoch_us(sample_time) - epoch_us(t))::DOUBLE / (epoch_us(t2) - epoch_us(t))::DOUBLE), 0)")} AS zero FROM j""")
def zero_bracket_row(spark, sf):
    keys = ["instrument", "parameter"]
    lines = calibration.zero_lines(calibrations(spark, sf), keys)
    return calibration.add_zero(readings(spark, sf), lines, keys, "sample_time").select("event_id", r("zero").alias("zero"))


@query(f"SELECT l_orderkey, l_linenumber, {sql_r('(l_extendedprice - l_tax - l_discount) / nullif(l_quantity - 25, 0)')} AS value FROM lineitem")
def calibrate_apply(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r(numbers.calibrated(c("l_extendedprice"), c("l_tax"), c("l_discount"), c("l_quantity") - 25)).alias("value"))


@query(f"""
    SELECT date_trunc('hour', ts) AS hour, event_type AS instrument, {sql_r('avg(value) FILTER (WHERE user_id % 4 = 1) - avg(value) FILTER (WHERE user_id % 4 = 0)')} AS value
    FROM events WHERE event_type = 'view' GROUP BY ALL HAVING count(*) FILTER (WHERE user_id % 4 = 1) > 0 AND count(*) FILTER (WHERE user_id % 4 = 0) > 0""")
def derived_difference(spark, sf):
    rows = readings(spark, sf).withColumn("hour", ntz(F.date_trunc("hour", "sample_time")))
    return calibration.derived_difference(rows, ["hour"], "view", "p1", "p0", "d").select("hour", "instrument", r("value").alias("value"))


@query(f"""
    SELECT l_returnflag, {sql_r('sign(covar_pop(l_extendedprice, l_quantity)) * stddev_pop(l_extendedprice) / stddev_pop(l_quantity)', 3)} AS slope,
           {sql_r('avg(l_extendedprice) - sign(covar_pop(l_extendedprice, l_quantity)) * stddev_pop(l_extendedprice) / stddev_pop(l_quantity) * avg(l_quantity)', 3)} AS intercept
    FROM lineitem GROUP BY l_returnflag""")
def rma_regression(spark, sf):
    slope, intercept = calibration.rma("l_extendedprice", "l_quantity")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(r(slope, 3).alias("slope"), r(intercept, 3).alias("intercept"))


RATE_LIST = [("0", 2e-9), ("1", 3e-9), ("2", 5e-9), ("3", 4e-9)]


@query(f"""
    WITH s AS (SELECT l_linestatus, CAST(l_linenumber % 5 AS VARCHAR) AS species, avg(l_quantity) + l_linenumber % 5 AS slope FROM lineitem GROUP BY l_linestatus, l_linenumber % 5),
    k(species, ksens) AS (VALUES {", ".join(f"('{s}', {k}::DOUBLE)" for s, k in RATE_LIST)})
    SELECT l_linestatus, {sql_r('regr_slope(slope, ksens * 1e9::DOUBLE) * 2.5::DOUBLE + regr_intercept(slope, ksens * 1e9::DOUBLE)')} AS ksens FROM s JOIN k USING (species) GROUP BY l_linestatus""")
def ols_regression(spark, sf):
    k = F.col("l_linenumber") % 5
    stats = table(spark, sf, "lineitem").groupBy("l_linestatus", k.cast("string").alias("species")).agg((F.avg("l_quantity") + F.max(k)).alias("slope"))
    rates = spark.createDataFrame(RATE_LIST, "species string, ksens double")
    return calibration.sensitivity(stats, rates, ["l_linestatus"]).select("l_linestatus", r("ksens").alias("ksens"))


@query(f"""
    WITH f AS (SELECT *, l_discount * 100 AS cal_flow, 500.0::DOUBLE + l_linenumber AS zero_flow, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey DESC, l_linenumber DESC) AS k, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem WHERE abs(l_discount * 100 - 5) < 0.1),
    t AS (SELECT * FROM f WHERE n >= 70 AND k BETWEEN 11 AND 70),
    u AS (SELECT l_returnflag, l_shipdate, cal_flow, zero_flow, 'A' AS species, l_quantity AS counts, 10.0::DOUBLE AS conc FROM t UNION ALL SELECT l_returnflag, l_shipdate, cal_flow, zero_flow, 'B', l_extendedprice, 20.0::DOUBLE FROM t)
    SELECT l_returnflag, species, {sql_r('avg(counts)')} AS counts, {sql_r('avg(conc * cal_flow / zero_flow)', 6)} AS cal_conc_dil, make_timestamp(CAST(floor(avg(epoch_us(l_shipdate))) AS BIGINT)) AS date FROM u GROUP BY ALL""")
def step_window_mean(spark, sf):
    c = F.col
    cps = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", c("l_shipdate").alias("date"), (c("l_discount") * 100).alias("cal_flow"), F.lit(1).alias("cal_valve"), F.lit(1).alias("zero_valve"),
                                              (500.0 + c("l_linenumber")).alias("zero_flow"), c("l_quantity").alias("A"), c("l_extendedprice").alias("B"))
    standards = spark.createDataFrame([("A", 10.0), ("B", 20.0)], "species string, cal_concs double")
    out = calibration.step_means(cps, ["l_returnflag"], ["A", "B"], standards, 5.0, 1, 1, order=["l_orderkey", "l_linenumber"])
    return out.select("l_returnflag", "species", r("counts").alias("counts"), r("cal_conc_dil", 6).alias("cal_conc_dil"), ntz("date").alias("date"))


@query("SELECT o_orderpriority, make_timestamp(CAST(floor(avg(epoch_us(o_orderdate))) AS BIGINT)) AS mean_date FROM orders GROUP BY o_orderpriority")
def timestamp_mean(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(ntz(clock.mean_time("o_orderdate")).alias("mean_date"))


@query("SELECT p_type, stddev_samp(p_size) > 0.1 AS varies FROM part GROUP BY p_type")
def no_calibration_guard(spark, sf):
    return calibration.varies(table(spark, sf, "part").withColumn("cal_flow", F.col("p_size")), ["p_type"])


@query("""
    WITH s AS (SELECT p_brand AS parameter, CAST(p_size AS DOUBLE) AS slope, p_size % 3 AS t FROM part),
    m AS (SELECT DISTINCT p_type AS parameter FROM part UNION SELECT DISTINCT p_brand FROM part), x AS (SELECT parameter FROM m WHERE parameter NOT IN (SELECT parameter FROM s)), d AS (SELECT DISTINCT t, t * 10.0::DOUBLE AS ksens FROM s)
    SELECT parameter, CAST(t AS BIGINT) AS t, slope FROM s UNION ALL SELECT x.parameter, CAST(d.t AS BIGINT), d.ksens FROM d CROSS JOIN x""")
def species_fill(spark, sf):
    p = table(spark, sf, "part")
    stats = p.select(F.lit("i").alias("instrument"), F.col("p_brand").alias("parameter"), (F.col("p_size") % 3).alias("sample_time"), F.col("p_size").cast("double").alias("slope")).withColumn("ksens", F.col("sample_time") * 10.0)
    names = p.select(F.col("p_type").alias("parameter")).union(p.select("p_brand"))
    return calibration.fill_species(stats, names).select("parameter", F.col("sample_time").cast("bigint").alias("t"), "slope")


BRACKETED = f"""{READINGS}, {CALS},
    b AS (SELECT CAST(sample_time AS DATE) AS day, instrument, parameter, min(sample_time) AS low, max(sample_time) AS high FROM readings GROUP BY ALL),
    a AS (SELECT b.day, b.instrument, b.parameter, arg_max(struct_pack(t := t, s := slope, i := intercept), t) FILTER (WHERE t < low) AS x, arg_min(struct_pack(t := t, s := slope, i := intercept), t) FILTER (WHERE t > high) AS y
          FROM b JOIN cals c ON b.instrument = c.instrument AND b.parameter = c.parameter GROUP BY ALL),
    j AS (SELECT r.*, x, y, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN (epoch_us(sample_time) - epoch_us(x.t))::DOUBLE / (epoch_us(y.t) - epoch_us(x.t))::DOUBLE END AS w
          FROM readings r LEFT JOIN a ON CAST(r.sample_time AS DATE) = a.day AND r.instrument = a.instrument AND r.parameter = a.parameter),
    v AS (SELECT event_id, sample_time, instrument, parameter, value, CASE WHEN x IS NULL AND y IS NULL THEN 1 WHEN w IS NOT NULL THEN x.s + (y.s - x.s) * w ELSE coalesce(x, y).s END AS slope,
          CASE WHEN x IS NULL AND y IS NULL THEN 0 WHEN w IS NOT NULL THEN x.i + (y.i - x.i) * w ELSE coalesce(x, y).i END AS intercept FROM j)"""


@query(f"""
    WITH {BRACKETED}
    SELECT CAST(sample_time AS DATE) AS day, sample_time, instrument, parameter, {sql_r('min((value - intercept) / slope)')} AS value, '0' AS summary_flag FROM v GROUP BY ALL""")
def calibrate_full(spark, sf):
    rows = readings(spark, sf).select(F.to_date("sample_time").alias("day"), "sample_time", "instrument", "parameter", "value", F.lit("0").alias("summary_flag"))
    cals = calibrations(spark, sf)
    out = calibration.calibrate(rows, cals, cals.select("instrument", "parameter", "sample_time", "zero"), ["day"], ["summary_flag"])
    return out.select("day", "sample_time", "instrument", "parameter", r("value").alias("value"), "summary_flag")


# targets

WINDOWS = f"w AS (SELECT s_suppkey, ({list(INSTRUMENTS)})[CAST(s_suppkey % 5 AS INTEGER) + 1] AS instrument, TIMESTAMP '2024-01-01' + to_seconds(s_suppkey * 3000) AS a, TIMESTAMP '2024-01-01' + to_seconds(s_suppkey * 3000 + 9000) AS b FROM supplier)"


@query(f"WITH {WINDOWS} SELECT e.event_id, w.s_suppkey FROM events e JOIN w ON e.event_type = w.instrument AND e.ts BETWEEN w.a AND w.b")
def range_join_windows(spark, sf):
    k = F.col("s_suppkey")
    at = lambda s: F.expr("TIMESTAMP_NTZ '2024-01-01'") + F.make_dt_interval(secs=(k * 3000 + s).cast("decimal(18,6)"))
    w = table(spark, sf, "supplier").select("s_suppkey", F.get(F.array(*map(F.lit, INSTRUMENTS)), (k % 5).cast("int")).alias("instrument"), at(0).alias("a"), at(9000).alias("b"))
    e = table(spark, sf, "events").select("event_id", "ts", F.col("event_type").alias("instrument"))
    return targets.windows_join(e, w, ["instrument"], "ts", "a", "b", 3600).select("event_id", "s_suppkey")


@query(f"""
    WITH g AS (SELECT CAST(ts AS DATE) AS day, event_type AS instrument, date_trunc('minute', ts) AS t FROM events GROUP BY ALL),
    l AS (SELECT *, lag(t) OVER (PARTITION BY day, instrument ORDER BY t) AS p FROM g),
    s AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch_us(t) - epoch_us(p) >= 3000000 THEN 1 ELSE 0 END) OVER (PARTITION BY day, instrument ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM l),
    w AS (SELECT day, instrument, k, max(t) AS e FROM s GROUP BY ALL),
    c(instrument, parameter, conc) AS (VALUES {", ".join(f"('{i}', 'p{k}', {5.0 * k + n}::DOUBLE)" for n, i in enumerate(INSTRUMENTS) for k in range(4))})
    SELECT x.event_id, {sql_r('x.value - c.conc')} AS val
    FROM (SELECT event_id, CAST(ts AS DATE) AS day, event_type AS instrument, 'p' || CAST(user_id % 4 AS VARCHAR) AS parameter, date_trunc('minute', ts) AS t, value FROM events) x
    JOIN w ON x.day = w.day AND x.instrument = w.instrument AND x.t BETWEEN w.e - INTERVAL 4200 SECOND AND w.e - INTERVAL 600 SECOND
    JOIN c ON x.instrument = c.instrument AND x.parameter = c.parameter""")
def inlet_targets(spark, sf):
    rows = readings(spark, sf).withColumns({"day": F.to_date("sample_time"), "sample_time": F.date_trunc("minute", "sample_time")})
    gates = rows.select("day", "instrument", "sample_time", F.lit(1.0).alias("Inlet_Number")).distinct()
    concs = spark.createDataFrame([(i, f"p{k}", 5.0 * k + n) for n, i in enumerate(INSTRUMENTS) for k in range(4)], "instrument string, parameter string, conc double")
    named = rows.withColumn("parameter", F.concat_ws("#", "parameter", "event_id"))
    wide = concs.join(named.select("instrument", "parameter").distinct(), [concs["instrument"] == named["instrument"], concs["parameter"] == F.split(named["parameter"], "#")[0]]).select(named["instrument"], named["parameter"], "conc")
    found = targets.inlet_targets(named, gates, wide, ["day"], 4200, 600)
    return found.select(F.split("parameter", "#")[1].cast("bigint").alias("event_id"), r("val").alias("val"))


@query(f"""
    SELECT l_orderkey, l_linenumber, {sql_r('l_quantity - p_retailprice / 1000 * (l_discount * 100) / (l_discount * 100 + 1 + l_tax)')} AS val FROM lineitem JOIN part ON l_partkey = p_partkey""")
def target_residual(spark, sf):
    c = F.col
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey"))
    dil = c("p_retailprice") / 1000 * (c("l_discount") * 100) / (c("l_discount") * 100 + 1 + c("l_tax"))
    return joined.select("l_orderkey", "l_linenumber", r(c("l_quantity") - dil).alias("val"))


# published tables

FIELDS = [("CH4", "ch4", "m1", 1, "ppb", "click"), ("CO", "co", "m2", 1, "ppb", "error"), ("BC6", "bc", "m3", 1, "ug", "view"), ("H2O", "h2o", "m4", 1, "ppm", "click"), ("H2O", "h2o", "m5", 1, "ppm", "view")]
NAMES = ("CH4", "CO", "BC6", "H2O")
SQL_FIELDS = "fields(parameter_ucb, parameter, method, duration, unit, instrument) AS (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {d}, '{e}', '{f}')" for a, b, c, d, e, f in FIELDS) + ")"
NAMED = f"""named AS (SELECT event_id, ts AS sample_time, event_type AS instrument, ({list(NAMES)})[CAST(user_id % 4 AS INTEGER) + 1] AS parameter, value, {LAT} AS lat_smooth, {LON} AS lon_smooth, CASE WHEN event_id % 9 = 0 THEN '2,8' ELSE '0' END AS summary_flag FROM events)"""


def named(spark, sf):
    lat, lon = lat_lon()
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("sample_time"), F.col("event_type").alias("instrument"), F.get(F.array(*map(F.lit, NAMES)), (F.col("user_id") % 4).cast("int")).alias("parameter"), "value",
        lat.alias("lat_smooth"), lon.alias("lon_smooth"), lat.alias("lat"), lon.alias("lon"), F.when(F.col("event_id") % 9 == 0, "2,8").otherwise("0").alias("summary_flag"),
    )


def fields(spark):
    return spark.createDataFrame(FIELDS, "parameter_ucb string, parameter string, method string, duration int, unit string, instrument string")


@query(f"""
    WITH {NAMED}, {SQL_FIELDS}
    SELECT sample_time AS timestamp, f.parameter, method, duration, {sql_r("CASE WHEN n.parameter IN ('CH4', 'N2O', 'CO') THEN value * 1000 WHEN n.parameter = 'BC6' THEN value / 1000 ELSE value END", 6)} AS value,
           unit, {sql_r('lat_smooth', 5)} AS latitude, {sql_r('lon_smooth', 5)} AS longitude, CAST(NULL AS VARCHAR) AS h3_index, CAST(summary_flag <> '0' AS INTEGER) AS status_indicator, summary_flag AS qualifier_codes, 'van' AS vehicle_id
    FROM named n JOIN fields f ON n.parameter = f.parameter_ucb AND n.instrument = f.instrument""")
def field_map_l2(spark, sf):
    out = output.exchange_rows(named(spark, sf), fields(spark), "van")
    return out.withColumns({"value": r("value", 6), "latitude": r("latitude", 5), "longitude": r("longitude", 5)})


@query(f"""
    WITH {NAMED}, {SQL_FIELDS}
    SELECT sample_time AS timestamp, f.parameter, method, duration, value, unit, {sql_r('lat_smooth', 5)} AS latitude, {sql_r('lon_smooth', 5)} AS longitude, CAST(summary_flag <> '0' AS INTEGER) AS status_indicator, summary_flag AS qualifier_code
    FROM named n JOIN fields f ON n.parameter = f.parameter_ucb AND n.instrument = f.instrument""")
def field_map_l1(spark, sf):
    return output.raw_rows(named(spark, sf), fields(spark)).withColumns({"latitude": r("latitude", 5), "longitude": r("longitude", 5)})


@query(f"SELECT l_orderkey, l_linenumber, {sql_r('l_extendedprice * l_discount * l_tax', 5)} AS value FROM lineitem")
def round_output(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax")).alias("value"))
    return output.round_columns(li)


@query(f"WITH p AS (SELECT {sql_r(LAT, 5)} AS lat, {sql_r(LON, 5)} AS lon, value FROM events) SELECT lat, lon, {sql_r('avg(value)')} AS value, count(*) AS n FROM p GROUP BY ALL")
def point_mean(spark, sf):
    lat, lon = lat_lon()
    e = table(spark, sf, "events").select(r(lat, 5).alias("lat"), r(lon, 5).alias("lon"), "value")
    return output.mean_by_point(e, "value").select("lat", "lon", r("value").alias("value"), "n")


@query(f"SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS geometry, {sql_r('avg(value)')} AS value, count(*) AS n FROM events GROUP BY ALL")
def line_mean(spark, sf):
    line = F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    return output.mean_by_line(table(spark, sf, "events").select(line.alias("geometry"), "value"), "value").select("geometry", r("value").alias("value"), "n")


@query(f"""
    WITH p AS (SELECT 30 + user_id * 0.037::DOUBLE AS lat, -120 - user_id * 0.051::DOUBLE AS lon, value FROM events)
    SELECT round_even(floor(lat / 0.5::DOUBLE) * 0.5::DOUBLE * 10, 0) / 10 AS cell_lat, round_even(floor(lon / 0.5::DOUBLE) * 0.5::DOUBLE * 10, 0) / 10 AS cell_lon, {sql_r('avg(value)')} AS value, count(*) AS n FROM p GROUP BY ALL""")
def cell_mean(spark, sf):
    u = F.col("user_id")
    e = table(spark, sf, "events").select((F.lit(30) + u * F.lit(0.037)).alias("lat"), (F.lit(-120) - u * F.lit(0.051)).alias("lon"), "value")
    return output.mean_by_cell(e, "value", 0.5).select("cell_lat", "cell_lon", r("value").alias("value"), "n")


# shapes, sets, text


@query("""
    SELECT p_partkey, 'p_size' AS name, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def unpivot_wide(spark, sf):
    p = table(spark, sf, "part").withColumn("p_size", F.col("p_size").cast("double"))
    return p.unpivot("p_partkey", ["p_size", "p_retailprice"], "name", "value")


@query("SELECT p_partkey, left(p_brand, greatest(length(p_brand) - 4, 0)) AS short, regexp_matches(p_type, '^[HCOKSNV]') AS ion FROM part")
def suffix_strip_regex(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.without_suffix("p_brand").alias("short"), text.is_ion("p_type").alias("ion"))


@query(f"""
    SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_totalprice) AS low, max(o_totalprice) AS high, {sql_r('stddev_samp(o_totalprice)', 2)} AS spread FROM orders GROUP BY ALL""")
def month_period_stats(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(ntz(clock.month("o_orderdate")).alias("month")).agg(
        F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), r(F.stddev_samp("o_totalprice"), 2).alias("spread")
    )


@query("SELECT c_nationkey AS cell_lat, c_custkey % 7 AS cell_lon FROM customer EXCEPT SELECT s_nationkey, s_suppkey % 7 FROM supplier")
def cells_missing(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("cell_lat"), (F.col("c_custkey") % 7).alias("cell_lon"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("cell_lat"), (F.col("s_suppkey") % 7).alias("cell_lon"))
    return roads.missing_cells(c, s)


@query("""
    WITH a AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS k FROM events WHERE event_type = 'click'), b AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS k FROM events WHERE event_type = 'view')
    SELECT a.event_id AS left_id, b.event_id AS right_id FROM a JOIN b USING (k)""")
def positional_zip(spark, sf):
    from tracklake.sources.arrays import wide_counts

    e = table(spark, sf, "events").withColumn("file", F.date_format("ts", "'run'yyyyMMdd_HHmmss'_p.h5'"))
    day = lambda kind: e.filter(F.col("event_type") == kind).withColumn("file", F.date_format("ts", "'run'yyyyMMdd'_000000_p.h5'"))
    from pyspark.sql import Window

    at = F.row_number().over(Window.partitionBy("file").orderBy("event_id")) - 1
    left, right = (day(k).select("file", at.cast("bigint").alias("row"), F.lit(0.0).alias("offset_s"), F.array(F.col("event_id").cast("double")).alias("counts")) for k in ("click", "view"))
    wide = wide_counts(left, right, ["a"], 1, [(0, "b")])
    return wide.select(F.rint(F.col("a") / 24990.0).cast("bigint").alias("left_id"), F.col("b").cast("bigint").alias("right_id"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.oneway'), 'no') AS oneway FROM events")
def json_tag_get(spark, sf):
    e = table(spark, sf, "events").withColumn("tags", F.from_json("props", "map<string,string>"))
    return e.select("event_id", text.tag("tags", "k").cast("bigint").alias("k"), text.tag("tags", "oneway", "no").alias("oneway"))


@query(f"SELECT vec_id, {sql_r('list_sum(list_transform(embedding, lambda x: x::DOUBLE * 24990::DOUBLE))', 1)} AS total, len(embedding) + 2 AS size FROM embeddings")
def array_cps_scale(spark, sf):
    e = table(spark, sf, "embeddings")
    scaled = numbers.scaled_array("embedding", 24990.0)
    total = F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x)
    return e.select("vec_id", r(total, 1).alias("total"), F.size(F.concat(scaled, F.array_repeat(F.lit(None).cast("double"), 2))).cast("bigint").alias("size"))


@query("SELECT event_type AS name, value FROM events UNION ALL SELECT o_orderpriority, o_totalprice FROM orders")
def union_long(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("name"), "value")
    return e.unionByName(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("value")))


@query("""
    SELECT cell_lat, cell_lon, o_orderkey FROM (SELECT o_custkey % 50 AS cell_lat, o_orderpriority AS cell_lon, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 50, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1""")
def latest_per_key(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("cell_lat"), F.col("o_orderpriority").alias("cell_lon"), F.lit(30).alias("length_seg"), F.col("o_orderdate").alias("date"), F.col("o_orderkey").alias("file"))
    return roads.newest_cells(o).select("cell_lat", "cell_lon", F.col("file").alias("o_orderkey"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rollup_status(spark, sf):
    return table(spark, sf, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("""
    WITH s AS (SELECT CAST(o_orderdate AS DATE)::VARCHAR AS drive_date, o_orderstatus, o_orderkey FROM orders )
    SELECT drive_date, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN 'OK' ELSE '-' END AS gps, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'O') > 0 THEN 'OK' ELSE '-' END AS vocus_h5,
           CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'OK' ELSE '-' END AS vocus_cal, '-' AS instrument FROM s GROUP BY drive_date""")
def stage_summary(spark, sf):
    names = F.create_map(*(F.lit(x) for x in ("F", "gps", "O", "vocus_h5", "P", "vocus_cal")))
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").cast("string").alias("drive_date"), F.try_element_at(names, F.col("o_orderstatus")).alias("stage"), F.lit("OK").alias("status"))
    return summarise(o)


# roads


def elements(spark, sf):
    """Map elements: a node for each customer, a way over six nodes for each supplier."""
    lat, lon = lat_lon(*NODES)
    kind = "map<string,string>"
    nodes = table(spark, sf, "customer").select(F.lit("node").alias("type"), F.col("c_custkey").alias("id"), lat.alias("lat"), lon.alias("lon"), F.lit(None).cast("array<bigint>").alias("nodes"), F.lit(None).cast(kind).alias("tags"))
    k = F.col("s_suppkey")
    tags = F.create_map(F.lit("highway"), F.when(k % 7 == 0, "path").when(k % 5 == 0, "service").otherwise("residential"), F.lit("name"), F.concat(F.lit("R"), (k % 9).cast("string")), F.lit("oneway"), F.when(k % 3 == 0, "-1").when(k % 3 == 1, "yes").otherwise("no"))
    ways = table(spark, sf, "supplier").select(F.lit("way").alias("type"), k.alias("id"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: k + i * i).alias("nodes"), tags.alias("tags"))
    return nodes.unionByName(ways)


_CA, _CO = sql_lat_lon(*NODES)


@query(f"""
    WITH n AS (SELECT c_custkey AS id, {_CA} AS lat, {_CO} AS lon FROM customer),
    w AS (SELECT s_suppkey AS way_id, s_suppkey + i * i AS node, i FROM supplier CROSS JOIN (SELECT unnest(range(1, 7)) AS i) WHERE s_suppkey % 7 <> 0),
    j AS (SELECT way_id, i, lat, lon FROM w JOIN n ON w.node = n.id),
    g AS (SELECT way_id, count(*) AS n, arg_min(lat, i) AS a1, arg_min(lon, i) AS o1, arg_max(lat, i) AS a2, arg_max(lon, i) AS o2 FROM j GROUP BY way_id HAVING count(*) >= 2)
    SELECT way_id, CAST(n AS BIGINT) AS n, CASE WHEN way_id % 5 = 0 THEN 'service' ELSE 'residential' END AS rd_type, 'R' || CAST(way_id % 9 AS VARCHAR) AS rd_name, way_id % 3 <> 2 AS oneway,
           {sql_r('CASE WHEN way_id % 3 = 0 THEN a2 ELSE a1 END', 5)} AS lat, {sql_r(f"CASE WHEN way_id % 3 = 0 THEN {sql_bearing('a2', 'o2', 'a1', 'o1')} ELSE {sql_bearing('a1', 'o1', 'a2', 'o2')} END", 3)} AS rd_deg FROM g""")
def parse_roads(spark, sf):
    out = roads.parse_roads(elements(spark, sf))
    return out.select("way_id", F.size("coords").cast("bigint").alias("n"), "rd_type", "rd_name", "oneway", r(F.col("coords")[0]["lat"], 5).alias("lat"), r("rd_deg", 3).alias("rd_deg"))


_STEP = sql_haversine("plat", "plon", "lat", "lon")


def _sql_at(d: str, f: str) -> str:
    """A coordinate at a distance along a piece: between the vertex before it and the next."""
    k = f"greatest(1, least(len(list_filter(ds, lambda x: x < {d})), m - 1))"
    share = f"coalesce(({d} - ds[{k}]) / nullif(ds[{k} + 1] - ds[{k}], 0), 0)"
    return f"({f}[{k}] + {share} * ({f}[{k} + 1] - {f}[{k}]))"


@query(f"""
    WITH n AS (SELECT c_custkey AS id, {_CA} AS lat, {_CO} AS lon FROM customer),
    w AS (SELECT s_suppkey AS way_id, s_suppkey + i * i AS node, i FROM supplier CROSS JOIN (SELECT unnest(range(1, 7)) AS i) WHERE s_suppkey % 7 <> 0),
    j AS (SELECT way_id, node, lat, lon, row_number() OVER (PARTITION BY way_id ORDER BY CASE WHEN way_id % 3 = 0 THEN -i ELSE i END) - 1 AS j, count(*) OVER (PARTITION BY way_id) AS m FROM w JOIN n ON w.node = n.id),
    q AS (SELECT * FROM j WHERE m >= 2),
    e AS (SELECT way_id, arg_min(lat, j) AS a1, arg_min(lon, j) AS o1, arg_max(lat, j) AS a2, arg_max(lon, j) AS o2 FROM q GROUP BY way_id),
    g AS (SELECT way_id, CASE WHEN way_id % 5 = 0 THEN 'service' ELSE 'residential' END AS rd_type, 'R' || CAST(way_id % 9 AS VARCHAR) AS rd_name, way_id % 3 <> 2 AS oneway, {sql_bearing('a1', 'o1', 'a2', 'o2')} AS deg FROM e),
    d AS (SELECT *, bool_or(oneway) OVER (PARTITION BY rd_name) AND first_value(rd_type) OVER (PARTITION BY rd_name ORDER BY way_id) <> 'service' AS split, deg - avg(deg) OVER (PARTITION BY rd_name) + 180 AS off FROM g),
    k AS (SELECT *, CASE WHEN split THEN CAST(abs((off % 360 + 360) % 360 - 180) > 45 AS INTEGER) ELSE -1 END AS cluster FROM d),
    c AS (SELECT q.*, j > 0 AND j < m - 1 AND count(*) OVER (PARTITION BY node) > 1 AS cut FROM q),
    b AS (SELECT *, sum(CAST(cut AS INTEGER)) OVER (PARTITION BY way_id ORDER BY j) AS piece FROM c),
    v AS (SELECT way_id, piece, j, node, lat, lon FROM b UNION ALL SELECT way_id, piece - 1, j, node, lat, lon FROM b WHERE cut),
    h AS (SELECT *, lag(lat) OVER u AS plat, lag(lon) OVER u AS plon FROM v WINDOW u AS (PARTITION BY way_id, piece ORDER BY j)),
    s AS (SELECT *, sum(CASE WHEN plat IS NULL THEN 0 ELSE {_STEP} END) OVER (PARTITION BY way_id, piece ORDER BY j) AS dist FROM h),
    l AS (SELECT way_id, piece, list(node ORDER BY j) AS nodes, list(lat ORDER BY j) AS las, list(lon ORDER BY j) AS los, list(dist ORDER BY j) AS ds, count(*) AS m, max(dist) AS len FROM s GROUP BY way_id, piece),
    o AS (SELECT *, row_number() OVER (PARTITION BY rd_type, rd_name, oneway, cluster, CASE WHEN nodes < list_reverse(nodes) THEN nodes ELSE list_reverse(nodes) END ORDER BY way_id, piece) AS copy FROM l JOIN k USING (way_id)),
    t AS (SELECT *, CASE WHEN len < 15 THEN 1 ELSE greatest(1, CAST(round_even(len / 30, 0) AS BIGINT)) END AS n FROM o WHERE copy = 1),
    x AS (SELECT *, unnest(range(0, n)) AS part, len / n AS size FROM t),
    y AS (SELECT *, CASE WHEN n = 1 THEN las[1] ELSE {_sql_at('part * size', 'las')} END AS start_lat, CASE WHEN n = 1 THEN los[1] ELSE {_sql_at('part * size', 'los')} END AS start_lon,
          CASE WHEN n = 1 THEN las[m] ELSE {_sql_at('(part + 1) * size', 'las')} END AS end_lat, CASE WHEN n = 1 THEN los[m] ELSE {_sql_at('(part + 1) * size', 'los')} END AS end_lon,
          {sql_r(f"CASE WHEN len < 15 THEN las[m // 2 + 1] ELSE {_sql_at('(part + 0.5) * size', 'las')} END", 6)} AS center_lat, {sql_r(f"CASE WHEN len < 15 THEN los[m // 2 + 1] ELSE {_sql_at('(part + 0.5) * size', 'los')} END", 6)} AS center_lon FROM x)
    SELECT row_number() OVER (ORDER BY floor(center_lat * 10), floor(center_lon * 10), center_lat, center_lon, rd_type, rd_name, start_lat, start_lon, end_lat, end_lon) - 1 AS segment_id, rd_name AS road_name, rd_type AS highway, oneway,
           CAST(NULL AS VARCHAR) AS service, {sql_r('start_lat', 6)} AS start_lat, {sql_r('start_lon', 6)} AS start_lon, {sql_r('end_lat', 6)} AS end_lat, {sql_r('end_lon', 6)} AS end_lon, center_lat, center_lon,
           {sql_r(sql_bearing('start_lat', 'start_lon', 'end_lat', 'end_lon'), 2)} AS bearing_deg FROM y""")
def segmentise(spark, sf):
    out = roads.build_segments(elements(spark, sf), 30.0)
    return out.withColumns({c: r(c, 6) for c in ("start_lat", "start_lon", "end_lat", "end_lon")} | {"bearing_deg": r("bearing_deg", 2)})


@query(
    ORACLE_SQL["segmentise"].replace("j > 0 AND j < m - 1 AND count(*) OVER (PARTITION BY node) > 1 AS cut", "false AS cut").replace("FROM o WHERE copy = 1", "FROM o")
)
def segmentise_whole(spark, sf):
    """Ways as they stand, neither cut nor dissolved."""
    out = roads.build_segments(elements(spark, sf), 30.0, split=False)
    return out.withColumns({c: r(c, 6) for c in ("start_lat", "start_lon", "end_lat", "end_lon")} | {"bearing_deg": r("bearing_deg", 2)})


@query(f"""
    WITH p AS (SELECT s_suppkey AS way_id, {_SA} AS a1, {_SO} AS o1, {_SA} + 0.0010007::DOUBLE AS a2, {_SO} + (s_suppkey % 10) * 0.0000917::DOUBLE AS o2 FROM supplier),
    d AS (SELECT *, {sql_haversine('a1', 'o1', 'a2', 'o2')} AS len FROM p),
    n AS (SELECT *, greatest(1, CAST(round_even(len / 30, 0) AS BIGINT)) AS n FROM d),
    x AS (SELECT *, unnest(range(0, n)) AS part FROM n)
    SELECT way_id, CAST(part AS BIGINT) AS part, {sql_r('a1 + (part + 0.5) / n * (a2 - a1)', 6)} AS center_lat, {sql_r('o1 + (part + 0.5) / n * (o2 - o1)', 6)} AS center_lon FROM x""")
def segment_lines(spark, sf):
    lat, lon = lat_lon("s_suppkey", 41, 59)
    point = lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))
    lines = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("way_id"), F.array(point(lat, lon), point(lat + F.lit(0.0010007), lon + (F.col("s_suppkey") % 10) * F.lit(0.0000917))).alias("coords"))
    return roads.segmentise(lines).select("way_id", F.col("part").cast("bigint").alias("part"), r("center_lat", 6).alias("center_lat"), r("center_lon", 6).alias("center_lon"))


@query(f"""
    WITH t AS (SELECT event_id, value, event_id // 500 AS period FROM events WHERE event_id % 500 < 200), e AS (SELECT *, max(event_id) OVER (PARTITION BY period) AS last FROM t)
    SELECT make_timestamp((1704067200 + event_id) * 1000000) AS sample_time, {sql_r('value - 5.0::DOUBLE / 501')} AS val FROM e WHERE last - event_id BETWEEN 10 AND 70""")
def ion_targets(spark, sf):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("event_id"))
    rows = table(spark, sf, "events").select(F.lit("d").alias("day"), F.lit(calibration.ION_INSTRUMENT).alias("instrument"), F.lit("C6H7").alias("parameter"), at.alias("sample_time"), "value", "event_id")
    open_ = F.when(F.col("event_id") % 500 < 200, 1.0).otherwise(0.0)
    gates = rows.select("day", "instrument", "sample_time", open_.alias("cal_valve"), F.lit(1.0).alias("zero_valve"), F.lit(1.0).alias("cal_flow"), F.lit(500.0).alias("zero_flow"))
    concs = spark.createDataFrame([(calibration.ION_INSTRUMENT, "C6H7", 5.0)], "instrument string, parameter string, conc double")
    found = targets.ion_targets(rows, gates, concs, ["day"])
    return found.select(ntz("sample_time").alias("sample_time"), r("val").alias("val"))
