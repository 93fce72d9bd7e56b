"""Queries that go through readers and writers, and whole stages, each with its SQL.

Tables are written in the form that a reader expects, into the shared scratch
folder, and read again by it; the SQL states the result on the tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions import clock, geo
from tracklake.operators import calibration, gps, matching, ordered, output, roads, targets
from tracklake.plans import config
from tracklake.plans.pipeline import days
from tracklake.queries import CALS, INSTRUMENTS, LAT, LON, ORACLE_SQL, REF, calibrations, elements, lat_lon, ntz, query, r, readings, segments, sql_bearing, sql_haversine, sql_lat_lon, sql_r, table
from tracklake.sources import readers, writers
from tracklake.sources.calibration_store import CalibrationStore
from tracklake.sources.scratch import scratch_path

#: A zone without changes of the clock, seven hours behind UTC.
ZONE = "Etc/GMT+7"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def as_csv(df: DataFrame, name: str) -> str:
    """Write a table as CSV with a header; nulls as ``NA``."""
    path = scratch_path(df.sparkSession, name)
    df.write.csv(path, header=True, nullValue="NA")
    return path


def as_text(df: DataFrame, name: str) -> str:
    """Write one text a file, as documents such as GeoJSON need."""
    path = scratch_path(df.sparkSession, name)
    df.coalesce(1).write.text(path)
    return path


# readings


@query(ORACLE_SQL["pivot_second_mean"])
def gps_csv(spark, sf):
    names = F.array(*map(F.lit, gps.GPS_PARAMETERS))
    long = table(spark, sf, "events").select(F.date_format("ts", ISO).alias("sample_time"), F.get(names, (F.col("user_id") % 4).cast("int")).alias("parameter"), "value")
    track = readers.read_gps(spark, as_csv(long, "gps.csv"))
    return track.select(ntz("sample_time").alias("sample_time"), *(r(c).alias(c) for c in gps.GPS_PARAMETERS.values()))


@query(f"SELECT date_trunc('second', ts) AS sample_time, {sql_r(LAT, 5)} AS lat, CASE WHEN event_id % 5 <> 0 THEN value END AS speed, CAST(NULL AS DOUBLE) AS direction FROM events")
def gps_wide_csv(spark, sf):
    lat, lon = lat_lon()
    wide = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"), lat.alias("latitude"), lon.alias("longitude"), F.when(F.col("event_id") % 5 == 0, "NaN").otherwise(F.col("value").cast("string")).alias("speed"))
    return readers.read_gps(spark, as_csv(wide, "wide.csv")).select(ntz("sample_time").alias("sample_time"), r("lat", 5).alias("lat"), "speed", "direction")


@query("""
    SELECT date_trunc('second', ts) AS sample_time, event_type AS instrument, 'p' || CAST(user_id % 4 AS VARCHAR) AS parameter,
           CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN value END AS value, CAST(event_id AS VARCHAR) AS string FROM events""")
def log_csv(spark, sf):
    """Times in three forms, values that are missing or no number."""
    k = F.col("event_id")
    forms = F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "M/d/yyyy H:mm:ss"))
    value = F.when(k % 13 == 0, "NaN").when(k % 11 != 0, F.col("value").cast("string"))
    e = table(spark, sf, "events").select(
        forms.alias("sample_time"), F.col("event_type").alias("instrument"), F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("parameter"), value.alias("value"), k.cast("string").alias("string")
    )
    return readers.read_log(spark, as_csv(e, "log.csv")).withColumn("sample_time", ntz("sample_time"))


def counts(spark, sf) -> DataFrame:
    """Counts per second by local time, one column for each of two ions and one that nobody needs."""
    return table(spark, sf, "events").select(ntz("ts").alias("date"), F.col("value").alias("C6H7"), (F.col("value") * 2).alias("C7H9"), F.lit("x").alias("rest"))


COUNTS = "SELECT date_trunc('second', ts + INTERVAL 7 HOUR) AS sample_time, 'Vocus-PTR-ToF' AS instrument, '{0}' AS parameter, value * {1} AS value FROM events"


@query(f"{COUNTS.format('C6H7', 1)} UNION ALL {COUNTS.format('C7H9', 2)}")
def cps_long_parquet(spark, sf):
    path, long = scratch_path(spark, "cps.parquet"), scratch_path(spark, "long.parquet")
    writers.write_cps(counts(spark, sf), path)
    writers.write_cps_long(readers.read_cps(spark, path, ZONE).drop("rest"), long)
    return spark.read.parquet(long).select(ntz("sample_time").alias("sample_time"), "instrument", "parameter", "value")


@query(f"""
    SELECT date_trunc('second', ts) AS sample_time, event_type AS instrument, 'x' AS parameter, value FROM events
    UNION ALL {COUNTS.format('C7H9', 2)}""")
def day_union(spark, sf):
    """A log under the name of its day, and the columns of the counts that are needed."""
    day, folder = date(2025, 7, 15), scratch_path(spark, "logs")
    log = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("sample_time"), F.col("event_type").alias("instrument"), F.lit("x").alias("parameter"), "value")
    log.write.csv(f"{folder}/{readers.log_name(day)}", header=True)
    writers.write_cps(counts(spark, sf), cps := scratch_path(spark, "cps.parquet"))
    rows = readers.read_day(spark, folder, day, cps, ZONE, ["C7H9"])
    return rows.select(ntz("sample_time").alias("sample_time"), "instrument", "parameter", "value")


# tracks


def finished(spark, sf) -> DataFrame:
    """Matched rows of a track, as the last steps of the GPS stage see them; one in three found no road."""
    (lat, lon), found = lat_lon(), F.col("event_id") % 3 != 0
    some = {"center_lat": lat, "center_lon": lon, "seg_start_lat": lat, "seg_start_lon": lon, "seg_end_lat": lat + 0.001, "seg_end_lon": lon + 0.001, "snap_lat": lat, "snap_lon": lon}
    return table(spark, sf, "events").select(
        F.col("ts").alias("sample_time"), "user_id", lat.alias("lat"), lon.alias("lon"), lat.alias("lat_kf"), lon.alias("lon_kf"), F.col("value").alias("car_speed_mph"), F.lit(0.0).alias("car_bearing_deg"),
        *(F.when(found, c).alias(n) for n, c in some.items()), F.when(found, "residential").alias("highway"), F.when(found, "A").alias("road_name"), F.col("event_id").alias("drive_pass"), F.when(found, F.col("event_id")).alias("segment_id"),
    )


_FOUND = "CASE WHEN event_id % 3 <> 0 THEN {} END"
_TRACK = f"""SELECT {{0}} AS sample_time, {sql_r(LAT, 5)} AS lat, {sql_r(LON, 5)} AS lon_smooth, {_FOUND.format(sql_r(LAT, 5))} AS lat_snap, {_FOUND.format(sql_r(f'{LON} + 0.001::DOUBLE', 5))} AS seg_end_lon FROM events"""


def _read_track(spark, path: str) -> DataFrame:
    t = readers.read_track(spark, path)
    return t.select(ntz("sample_time").alias("sample_time"), *(r(c, 5).alias(c) for c in ("lat", "lon_smooth", "lat_snap", "seg_end_lon")))


@query(_TRACK.format("ts"))
def track_parquet(spark, sf):
    writers.write_track(gps.format_track(finished(spark, sf), []), path := scratch_path(spark, "track.parquet"))
    return _read_track(spark, path)


@query(_TRACK.format("date_trunc('millisecond', ts)"))
def track_csv(spark, sf):
    writers.write_track(gps.format_track(finished(spark, sf), []), path := scratch_path(spark, "track.csv"))
    return _read_track(spark, path)


@query(f"SELECT ts AS datetime, value AS car_mph, {_FOUND.format(sql_r(LAT, 6))} AS lat_30, {_FOUND.format('chr(65)')} AS rd_name, event_id AS drive_pass, {_FOUND.format('41')} AS line_bytes FROM events")
def track_columns(spark, sf):
    """The published columns, and lines as well-known binary where there is a road."""
    lines = writers.with_line(gps.format_track(finished(spark, sf), []))
    return lines.select("datetime", "car_mph", "lat_30", "rd_name", "drive_pass", F.octet_length("geometry").alias("line_bytes"))


@query(f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE event_id % 3 <> 0) AS n_matched, {sql_r('100.0::DOUBLE * count(*) FILTER (WHERE event_id % 3 <> 0) / count(*)')} AS match_pct, max(event_id) AS n_passes FROM events")
def match_statistics(spark, sf):
    return gps.match_statistics(finished(spark, sf)).withColumn("match_pct", r("match_pct"))


@query(f"SELECT event_id, {sql_r(LAT, 5)} AS lat FROM events WHERE {LAT} > 37.802 AND {LAT} < 37.807 AND {LON} > -122.299 AND {LON} < -122.295")
def box_scan(spark, sf):
    lat, lon = lat_lon()
    writers.write_table(table(spark, sf, "events").select("event_id", lat.alias("lat"), lon.alias("lon")), path := scratch_path(spark, "t.parquet"))
    return readers.read_box(spark, path, 37.802, -122.299, 37.807, -122.295).select("event_id", r("lat", 5).alias("lat"))


@query(ORACLE_SQL["box_scan"])
def box_scan_curve(spark, sf):
    """The same from a table that is laid out along a curve."""
    lat, lon = lat_lon()
    writers.write_by_place(table(spark, sf, "events").select("event_id", lat.alias("lat"), lon.alias("lon")), path := scratch_path(spark, "curve.parquet"))
    return readers.read_box(spark, path, 37.802, -122.299, 37.807, -122.295).select("event_id", r("lat", 5).alias("lat"))


def _sql_bits(share: str, place: int) -> str:
    """The bits of a share of the whole at every second place."""
    n = f"greatest(0, least({2**geo.CURVE_BITS - 1}, CAST(floor(({share}) * {2**geo.CURVE_BITS}::DOUBLE) AS BIGINT)))"
    return f"CAST(list_sum(list_transform(range(0, {geo.CURVE_BITS}), lambda b: (({n} >> b) & 1) << (2 * b + {place}))) AS BIGINT)"


@query(f"SELECT event_id, {_sql_bits(f'({LAT} + 90) / 180', 1)} + {_sql_bits(f'({LON} + 180) / 360', 0)} AS key FROM events")
def curve_keys(spark, sf):
    lat, lon = lat_lon()
    return table(spark, sf, "events").select("event_id", geo.curve_key(lat, lon).alias("key"))


@query(f"SELECT {sql_r(f'avg({LAT})', 6)} AS ref_lat FROM events")
def mean_latitude(spark, sf):
    lat, _ = lat_lon()
    return spark.createDataFrame([(matching.reference_latitude(table(spark, sf, "events").select(lat.alias("center_lat"))),)], "ref_lat double").select(r("ref_lat", 6).alias("ref_lat"))


# reference tables


@query("SELECT month, instrument, CAST(lag AS INTEGER) AS lag_s FROM (SELECT DISTINCT date_trunc('month', ts) AS month FROM events) CROSS JOIN (VALUES ('A', 2), ('B', NULL), ('C', -3)) v(instrument, lag)")
def lags_csv(spark, sf):
    months = table(spark, sf, "events").select(F.date_format("ts", "M/1/yyyy").alias("month")).distinct()
    wide = months.select("month", F.lit("2").alias("A"), F.lit(None).cast("string").alias("B"), F.lit("-3").alias("C"))
    return readers.read_lags(spark, as_csv(wide, "lags.csv")).withColumn("month", ntz("month"))


@query("SELECT s_name AS instrument, 'x' AS parameter, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS range_start, s_acctbal + 1 AS range_end, CAST(s_suppkey AS INTEGER) AS flag_value FROM supplier")
def thresholds_csv(spark, sf):
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(F.col("s_name").alias("instrument"), F.lit("x").alias("parameter"), F.when(k % 3 != 0, F.col("s_acctbal")).alias("range_start"), (F.col("s_acctbal") + 1).alias("range_end"), k.alias("flag_value"))
    return readers.read_thresholds(spark, as_csv(rows, "flags.csv"))


@query("SELECT s_name AS parameter_ucb, CAST(s_suppkey AS INTEGER) AS duration FROM supplier")
def fields_csv(spark, sf):
    return readers.read_fields(spark, as_csv(table(spark, sf, "supplier").select(F.col("s_name").alias("parameter_ucb"), F.col("s_suppkey").alias("duration")), "fields.csv"))


_STANDARDS = """s AS (SELECT p_brand AS cylinder_number, 'n' || p_partkey AS part_number, p_retailprice AS CH4, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS C6H7 FROM part),
    l AS (SELECT cylinder_number, part_number, 'CH4' AS species, CH4 AS cal_concs FROM s UNION ALL SELECT cylinder_number, part_number, 'C6H7', C6H7 FROM s)"""


def _standards(spark, sf) -> DataFrame:
    wide = table(spark, sf, "part").select(F.col("p_brand").alias("cylinder_number"), F.concat(F.lit("n"), F.col("p_partkey").cast("string")).alias("part_number"), F.col("p_retailprice").alias("CH4_ppb"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("C6H7_ppb"))
    return readers.read_standards(spark, as_csv(wide, "standards.csv"))


@query(f"WITH {_STANDARDS} SELECT * FROM l")
def standards_csv(spark, sf):
    return _standards(spark, sf)


@query(f"WITH {_STANDARDS} SELECT 'I' || right(cylinder_number, 1) AS instrument, species AS parameter, CASE WHEN species = 'CH4' THEN cal_concs / 1000 ELSE cal_concs END AS conc FROM l JOIN (SELECT DISTINCT p_brand AS cylinder_number FROM part) b USING (cylinder_number) WHERE cal_concs > 0")
def target_concentrations(spark, sf):
    """Concentrations above zero of the cylinders that instruments ask for."""
    asks = table(spark, sf, "part").select(F.concat(F.lit("I"), F.right("p_brand", F.lit(1))).alias("instrument"), F.col("p_brand").alias("cylinder_number")).distinct()
    return targets.target_concentrations(asks, _standards(spark, sf))


#: Species of the standard cylinder and one that it lacks.
SPECIES = ("C2H5O", "CH5O", "C2H7O", "C3H7O", "C3H4N", "C5H9", "C4H7O", "C4H9O", "C7H9", "C8H11", "C10H17", "C9H13", "C10H23", "C10H31O5Si5", "C6H15", "C6H7")


@query(f"""
    WITH r AS (SELECT * FROM (VALUES ('C2H5O', 2.97e-9::DOUBLE), ('CH5O', 2.31e-9), ('C2H7O', 2.37e-9), ('C3H7O', 3.24e-9), ('C3H4N', 4.17e-9), ('C5H9', 1.93e-9), ('C4H7O', 3.51e-9), ('C4H9O', 3.23e-9), ('C7H9', 2.07e-9), ('C8H11', 2.21e-9), ('C10H17', 2.48e-9), ('C9H13', 2.42e-9), ('C10H23', 2.50e-9), ('C10H31O5Si5', 3.50e-9), ('C6H15', 3.00e-9)) v(species, ksens)),
    s AS (SELECT s_suppkey, [{", ".join(f"'{n}'" for n in SPECIES)}][s_suppkey % {len(SPECIES)} + 1] AS species FROM supplier)
    SELECT s_suppkey, s.species AS species, ksens FROM s LEFT JOIN r USING (species)""")
def rates_standard(spark, sf):
    """A species for each supplier, with its rate in the standard cylinder."""
    s = table(spark, sf, "supplier").select("s_suppkey", F.element_at(F.array(*map(F.lit, SPECIES)), (F.col("s_suppkey") % len(SPECIES) + 1).cast("int")).alias("species"))
    return s.join(readers.read_rates(spark, "CC515288"), "species", "left").select("s_suppkey", "species", "ksens")


@query("SELECT s_name AS species, s_acctbal AS ksens FROM supplier WHERE s_nationkey % 2 = 1")
def rates_csv(spark, sf):
    """Rates from a file, of one cylinder among those in it."""
    s = table(spark, sf, "supplier").select(F.when(F.col("s_nationkey") % 2 == 1, "X").otherwise("Y").alias("cylinder_number"), F.col("s_name").alias("species"), F.col("s_acctbal").alias("ksens"))
    return readers.read_rates(spark, "X", as_csv(s, "rates.csv"))


@query("SELECT s_suppkey AS place, s_name AS name FROM supplier")
def peaks_csv(spark, sf):
    """Names by index, whatever the order of the file, and control columns as they stand."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("index"), F.col("s_name").alias("species"), F.col("s_name").alias("name")).orderBy(F.desc("s_name"))
    path = as_csv(s, "peaks.csv")
    names, controls = readers.read_peak_names(spark, path), dict(readers.read_control_columns(spark, path))
    placed = [(k, n) for k, n in zip(sorted(controls), names, strict=True) if controls[k] == n]
    return spark.createDataFrame(placed, "place long, name string")


@query(f"""
    WITH {CALS} SELECT instrument, parameter, t AS sample_time, slope, intercept FROM cals
    UNION ALL SELECT instrument, parameter, t, slope + 1, NULL FROM cals""")
def gas_calibrations(spark, sf):
    """Both forms of file, with other names and without intercepts in the second, several files of each."""
    c = calibrations(spark, sf).withColumn("sample_time", F.date_format("sample_time", "yyyy-MM-dd HH:mm:ss"))
    plain = [as_csv(c.filter(F.col("parameter").isin(*p)), "gas.csv") for p in (("p0", "p1"), ("p2", "p3"))]
    other = as_csv(c.select(F.col("parameter").alias("compound"), F.col("sample_time").alias("date"), F.col("instrument").alias("instrument_d"), (F.col("slope") + 1).alias("slope")), "nox.csv")
    return readers.read_gas_calibrations(spark, plain, [other]).withColumn("sample_time", ntz("sample_time"))


@query(f"""
    WITH {CALS}, s AS (SELECT DISTINCT date_trunc('second', t) AS t, slope FROM cals WHERE instrument = 'click')
    SELECT 'C6H7' AS parameter, t AS sample_time, slope FROM s UNION ALL SELECT 'C7H9', t, 2.5::DOUBLE FROM s""")
def ion_calibrations(spark, sf):
    """An ion with zeros but no slope takes the sensitivity at every time."""
    c = calibrations(spark, sf).filter("instrument = 'click'").withColumn("date", F.date_format("sample_time", ISO))
    stats = as_csv(c.select(F.lit("C6H7").alias("species"), "slope", "date", F.lit(2.5).alias("ksens")), "stats.csv")
    zeros = as_csv(c.select("date", F.col("zero").alias("C6H7"), F.col("zero").alias("C7H9")), "zeros.csv")
    found, _ = readers.read_ion_calibrations(spark, [stats], [zeros])
    return found.select("parameter", ntz("sample_time").alias("sample_time"), "slope")


@query(f"WITH {CALS} SELECT 'Vocus-PTR-ToF' AS instrument, 'C7H9' AS parameter, t AS sample_time, zero FROM cals")
def ion_zeros(spark, sf):
    """Zeros through the writer of statistics and the reader of calibrations."""
    c = calibrations(spark, sf).select(F.date_format("sample_time", ISO).alias("date"), F.col("zero").alias("C7H9"), F.lit(1).alias("flag"))
    writers.write_stats(c, path := scratch_path(spark, "zeros.csv"))
    _, zeros = readers.read_ion_calibrations(spark, [], [path])
    return zeros.withColumn("sample_time", ntz("sample_time"))


@query(f"SELECT s_suppkey AS part, {sql_r('s_suppkey % 7 / 10.0::DOUBLE', 5)} AS lat, corner, 5 AS n FROM supplier CROSS JOIN (SELECT unnest(range(0, 5)) AS corner) WHERE corner = 0 ORDER BY 1")
def rings_geojson(spark, sf):
    """A square for each supplier, in one GeoJSON document; lines in it are left out."""
    k = F.col("s_suppkey")
    at = lambda dx, dy: F.array((F.lit(100.0) + k + dx), (k % 7 / 10.0 + dy))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0))).alias("coordinates"))
    one = table(spark, sf, "supplier").agg(F.to_json(F.struct(F.collect_list(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"))).alias("features"))).alias("value"))
    rings = readers.read_rings(spark, as_text(one, "zones.geojson"))
    return rings.select((F.get("ring", 0)["lon"] - 100).cast("bigint").alias("part"), r(F.get("ring", 0)["lat"], 5).alias("lat"), F.lit(0).cast("bigint").alias("corner"), F.size("ring").alias("n"))


_SA, _SO = sql_lat_lon("s_suppkey", 41, 59)


@query(f"""
    SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS segment_id, s_name AS road_name, s_suppkey % 2 = 0 AS oneway, {sql_r(f'{_SA} + s_suppkey * 0.1::DOUBLE', 5)} AS center_lat, {sql_r(_SO, 5)} AS end_lon,
           CAST(s_suppkey % 360 AS DOUBLE) AS bearing_deg FROM supplier""")
def segments_geojson(spark, sf):
    """Lines with properties to the columns that matching needs, numbered by place."""
    lat, lon = lat_lon("s_suppkey", 41, 59)
    k, text = F.col("s_suppkey"), lambda c: c.cast("string")
    center = lat + k * F.lit(0.1)
    props = F.create_map(F.lit("rd_name"), F.col("s_name"), F.lit("rd_type"), F.lit("residential"), F.lit("oneway"), F.when(k % 2 == 0, "true").otherwise("false"), F.lit("lat_30"), text(center), F.lit("lon_30"), text(lon), F.lit("rd_deg"), text(k % 360))
    line = F.struct(F.lit("LineString").alias("type"), F.array(F.array(lon, lat), F.array(lon, lat + F.lit(0.1))).alias("coordinates"))
    one = table(spark, sf, "supplier").agg(F.to_json(F.struct(F.collect_list(F.struct(props.alias("properties"), line.alias("geometry"))).alias("features"))).alias("value"))
    path = as_text(one, "roads.json")
    done = roads.segment_table(readers.read_segments(spark, path))
    return done.select("segment_id", "road_name", "oneway", r("center_lat", 5).alias("center_lat"), r("end_lon", 5).alias("end_lon"), "bearing_deg")


@query(f"SELECT s_suppkey AS segment_id, s_name AS road_name, s_suppkey % 2 = 0 AS oneway, {sql_r(_SA, 5)} AS center_lat FROM supplier")
def segments_csv(spark, sf):
    found = readers.read_segments(spark, as_csv(segments(spark, sf), "segments.csv"))
    return found.select("segment_id", "road_name", "oneway", r("center_lat", 5).alias("center_lat"))


@query("SELECT p_partkey AS segment_id FROM part WHERE p_size % 2 <> 0 OR (p_partkey % 3 <> 0 AND p_partkey % 5 <> 0)")
def without_service(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(k.alias("segment_id"), F.when(F.col("p_size") % 2 == 0, "service").otherwise("residential").alias("highway"), F.when(k % 3 != 0, "A").alias("road_name"), F.when(k % 5 == 0, "alley").alias("service"))
    return roads.without_service(p).select("segment_id")


@query(f"""
    WITH b AS (SELECT min({LAT}) - 200.0::DOUBLE / 111000 * 1.5 AS s, max({LAT}) + 200.0::DOUBLE / 111000 * 1.5 AS n, min({LON}) - 200.0::DOUBLE / 111000 * 1.5 AS w, max({LON}) + 200.0::DOUBLE / 111000 * 1.5 AS e FROM events)
    SELECT c_custkey AS segment_id FROM customer, b WHERE 37.79 + (c_custkey % 300) / 1e4::DOUBLE BETWEEN s AND n AND -122.31 + (c_custkey % 70) / 1e3::DOUBLE BETWEEN w AND e""")
def segments_in_box(spark, sf):
    lat, lon = lat_lon()
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(k.alias("segment_id"), (F.lit(37.79) + k % 300 / F.lit(1e4)).alias("center_lat"), (F.lit(-122.31) + k % 70 / F.lit(1e3)).alias("center_lon"))
    return roads.in_box(c, table(spark, sf, "events").select(lat.alias("lat"), lon.alias("lon"))).select("segment_id")


@query("SELECT 'segments_' || printf('%.1f', c_custkey / 10.0) || '_' || printf('%.1f', c_custkey / 10.0 - 200) || '_30m' AS file, round_even(c_custkey / 10.0::DOUBLE + 0.1, 1) AS north, 5 AS corners FROM customer")
def cell_names(spark, sf):
    """A cell's file name and the corners of its square."""
    a = F.col("c_custkey") / 10.0
    square = geo.ring(a, a - 200, 0.1)
    return table(spark, sf, "customer").select(roads.cell_file(a, a - 200, F.lit(30)).alias("file"), r(F.get(square, 2)["lat"], 1).alias("north"), F.size(square).alias("corners"))


@query("SELECT c_nationkey AS cell_lat, c_custkey % 7 AS cell_lon, 30 AS length_seg, count(*) AS n FROM customer GROUP BY ALL")
def cells_cached(spark, sf):
    """Segments through the cache's folders by cell."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("cell_lat"), (F.col("c_custkey") % 7).alias("cell_lon"), F.lit(30).alias("length_seg"), "c_name")
    writers.write_cells(c, path := scratch_path(spark, "cells"))
    back = spark.read.parquet(path).groupBy("cell_lat", "cell_lon", "length_seg").agg(F.count("*").alias("n"))
    return back.select("cell_lat", F.col("cell_lon").cast("bigint").alias("cell_lon"), "length_seg", "n")


# written tables


@query(f"WITH e AS (SELECT event_type, user_id, {sql_r('value', 5)} AS value FROM events) SELECT event_type, count(*) AS n, max(value) AS value FROM e GROUP BY event_type")
def output_folders(spark, sf):
    """Rounded tables in folders by a key; rewriting one folder leaves the others."""
    e = output.round_columns(table(spark, sf, "events").select("event_type", "user_id", "value"))
    path = scratch_path(spark, "l2.parquet")
    writers.write_table(e.withColumn("value", F.when(F.col("event_type") == "click", -1.0).otherwise(F.col("value"))), path, ["event_type"])
    writers.write_table(e.filter("event_type = 'click'"), path, ["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("value"))


@query("SELECT event_id FROM events WHERE value > 100")
def written_if_any(spark, sf):
    e, path = table(spark, sf, "events").select("event_id", "value"), scratch_path(spark, "targets")
    assert not writers.write_if_any(e.filter("value < 0"), f"{path}/none.parquet")
    assert writers.write_if_any(e.filter("value > 100"), f"{path}/some.parquet")
    return spark.read.parquet(path, recursiveFileLookup=True).select("event_id")


# times, days, settings


@query("""
    WITH l AS (SELECT o_orderkey, o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS INTEGER)) AS t FROM orders),
    y AS (SELECT *, make_date(CAST(year(t) AS BIGINT), 4, 1) AS a, make_date(CAST(year(t) AS BIGINT), 10, 31) AS o FROM l),
    s AS (SELECT *, (a + CAST((7 - dayofweek(a)) % 7 AS INTEGER)) + INTERVAL 2 HOUR AS low, (o - CAST(dayofweek(o) AS INTEGER)) + INTERVAL 2 HOUR AS high FROM y)
    SELECT o_orderkey, CASE WHEN (t >= low AND t < low + INTERVAL 1 HOUR) OR (t >= high - INTERVAL 1 HOUR AND t < high) THEN NULL WHEN t >= low AND t < high THEN t + INTERVAL 7 HOUR ELSE t + INTERVAL 8 HOUR END AS utc FROM s""")
def local_times(spark, sf):
    """Instants of local readings; those that the change of the clock skips or repeats have none."""
    at = (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") * 37 % 1440).cast("int"))).cast("timestamp_ntz")
    return table(spark, sf, "orders").select("o_orderkey", ntz(clock.local_to_utc(at, "America/Los_Angeles")).alias("utc"))


@query("""
    WITH r AS (SELECT CAST(min(ts) AS DATE) + 535 AS low, CAST(max(ts) AS DATE) + 535 AS high FROM events), d AS (SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day FROM r),
    n AS (SELECT CAST(ts AS DATE) + 535 AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT day, 'measurements_van1_' || strftime(day, '%Y-%m-%d') || CASE WHEN day > DATE '2025-06-29' THEN '_drive_range_long' ELSE '_no-geolocations_long' END || '.csv' AS log, coalesce(n, 0) AS n FROM d LEFT JOIN n USING (day)""")
def day_range(spark, sf):
    """The days from the first to the last event, moved to where logs change their names, given in both forms of text; the log and the events of each."""
    e = table(spark, sf, "events").select(F.date_add(F.to_date("ts"), 535).alias("day"))
    low, high = e.agg(F.date_format(F.min("day"), "yyyy-MM-dd"), F.date_format(F.max("day"), "yyyyMMdd")).first()
    logs = spark.createDataFrame([(d, readers.log_name(d)) for d in days(readers.parse_day(low), readers.parse_day(high))], "day date, log string")
    return logs.join(e.groupBy("day").agg(F.count("*").alias("n")), "day", "left").select("day", "log", F.coalesce("n", F.lit(0)).alias("n"))


@query("""
    WITH b AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS back, count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN '/raw/logs' WHEN 1 THEN '/elsewhere' ELSE '/done/road_segments' END || '/' || event_type AS path FROM b WHERE n >= 80 AND back BETWEEN 21 AND 80""")
def settings_yaml(spark, sf):
    """Settings from a file, those it leaves out, and paths that follow from the base folders, at work on rows: the tail of each type of event."""
    paths, conf = config.load("paths: {base_raw: /raw, base_processed: /done, output_l2: /elsewhere}\nconfig: {min_cal_samples: 80}\n")
    tails = ordered.tail_rows(table(spark, sf, "events"), ["event_type"], ["event_id"], conf.min_cal_samples, conf.cal_window_samples)
    folder = F.element_at(F.array(F.lit(paths.logs_raw), F.lit(paths.output_l2), F.lit(paths.roads_cache)), (F.col("event_id") % 3 + 1).cast("int"))
    return tails.select("event_id", F.concat_ws("/", folder, "event_type").alias("path"))


# calibration


@query(f"""
    WITH f AS (SELECT user_id, ts, value, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1e6::DOUBLE AS gap FROM events WHERE event_type = 'view' AND value > 40),
    s AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 86400 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS flag FROM f),
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id, flag ORDER BY ts DESC) AS k, count(*) OVER (PARTITION BY user_id, flag) AS m FROM s)
    SELECT user_id, CAST(flag AS BIGINT) AS flag, {sql_r('avg(value)')} AS value FROM n WHERE m >= 3 AND k BETWEEN 2 AND 3 GROUP BY user_id, flag""")
def zero_sessions(spark, sf):
    """Zeros: the right valve, enough flow, long enough; the mean of the tail of each."""
    e = table(spark, sf, "events").select("user_id", F.col("ts").alias("date"), "value", (F.col("event_type") == "view").cast("int").alias("zero_valve"), F.lit(0).alias("cal_valve"), (F.col("value") + 360).alias("zero_flow"))
    out = calibration.drive_zeros(e, ["user_id"], ["value"], 86400, 400, 3, 2)
    return out.select("user_id", F.col("flag").cast("bigint").alias("flag"), r("value").alias("value"))


_SIGN = "sign(covar_pop(l_extendedprice, l_quantity)) * stddev_pop(l_extendedprice) / stddev_pop(l_quantity)"


@query(f"SELECT l_returnflag AS species, {sql_r(_SIGN, 3)} AS slope, (SELECT max(l_shipdate) FROM lineitem) AS date FROM lineitem GROUP BY l_returnflag")
def species_lines(spark, sf):
    """A slope for each species, at the latest time of all."""
    steps = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("species"), F.col("l_extendedprice").alias("counts"), F.col("l_quantity").alias("cal_conc_dil"), F.col("l_shipdate").alias("date"))
    return calibration.fit_species(steps, []).select("species", r("slope", 3).alias("slope"), ntz("date").alias("date"))


@query("SELECT DISTINCT l_linestatus, 2.5e9::DOUBLE AS ksens FROM lineitem")
def sensitivity_default(spark, sf):
    """With one usable species there is no line: the default rate stands in."""
    stats = table(spark, sf, "lineitem").groupBy("l_linestatus").agg(F.avg("l_quantity").alias("slope")).select("l_linestatus", F.explode(F.array(F.lit("C6H7"), F.lit("CH5S"))).alias("species"), "slope")
    return calibration.sensitivity(stats, spark.createDataFrame([("C6H7", 2e-9), ("CH5S", 3e-9)], "species string, ksens double"), ["l_linestatus"])


def _named(sql_instrument: str, sql_parameter: str) -> tuple[str, str]:
    """Two of the test instruments under the names that calibration treats apart."""
    i = f"CASE {sql_instrument} WHEN 'click' THEN 'EcoPhysics_NOX' WHEN 'view' THEN 'Vocus-PTR-ToF' ELSE {sql_instrument} END"
    p = f"CASE {sql_instrument} WHEN 'click' THEN (CASE WHEN {sql_parameter} IN ('p0', 'p2') THEN 'NO' ELSE 'NOx' END) WHEN 'view' THEN 'C' || right({sql_parameter}, 1) || 'H7' ELSE {sql_parameter} END"
    return i, p


_I, _P = _named("instrument", "parameter")
_EI, _EP = _named("event_type", "('p' || CAST(user_id % 4 AS VARCHAR))")


@query(f"""
    WITH {CALS},
    c AS (SELECT {_I} AS instrument, {_P} AS parameter, t, slope, intercept, zero FROM cals),
    m AS (SELECT CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS sample_time, {_EI} AS instrument, {_EP} AS parameter, value, event_id FROM events),
    b AS (SELECT day, instrument, parameter, min(sample_time) AS low, max(sample_time) AS high FROM m GROUP BY ALL),
    a AS (SELECT b.day, b.instrument, b.parameter, arg_max(struct_pack(t := t, s := slope, i := intercept), t) FILTER (WHERE t < low) AS x, arg_min(struct_pack(t := t, s := slope, i := intercept), t) FILTER (WHERE t > high) AS y
          FROM b JOIN c ON b.instrument = c.instrument AND b.parameter = c.parameter GROUP BY ALL),
    j AS (SELECT m.*, x, y, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN (epoch_us(sample_time) - epoch_us(x.t))::DOUBLE / (epoch_us(y.t) - epoch_us(x.t))::DOUBLE END AS w
          FROM m LEFT JOIN a ON m.day = a.day AND m.instrument = a.instrument AND m.parameter = a.parameter),
    q AS (SELECT *, CASE WHEN x IS NULL AND y IS NULL THEN 1 WHEN w IS NOT NULL THEN x.s + (y.s - x.s) * w ELSE coalesce(x, y).s END AS slope,
          CASE WHEN x IS NULL AND y IS NULL THEN 0 WHEN w IS NOT NULL THEN x.i + (y.i - x.i) * w ELSE coalesce(x, y).i END AS intercept FROM j),
    z AS (SELECT instrument, parameter, t, zero, lead(t) OVER w AS t2, lead(zero) OVER w AS z2, row_number() OVER w AS k, count(*) OVER (PARTITION BY instrument, parameter) AS n FROM c WHERE instrument = 'Vocus-PTR-ToF' WINDOW w AS (PARTITION BY instrument, parameter ORDER BY t)),
    i AS (SELECT *, CASE WHEN k > 1 THEN t END AS low, CASE WHEN k < n - 1 THEN t2 END AS high FROM z WHERE n >= 2 AND t2 IS NOT NULL),
    v AS (SELECT q.day, q.sample_time, q.instrument, q.parameter, (value - coalesce(i.zero + (z2 - i.zero) * ((epoch_us(sample_time) - epoch_us(t))::DOUBLE / (epoch_us(t2) - epoch_us(t))::DOUBLE), 0) - intercept) / slope AS value
          FROM q LEFT JOIN i ON q.instrument = i.instrument AND q.parameter = i.parameter AND (low IS NULL OR q.sample_time > low) AND (high IS NULL OR q.sample_time <= high)),
    d AS (SELECT day, sample_time, instrument, 'NO2' AS parameter, avg(value) FILTER (WHERE parameter = 'NOx') - avg(value) FILTER (WHERE parameter = 'NO') AS value FROM v WHERE instrument = 'EcoPhysics_NOX' GROUP BY ALL),
    u AS (SELECT * FROM v UNION ALL SELECT * FROM d WHERE value IS NOT NULL)
    SELECT day, sample_time, instrument, parameter, {sql_r('min(value)')} AS value, '0' AS summary_flag FROM u GROUP BY ALL""")
def calibrate_day(spark, sf):
    """The whole calibration: brackets, zeros of ions, NO2 from NOx and NO, each moment once."""
    named = lambda df: df.withColumns({"instrument": F.expr(_I), "parameter": F.expr(_P)})
    rows = named(readings(spark, sf)).select(F.to_date("sample_time").alias("day"), ntz(F.date_trunc("hour", "sample_time")).alias("sample_time"), "instrument", "parameter", "value", F.lit("0").alias("summary_flag"))
    cals = named(calibrations(spark, sf))
    out = calibration.calibrate(rows, cals, cals.select("instrument", "parameter", "sample_time", "zero"), ["day"], ["summary_flag"])
    return out.select("day", "sample_time", "instrument", "parameter", r("value").alias("value"), "summary_flag")


@query(ORACLE_SQL["calibrate_day"])
def calibrate_stored(spark, sf):
    """The whole calibration from a store that was filled in three parts, in no order of time, and is asked for the readings' span."""
    named = lambda df: df.withColumns({"instrument": F.expr(_I), "parameter": F.expr(_P)})
    rows = named(readings(spark, sf)).select(F.to_date("sample_time").alias("day"), ntz(F.date_trunc("hour", "sample_time")).alias("sample_time"), "instrument", "parameter", "value", F.lit("0").alias("summary_flag"))
    cals = named(calibrations(spark, sf)).withColumn("part", F.pmod(F.xxhash64("sample_time"), F.lit(3)))
    store = CalibrationStore(spark, scratch_path(spark, "calibrations"), 7 * 86_400)
    none = spark.createDataFrame([], "instrument string, sample_time timestamp, ksens double")
    for k in range(3):
        part = cals.filter(F.col("part") == k)
        store.put(part, none, part)
    slopes, _, zeros = store.around(*rows.agg(F.min(clock.micros("sample_time")), F.max(clock.micros("sample_time"))).first())
    out = calibration.calibrate(rows, slopes, zeros, ["day"], ["summary_flag"])
    return out.select("day", "sample_time", "instrument", "parameter", r("value").alias("value"), "summary_flag")
