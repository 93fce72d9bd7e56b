"""Readers: each gives a DataFrame of a known shape; NaN becomes null at the door."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.clock import floor_second, local_to_utc, parse_mixed
from tracklake.functions.numbers import known
from tracklake.functions.text import without_suffix
from tracklake.operators.calibration import ION_INSTRUMENT, fill_species, long_zeros
from tracklake.operators.gps import GPS_PARAMETERS, pivot_track

LONG = T.StructType(
    [
        T.StructField("sample_time", T.TimestampType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("string", T.StringType()),
    ]
)
ELEMENTS = "elements array<struct<type:string,id:bigint,lat:double,lon:double,nodes:array<bigint>,tags:map<string,string>>>"
#: The date after which logs have another name (fixed value).
RENAMED_AFTER = date(2025, 6, 29)


def _csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.csv(path, header=True, nullValue="NA")


def _csv_by_header(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Many CSV files as one scan for each header among them, so plans do not grow with the number of files."""
    if not paths:
        return []
    head = F.trim(F.substring_index(F.col("content").cast("string"), "\n", 1))
    by: dict[str, list[str]] = {}
    for r in spark.read.format("binaryFile").load(paths).select("path", head.alias("head")).collect():
        by.setdefault(r.head, []).append(r.path)
    return [_csv(spark, sorted(found)) for _, found in sorted(by.items())]


def _number(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: known(F.col(n).try_cast("double")) for n in names if n in df.columns})


def read_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A vehicle log in long form (CSV); ``instrument`` and ``string`` are null where the file has none, a file without the others is none."""
    df = _csv(spark, path)
    if missing := {"sample_time", "parameter", "value"} - set(df.columns):
        raise ValueError(f"{path} is no log: it has no {', '.join(sorted(missing))}")
    have = [f.name for f in LONG if f.name in df.columns]
    df = df.select(*have).withColumns({f.name: F.lit(None).cast(f.dataType) for f in LONG if f.name not in have})
    return df.withColumns({"sample_time": parse_mixed("sample_time"), "value": known(F.col("value").try_cast("double"))}).select(*LONG.names)


def read_gps(spark: SparkSession, path: str) -> DataFrame:
    """A GPS file, long or wide (CSV): sample_time, lat, lon, speed, direction.

    A long one is pivoted to one row a second; a wide one is only renamed.
    """
    df = _csv(spark, path)
    if {"parameter", "value"} <= set(df.columns):
        long = df.select(parse_mixed("sample_time").alias("sample_time"), "parameter", F.col("value").try_cast("double").alias("value"))
        return pivot_track(long, [])
    df = df.withColumnsRenamed({"datetime": "sample_time"} | {k: v for k, v in GPS_PARAMETERS.items()})
    df = _number(df, *GPS_PARAMETERS.values()).withColumn("sample_time", parse_mixed("sample_time"))
    missing = {n: F.lit(None).cast("double") for n in GPS_PARAMETERS.values() if n not in df.columns}
    return df.withColumns(missing).select("sample_time", *GPS_PARAMETERS.values())


def read_cps(spark: SparkSession, path: str | list[str], zone: str = "UTC") -> DataFrame:
    """Counts per second in wide form (Parquet); ``date`` becomes an instant of the given zone."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    text = dict(df.dtypes)["date"] == "string"
    at = parse_mixed("date") if text else F.col("date").cast("timestamp")
    if zone != "UTC":
        at = local_to_utc(F.regexp_replace("date", "T", " ").cast("timestamp_ntz") if text else F.col("date"), zone)
    return df.withColumn("date", at)


def cps_long(cps: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Counts per second as long readings of the ion instrument, on whole seconds.

    Naming the needed columns keeps the others from being read at all.
    """
    names = columns or [c for c in cps.columns if c != "date"]
    doubles = cps.select(floor_second("date").alias("sample_time"), *(known(F.col(f"`{c}`").cast("double")).alias(c) for c in names))
    long = doubles.unpivot(["sample_time"], names, "parameter", "value")
    return long.select("sample_time", F.lit(ION_INSTRUMENT).alias("instrument"), "parameter", "value", F.lit(None).cast("string").alias("string"))


def log_name(day: date) -> str:
    """The file name of a day's log."""
    kind = "drive_range_long" if day > RENAMED_AFTER else "no-geolocations_long"
    return f"measurements_van1_{day:%Y-%m-%d}_{kind}.csv"


def read_day(spark: SparkSession, logs: str, day: date, cps: str | None = None, zone: str = "America/Los_Angeles", columns: list[str] | None = None) -> DataFrame:
    """A day's log and, if there is any, its ion counts, as one long table."""
    log = read_log(spark, f"{logs}/{log_name(day)}")
    return log.unionByName(cps_long(read_cps(spark, cps, zone), columns)) if cps else log


TRACK_COLUMNS = ["sample_time", "lat", "lon", "lat_smooth", "lon_smooth", "lat_snap", "lon_snap", "seg_start_lat", "seg_start_lon", "seg_end_lat", "seg_end_lon"]


def read_track(spark: SparkSession, path: str) -> DataFrame:
    """A processed track (Parquet or CSV); times without a zone are UTC."""
    if path.endswith(".rds"):
        raise ValueError("convert .rds files to Parquet first")
    df = _csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)
    df = df.withColumnsRenamed({"datetime": "sample_time"})
    df = _number(df, *TRACK_COLUMNS[1:])
    at = parse_mixed("sample_time") if dict(df.dtypes)["sample_time"] == "string" else F.col("sample_time").cast("timestamp")
    return df.withColumn("sample_time", at).select(*(c for c in TRACK_COLUMNS if c in df.columns))


def read_lags(spark: SparkSession, path: str) -> DataFrame:
    """Lags of each month and instrument in seconds, from a wide or a long table."""
    df = _csv(spark, path)
    if "instrument" not in df.columns:
        df = df.unpivot(["month"], [c for c in df.columns if c != "month"], "instrument", "lag_s")
    return df.select(F.to_date("month", "M/d/yyyy").cast("timestamp").alias("month"), "instrument", F.col("lag_s").try_cast("int").alias("lag_s"))


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """Ranges and flag values of each instrument and parameter."""
    df = _number(_csv(spark, path), "range_start", "range_end")
    return df.withColumn("flag_value", F.col("flag_value").try_cast("int"))


def read_fields(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path).withColumn("duration", F.col("duration").try_cast("int"))


def read_standards(spark: SparkSession, path: str) -> DataFrame:
    """Cylinder standards to rows: cylinder_number, part_number, species, cal_concs."""
    df = _csv(spark, path)
    ids, gases = df.columns[:2], df.columns[2:]
    long = df.unpivot(ids, gases, "species", "cal_concs")
    return long.select(*ids, without_suffix("species").alias("species"), F.col("cal_concs").try_cast("double").alias("cal_concs"))


#: Reaction rates (cm3/s) of the species in the two standard cylinders (fixed values).
RATES = {
    "CC524064": {
        "C2H5O": 2.97e-9, "CH5O": 2.31e-9, "CH5S": 2.21e-9, "C2H7O": 2.37e-9, "C2H4N": 4.03e-9, "C3H7O": 3.24e-9, "C3H4N": 4.17e-9, "C5H9": 1.93e-9,
        "C2H7S": 2.26e-9, "C4H7O": 3.51e-9, "C4H9O": 3.23e-9, "C6H7": 1.93e-9, "C7H9": 2.07e-9, "C6H19O3Si3": 3.20e-9, "C8H11": 2.21e-9,
        "C10H17": 2.48e-9, "C9H13": 2.42e-9, "C10H23": 2.50e-9, "C10H31O5Si5": 3.50e-9,
    },
    "CC515288": {
        "C2H5O": 2.97e-9, "CH5O": 2.31e-9, "C2H7O": 2.37e-9, "C3H7O": 3.24e-9, "C3H4N": 4.17e-9, "C5H9": 1.93e-9, "C4H7O": 3.51e-9, "C4H9O": 3.23e-9,
        "C7H9": 2.07e-9, "C8H11": 2.21e-9, "C10H17": 2.48e-9, "C9H13": 2.42e-9, "C10H23": 2.50e-9, "C10H31O5Si5": 3.50e-9, "C6H15": 3.00e-9,
    },
}


def read_rates(spark: SparkSession, cylinder: str, path: str | None = None) -> DataFrame:
    """Reaction rates of a cylinder's species; without a file those of the standard cylinders, else none."""
    if path:
        df = _csv(spark, path).filter(F.col("cylinder_number") == cylinder)
        return df.select("species", F.col("ksens").try_cast("double").alias("ksens"))
    return spark.createDataFrame(list(RATES.get(cylinder, {}).items()), "species string, ksens double")


def read_peak_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the peaks in the order of their index; a missing file is an error."""
    return [r.species for r in sorted(_csv(spark, path).select(F.col("index").cast("int").alias("i"), "species").collect())]


def read_control_columns(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(index, name) of the control columns in the order of the file."""
    return [(int(r["index"]), r["name"]) for r in _csv(spark, path).collect()]


def read_gas_calibrations(spark: SparkSession, plain: list[str], renamed: list[str]) -> DataFrame:
    """Slopes and intercepts of the gas instruments, from both shapes of file."""
    out = None
    for paths, names in ((plain, {}), (renamed, {"compound": "parameter", "date": "sample_time", "instrument_d": "instrument"})):
        for df in _csv_by_header(spark, paths):
            df = _number(df.withColumnsRenamed(names), "slope", "intercept").withColumn("sample_time", parse_mixed("sample_time"))
            df = df.withColumns({c: F.lit(None).cast("double") for c in ("slope", "intercept") if c not in df.columns})
            df = df.select("instrument", "parameter", "sample_time", "slope", "intercept")
            out = df if out is None else out.unionByName(df)
    return out if out is not None else spark.createDataFrame([], "instrument string, parameter string, sample_time timestamp, slope double, intercept double")


def read_ion_slopes(spark: SparkSession, stats: list[str], zeros: list[str], letters: str = "HCOKSNV") -> tuple[DataFrame, DataFrame]:
    """Slopes of the ions with the sensitivity at their time (instrument, parameter, sample_time, slope, ksens), and zeros."""
    empty = spark.createDataFrame([], "instrument string, parameter string, sample_time timestamp, zero double")
    z = empty
    for df in _csv_by_header(spark, zeros):
        if "date" in df.columns:
            df = df.withColumn("date", parse_mixed("date"))
            df = _number(df, *(c for c in df.columns if c[:1] in letters and c != "V1"))
            z = z.unionByName(long_zeros(df, letters))
    s = None
    for df in _csv_by_header(spark, stats):
        df = _number(df, "slope", "ksens")
        df = df.withColumns({c: F.lit(None).cast("double") for c in ("ksens",) if c not in df.columns})
        df = df.select(F.lit(ION_INSTRUMENT).alias("instrument"), F.col("species").alias("parameter"), floor_second(parse_mixed("date")).alias("sample_time"), "slope", "ksens")
        s = df if s is None else s.unionByName(df)
    if s is None:
        s = spark.createDataFrame([], "instrument string, parameter string, sample_time timestamp, slope double, ksens double")
    return s, z


def read_ion_calibrations(spark: SparkSession, stats: list[str], zeros: list[str], letters: str = "HCOKSNV") -> tuple[DataFrame, DataFrame]:
    """Slopes of the ions (without intercepts), filled for ions that only have zeros, and the zeros themselves."""
    s, z = read_ion_slopes(spark, stats, zeros, letters)
    s = fill_species(s, z.select("parameter"))
    return s.select("instrument", "parameter", "sample_time", "slope", F.lit(None).cast("double").alias("intercept")), z


def read_rings(spark: SparkSession, path: str) -> DataFrame:
    """Outer rings of the polygons in a GeoJSON file, as arrays of (lat, lon)."""
    kind = "features array<struct<geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.explode("features.geometry").alias("g")).filter("g.type = 'Polygon'")
    return rows.select(F.transform(F.col("g.coordinates")[0], lambda p: F.struct(p[1].alias("lat"), p[0].alias("lon"))).alias("ring"))


def read_segments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Road segments from Parquet, CSV, or GeoJSON lines with properties."""
    first = path if isinstance(path, str) else path[0]
    if first.endswith(".csv"):
        numbers = ("start_lat", "start_lon", "end_lat", "end_lon", "center_lat", "center_lon", "bearing_deg")
        return _number(_csv(spark, path), *numbers).withColumns({"segment_id": F.col("segment_id").cast("bigint"), "oneway": F.col("oneway").cast("boolean")})
    if not first.endswith("json"):
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    kind = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:array<array<double>>>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.explode("features").alias("f")).filter("f.geometry.type = 'LineString'")
    p, a, b = F.col("f.properties"), F.col("f.geometry.coordinates")[0], F.element_at("f.geometry.coordinates", -1)
    centre = lambda k: F.coalesce(*(F.try_element_at(p, F.lit(f"{k}_{n}")) for n in (30, 50, 100)), F.try_element_at(p, F.lit(f"center_{k}"))).cast("double")
    return rows.select(
        F.try_element_at(p, F.lit("rd_name")).alias("rd_name"), F.try_element_at(p, F.lit("rd_type")).alias("rd_type"), F.coalesce(F.try_element_at(p, F.lit("oneway")).try_cast("boolean"), F.lit(False)).alias("oneway"),
        F.try_element_at(p, F.lit("service")).alias("service"), a[1].alias("start_lat"), a[0].alias("start_lon"), b[1].alias("end_lat"), b[0].alias("end_lon"),
        centre("lat").alias("center_lat"), centre("lon").alias("center_lon"), F.try_element_at(p, F.lit("rd_deg")).try_cast("double").alias("bearing_deg"),
    )


def read_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Map elements from the answers of a map server, saved as JSON."""
    return spark.read.schema(ELEMENTS).json(path, multiLine=True).select(F.explode("elements").alias("e")).select("e.*")


def read_box(spark: SparkSession, path: str, south: float, west: float, north: float, east: float) -> DataFrame:
    """Rows of a processed track strictly inside a box; the bounds reach the scan."""
    df = spark.read.parquet(path)
    lat, lon = ("lat_smooth", "lon_smooth") if "lat_smooth" in df.columns else ("lat", "lon")
    return df.filter((F.col(lat) > south) & (F.col(lat) < north) & (F.col(lon) > west) & (F.col(lon) < east))


def parse_day(text: str) -> date:
    """A day from ``2025-07-15`` or ``20250715``."""
    return datetime.strptime(text.replace("-", ""), "%Y%m%d").date()
