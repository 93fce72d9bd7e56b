"""Targets: readings of known standards during a drive, less what they should be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions.clock import micros
from tracklake.functions.numbers import diluted
from tracklake.operators.calibration import ION_INSTRUMENT
from tracklake.operators.gps import pivot_last
from tracklake.operators.ordered import sessions, tail_seconds

#: Parameters that say what flows (fixed values), and gases whose standards are stored in thousandths.
GATES = ["cal_valve", "zero_valve", "cal_flow", "zero_flow", "Inlet_Number"]
THOUSANDTHS = ("CH4", "CO", "N2O")


def requested(spark, instruments: list[str], cylinders: list[str]) -> DataFrame:
    """The instruments and the cylinder of each, in pairs by position."""
    if len(instruments) != len(cylinders):
        raise ValueError(f"{len(instruments)} target instruments but {len(cylinders)} cylinders")
    return spark.createDataFrame(list(zip(instruments, cylinders, strict=True)), "instrument string, cylinder_number string")


def target_concentrations(requests: DataFrame, standards: DataFrame) -> DataFrame:
    """Concentrations above zero of the requested cylinders' gases, in the readings' units.

    ``standards``: cylinder_number, species, cal_concs.
    """
    conc = F.when(F.col("species").isin(*THOUSANDTHS), F.col("cal_concs") / 1000).otherwise(F.col("cal_concs"))
    return requests.join(standards.filter("cal_concs > 0"), "cylinder_number").select("instrument", F.col("species").alias("parameter"), conc.alias("conc"))


def windows_join(readings: DataFrame, windows: DataFrame, keys: list[str], time: str, start: str, end: str, bucket_s: int) -> DataFrame:
    """Readings in each window [start, end] of their keys; a reading in several windows comes several times.

    A range join: windows are dealt to the time buckets that they touch, so the
    join is on keys and bucket and only then on the times.
    """
    us = bucket_s * 1_000_000
    low, high = F.floor(micros(start) / us), F.floor(micros(end) / us)
    dealt = windows.withColumn("_bucket", F.explode(F.sequence(low.cast("bigint"), high.cast("bigint"))))
    rows = readings.withColumn("_bucket", F.floor(micros(time) / us).cast("bigint"))
    return rows.join(dealt, [*keys, "_bucket"]).filter(F.col(time).between(F.col(start), F.col(end))).drop("_bucket")


def ion_targets(readings: DataFrame, gates: DataFrame, concs: DataFrame, drive: list[str], flow: float = 1.0, length_s: float = 60.0) -> DataFrame:
    """Residuals of the ion instrument while both valves are open at the target flow."""
    on = (F.col("cal_valve") == 1) & (F.col("zero_valve") == 1) & (F.abs(F.col("cal_flow") - flow) < 0.5)
    times = gates.filter((F.col("instrument") == ION_INSTRUMENT) & on).select(*drive, "instrument", "sample_time", "cal_flow", "zero_flow")
    rows = readings.select(*drive, "instrument", "parameter", "sample_time", "value").join(times, [*drive, "instrument", "sample_time"])
    by = [*drive, "instrument", "parameter"]
    numbered = sessions(rows, by, "sample_time", 3.0, inclusive=True)
    tails = tail_seconds(numbered, [*by, "period"], "sample_time", length_s, 10.0)
    joined = tails.join(concs, ["instrument", "parameter"])
    val = F.col("value") - diluted(F.col("conc"), F.col("cal_flow"), F.col("zero_flow"))
    return joined.select(*drive, "sample_time", "instrument", "parameter", val.alias("val"))


def inlet_targets(readings: DataFrame, gates: DataFrame, concs: DataFrame, drive: list[str], long_s: int = 70, skip_s: int = 10) -> DataFrame:
    """Residuals of the other instruments near the end of each stay on the target inlet."""
    on = gates.filter((F.col("Inlet_Number") == 1) & (F.col("instrument") != ION_INSTRUMENT)).select(*drive, "instrument", "sample_time")
    by = [*drive, "instrument"]
    ends = sessions(on, by, "sample_time", 3.0, inclusive=True).groupBy(*by, "period").agg(F.max("sample_time").alias("_end"))
    at = lambda s: F.timestamp_micros(micros("_end") - s * 1_000_000)
    windows = ends.select(*by, at(long_s).alias("_from"), at(skip_s).alias("_to"))
    rows = windows_join(readings.select(*by, "parameter", "sample_time", "value"), windows, by, "sample_time", "_from", "_to", 2 * long_s)
    joined = rows.join(concs, ["instrument", "parameter"])
    return joined.select(*drive, "sample_time", "instrument", "parameter", (F.col("value") - F.col("conc")).alias("val"))


def find_targets(readings: DataFrame, requests: DataFrame, standards: DataFrame, drive: list[str], flow: float = 1.0, length_s: float = 60.0, long_s: int = 70, skip_s: int = 10) -> DataFrame:
    """All residuals of the requested instruments: drive columns, sample_time, instrument, parameter, val."""
    rows = readings.join(requests.select("instrument"), "instrument", "left_semi")
    order = ["value"] if "row_number" not in rows.columns else ["row_number"]
    gates = pivot_last(rows, [*drive, "sample_time", "instrument"], GATES, order)
    concs = target_concentrations(requests, standards)
    return ion_targets(rows, gates, concs, drive, flow, length_s).unionByName(inlet_targets(rows, gates, concs, drive, long_s, skip_s)).filter("val is not null")
