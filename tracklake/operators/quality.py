"""Quality control of instrument readings: lags, range flags, joining positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.clock import month, shifted
from tracklake.functions.numbers import known
from tracklake.functions.text import flag_text
from tracklake.operators.small import small

#: Instruments whose NO2 is raw and is left out after flagging; it is derived later (fixed values).
RAW_NO2 = ("EcoPhysics_NOX", "Vocus-PTR-ToF")


def apply_lags(readings: DataFrame, lags: DataFrame) -> DataFrame:
    """Move each reading back by its instrument's lag in its month; no entry means no lag.

    ``lags`` (month, instrument, lag_s) is small: months times instruments.
    """
    table = lags.select(F.col("month").cast("timestamp").alias("_month"), "instrument", F.col("lag_s").cast("double").alias("_lag"))
    joined = readings.withColumn("_month", month(F.col("sample_time").cast("timestamp"))).join(table, ["_month", "instrument"], "left")
    return joined.withColumn("sample_time", shifted("sample_time", -F.col("_lag"))).drop("_month", "_lag").select(*readings.columns)


def lag_counts(readings: DataFrame, lags: DataFrame) -> DataFrame:
    """How many readings of each instrument have a lag that is not zero."""
    table = lags.select(F.col("month").cast("timestamp").alias("_month"), "instrument", "lag_s")
    rows = readings.withColumn("_month", month(F.col("sample_time").cast("timestamp"))).join(table, ["_month", "instrument"])
    return rows.filter("lag_s <> 0").groupBy("instrument").agg(F.count("*").alias("n_lagged"))


def within_track(readings: DataFrame, track: DataFrame, by: list[str], time: str = "sample_time") -> DataFrame:
    """Readings from the first to the last time of the track, both included, in each group of ``by``."""
    bounds = track.groupBy(*by).agg(F.min(time).alias("_low"), F.max(time).alias("_high"))
    joined = readings.join(small(bounds), by) if by else readings.crossJoin(F.broadcast(bounds))  # a row for each drive, or one
    return joined.filter(F.col(time).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")


def status_numbers(readings: DataFrame) -> DataFrame:
    """Status texts become values, where they are numbers; other values stay, NaN becomes null."""
    status = (F.col("parameter") == "Status") & F.col("string").isNotNull()
    return readings.withColumn("value", known(F.when(status, F.col("string").try_cast("double")).otherwise(F.col("value"))))


def range_flag(value: Column, low: Column, high: Column, flag: Column) -> Column:
    """The flag where the value lies outside both bounds that exist, else 0; null values never do."""
    return F.when(F.coalesce((value < low) | (value > high), F.lit(False)) & low.isNotNull() & high.isNotNull(), flag).otherwise(F.lit(0))


def with_flags(readings: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Add ``flag`` by the range of the reading's instrument and parameter."""
    table = thresholds.select("instrument", "parameter", "range_start", "range_end", "flag_value")
    joined = readings.join(table, ["instrument", "parameter"], "left")
    flag = range_flag(F.col("value"), F.col("range_start"), F.col("range_end"), F.col("flag_value"))
    return joined.withColumn("flag", flag).drop("range_start", "range_end", "flag_value")


def summary_flags(flagged: DataFrame, by: list[str]) -> DataFrame:
    """Each group's flags as text."""
    return flagged.groupBy(*by).agg(flag_text(F.collect_set(F.when(F.col("flag") != 0, F.col("flag")))).alias("summary_flag"))


def flag_readings(readings: DataFrame, thresholds: DataFrame, drive: list[str] | None = None) -> DataFrame:
    """Flags of each instrument and time on all its readings; then raw NO2 and nameless readings go.

    The flags of a moment are collected over a window, so the readings are
    shuffled once and not joined with themselves.
    """
    moment = Window.partitionBy(*(drive or []), "sample_time", "instrument")
    flagged = with_flags(status_numbers(readings), thresholds)
    text = flag_text(F.collect_set(F.when(F.col("flag") != 0, F.col("flag"))).over(moment))
    raw = F.coalesce((F.col("parameter") == "NO2") & F.col("instrument").isin(*RAW_NO2), F.lit(False))
    return flagged.withColumn("summary_flag", text).drop("flag", "string").filter(F.col("parameter").isNotNull() & ~raw)


def join_track(readings: DataFrame, track: DataFrame, by: list[str]) -> DataFrame:
    """Readings with the position of exactly their time; smoothed coordinates if any fix is smoothed, else raw ones, must be known."""
    need = ("lat_smooth", "lon_smooth") if "lat_smooth" in track.columns else ("lat", "lon")
    good = track.filter(F.col(need[0]).isNotNull() & F.col(need[1]).isNotNull())
    return readings.join(good, [*by, "sample_time"])
