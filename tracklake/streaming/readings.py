"""Streams of readings: range flags, means of minutes, sessions.

Each takes a streaming DataFrame in long form and returns one; sinks and
triggers are the caller's.  Watermarks bound the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators.quality import status_numbers, with_flags


def flag_stream(readings: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Each reading with its flag; no state."""
    return with_flags(status_numbers(readings), thresholds)


def minute_means(readings: DataFrame, late: str = "2 minutes", width: str = "1 minute") -> DataFrame:
    """Means of tumbling windows for each instrument and parameter; readings later than ``late`` are left out."""
    return (
        readings.withWatermark("sample_time", late)
        .groupBy(F.window("sample_time", width), "instrument", "parameter")
        .agg(F.avg("value").alias("mean_value"), F.count("value").alias("n"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "instrument", "parameter", "mean_value", "n")
    )


def session_stream(readings: DataFrame, gap: str = "30 seconds", late: str = "2 minutes") -> DataFrame:
    """Sessions of each instrument, apart by more than ``gap``: the rule that a session window has."""
    return (
        readings.withWatermark("sample_time", late)
        .groupBy(F.session_window("sample_time", gap), "instrument")
        .agg(F.count("*").alias("n"), F.min("sample_time").alias("first"), F.max("sample_time").alias("last"))
        .select("instrument", "first", "last", "n")
    )
