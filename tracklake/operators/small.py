"""Sides of joins that are expected to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most rows that are sent to every task, and the most bytes, counted as JSON.
SMALL_ROWS, SMALL_BYTES = 200_000, 32 << 20


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows and ``SMALL_BYTES`` bytes, which are counted; else left to a shuffled join.

    Meant for derived sides (a row for each drive, ion or file), whose size
    Spark cannot estimate.  Tables that are read need no mark: Spark sees how
    large they are.
    """
    n, size = df.limit(rows + 1).agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return F.broadcast(df) if n <= rows and (size or 0) <= SMALL_BYTES else df
