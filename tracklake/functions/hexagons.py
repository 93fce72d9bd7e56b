"""Hexagon cells by the optional library h3."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def hexagon_cells(resolution: int) -> Callable[[Column, Column], Column] | None:
    """A function of latitude and longitude that gives a cell's id, or None where the library is missing.

    Callers pass it on as ``cell_id``; without it ids are null.
    """
    try:
        import h3
    except ImportError:
        return None

    @F.pandas_udf("string")
    def cell(lat: pd.Series, lon: pd.Series) -> pd.Series:
        good = lat.notna() & lon.notna()
        return pd.Series([h3.latlng_to_cell(a, b, resolution) if g else None for a, b, g in zip(lat, lon, good, strict=True)])

    return cell
