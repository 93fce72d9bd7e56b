"""Published tables: units, rounding, field names, exclusion zones, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.geo import cell
from tracklake.functions.numbers import round_even
from tracklake.operators import noding

#: Parameters published in thousandths, and the one in thousands (fixed values).
THOUSANDFOLD, THOUSANDTH = ("CH4", "N2O", "CO"), "BC6"
COORDINATES = ("lat", "lon", "lat_smooth", "lon_smooth", "lat_snap", "lon_snap", "seg_start_lat", "seg_start_lon", "seg_end_lat", "seg_end_lon")


def round_columns(df: DataFrame, value_places: int = 5, coord_places: int = 5) -> DataFrame:
    """Values and coordinates rounded half to even, before anything is published."""
    new = {"value": round_even("value", value_places)} if "value" in df.columns else {}
    return df.withColumns(new | {c: round_even(c, coord_places) for c in COORDINATES if c in df.columns})


def published_units(df: DataFrame) -> DataFrame:
    p = F.col("parameter")
    big = p.isin(*THOUSANDFOLD) | ((p == "H2O") & (F.col("instrument") == "Licor_7200_CO2"))
    value = F.when(big, F.col("value") * 1000).when(p == THOUSANDTH, F.col("value") / 1000).otherwise(F.col("value"))
    return df.withColumn("value", value)


#: Degrees of the cells that rings are dealt to, by size: the finest that a ring's box meets in at most ``ACROSS`` cells each way, else the last.
CELLS, ACROSS = (1 / 256, 1 / 8), 64
#: Degrees by which the cells' borders lie off round numbers, where vertices are.
ASIDE = 0.000123456789


def _ring_index(rings: DataFrame, size: float) -> DataFrame:
    """Cells (``i``, ``j``) that rings touch: the edges that pass each, and whether its south-eastern corner lies inside.

    A cell without edges is there only where it lies inside as a whole.
    """
    aside = lambda p: F.struct((F.col(f"{p}.lat") - ASIDE).alias("lat"), (F.col(f"{p}.lon") - ASIDE).alias("lon")).alias(p)
    edges = noding.edges_of(rings.withColumnRenamed("ring", "coords"), ["id"]).filter("a <> b").select("id", F.struct("a", "b").alias("e"), aside("a"), aside("b"))
    passed = noding.through(edges, size, 1e-9).groupBy("id", "i", "j").agg(F.collect_list("e").alias("edges"))
    low, high = F.least("a.lat", "b.lat"), F.greatest("a.lat", "b.lat")
    level = noding.border(F.col("i"), size)
    met = edges.withColumn("i", F.explode(F.filter(F.sequence(noding.index(low, size), noding.index(high, size)), lambda i: (noding.border(i, size) >= low) & (noding.border(i, size) < high))))
    met = met.withColumn("x", F.col("a.lon") + (level - F.col("a.lat")) * (F.col("b.lon") - F.col("a.lon")) / (F.col("b.lat") - F.col("a.lat")))
    met = met.groupBy("id", "i").agg(F.collect_list("x").alias("xs"))
    span = lambda c: F.explode(F.sequence(*(noding.index(f(F.col(f"ring.{c}")) - ASIDE, size) for f in (F.array_min, F.array_max))))
    cells = rings.withColumn("i", span("lat")).join(met, ["id", "i"], "left").withColumn("j", span("lon"))
    east = noding.border(F.col("j") + 1, size)
    odd = F.coalesce(F.size(F.filter("xs", lambda x: x > east)), F.lit(0)) % 2 == 1
    return cells.select("id", "i", "j", odd.alias("corner")).join(passed, ["id", "i", "j"], "left").filter("corner or edges is not null")


def _inside_cell(lat: Column, lon: Column, size: float) -> Column:
    """Whether a point of the cell is inside: edges are counted up the cell's eastern border and then west to the point.

    As for whole rings, a point at a vertex's or level edge's latitude counts as just above it.
    """
    south, east = noding.border(F.col("i"), size) + ASIDE, noding.border(F.col("j") + 1, size) + ASIDE

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        y = a["lat"] + F.try_divide((east - a["lon"]) * (b["lat"] - a["lat"]), b["lon"] - a["lon"])
        x = a["lon"] + F.try_divide((lat - a["lat"]) * (b["lon"] - a["lon"]), b["lat"] - a["lat"])
        up = ((a["lon"] > east) != (b["lon"] > east)) & F.coalesce((y > south) & (y <= lat), F.lit(False))
        west = ((a["lat"] > lat) != (b["lat"] > lat)) & F.coalesce((x > lon) & (x <= east), F.lit(False))
        return up != west

    passed = F.coalesce(F.size(F.filter("edges", crosses)), F.lit(0)) % 2 == 1
    return F.col("corner") != passed


def outside(df: DataFrame, rings: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows inside none of the rings, and rows without a position.

    ``rings`` has one array of (lat, lon) a row; open ones are closed.  Each ring
    is dealt to a grid as fine as its own size asks for, whatever other rings
    are there.  A cell holds only the edges that pass it and on which side its
    corner lies, so what a row costs depends on the edges in its cell, not in
    the ring, and cells wholly inside hold none.  Nothing runs while this is
    planned.
    """
    closed = F.when(F.get("ring", 0) == F.element_at("ring", -1), F.col("ring")).otherwise(F.concat("ring", F.slice("ring", 1, 1)))
    whole = rings.select("ring").filter((F.size("ring") > 2) & F.forall("ring", lambda p: p["lat"].isNotNull() & p["lon"].isNotNull()))
    told = whole.select(F.xxhash64("ring").alias("id"), closed.alias("ring")).distinct()
    extent = F.greatest(*(F.array_max(F.col(f"ring.{c}")) - F.array_min(F.col(f"ring.{c}")) for c in ("lat", "lon")))
    least = F.when(extent <= CELLS[0] * ACROSS, 0).otherwise(1)
    y, x = F.col(lat), F.col(lon)
    for k, size in enumerate(CELLS):
        index = _ring_index(told.filter(least == k), size)
        df = df.join(index, (noding.index(y - ASIDE, size) == index["i"]) & (noding.index(x - ASIDE, size) == index["j"]) & _inside_cell(y, x, size), "left_anti")
    return df


def exchange_rows(readings: DataFrame, fields: DataFrame, vehicle: str, rings: DataFrame | None = None, cell_id=None, by: tuple[str, ...] = ()) -> DataFrame:
    """Calibrated readings in the exchange format: one row for each reading that the field table names.

    ``fields``: parameter_ucb, parameter, method, duration, unit, instrument.
    ``by`` are columns of the readings that come along.
    ``cell_id`` makes a cell identifier from two columns; without it that is null.
    """
    rows = published_units(readings).select(
        *by, F.col("sample_time").alias("timestamp"), F.col("parameter").alias("parameter_ucb"), "instrument", "value",
        F.col("lat_smooth").alias("latitude"), F.col("lon_smooth").alias("longitude"),
        (F.col("summary_flag") != "0").cast("int").alias("status_indicator"), F.col("summary_flag").alias("qualifier_codes"), F.lit(vehicle).alias("vehicle_id"),
    )
    joined = rows.join(fields, ["parameter_ucb", "instrument"])
    h3 = cell_id(F.col("latitude"), F.col("longitude")) if cell_id else F.lit(None)
    joined = joined.withColumn("h3_index", h3.cast("string"))
    joined = outside(joined, rings) if rings is not None else joined
    return joined.select(*by, "timestamp", "parameter", "method", "duration", "value", "unit", "latitude", "longitude", "h3_index", "status_indicator", "qualifier_codes", "vehicle_id")


def raw_rows(readings: DataFrame, fields: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Readings before calibration in the exchange format; fields are found by parameter and instrument."""
    rows = readings.select(
        *by, F.col("sample_time").alias("timestamp"), F.col("parameter").alias("parameter_ucb"), "instrument", "value", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        (F.col("summary_flag") != "0").cast("int").alias("status_indicator"), F.col("summary_flag").alias("qualifier_code"),
    )
    joined = rows.join(fields, ["parameter_ucb", "instrument"])
    return joined.select(*by, "timestamp", "parameter", "method", "duration", "value", "unit", "latitude", "longitude", "status_indicator", "qualifier_code")


def mean_by_point(df: DataFrame, value: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The mean value at each position."""
    good = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(value).isNotNull())
    return good.groupBy(lat, lon).agg(F.avg(value).alias(value), F.count("*").alias("n"))


def mean_by_line(df: DataFrame, value: str, line: str = "geometry") -> DataFrame:
    """The mean value on each line (well-known binary or text)."""
    good = df.filter(F.col(line).isNotNull() & (F.length(line) > 0) & F.col(value).isNotNull())
    return good.groupBy(line).agg(F.avg(value).alias(value), F.count("*").alias("n"))


def mean_by_cell(df: DataFrame, value: str, size: float, lat: str = "lat", lon: str = "lon", cell_id=None) -> DataFrame:
    """The mean value in each cell: of a hexagonal grid by ``cell_id``, else of a square grid."""
    good = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(value).isNotNull())
    if cell_id:
        return good.groupBy(cell_id(F.col(lat), F.col(lon)).alias("cell")).agg(F.avg(value).alias(value), F.count("*").alias("n"))
    keys = (cell(F.col(lat), size).alias("cell_lat"), cell(F.col(lon), size).alias("cell_lon"))
    return good.groupBy(*keys).agg(F.avg(value).alias(value), F.count("*").alias("n"))
