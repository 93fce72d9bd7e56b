"""Geometry column functions on degrees of latitude and longitude."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres: mean radius of the earth, and length of a degree in the planar approximation (fixed values).
EARTH, DEGREE = 6_371_000.0, 111_000.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in degrees, from 0 to 360."""
    d = F.radians(lon2 - lon1)
    x = F.sin(d) * F.cos(F.radians(lat2))
    y = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(x, y)) + 360.0, F.lit(360.0))


def distances(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """``haversine`` of arrays."""
    u, v = np.sin(np.radians(lat2 - lat1) / 2), np.sin(np.radians(lon2 - lon1) / 2)
    a = u * u + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * (v * v)
    return 2 * EARTH * np.arctan2(np.sqrt(a), np.sqrt(1 - a))


def bearings(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """``bearing`` of arrays."""
    a, b, d = np.radians(lat1), np.radians(lat2), np.radians(lon2 - lon1)
    c = np.cos(b)
    return np.fmod(np.degrees(np.arctan2(np.sin(d) * c, np.cos(a) * np.sin(b) - np.sin(a) * c * np.cos(d))) + 360.0, 360.0)


def line_bearing(coords: Column) -> Column:
    """Bearing from the first to the last vertex of an array of (lat, lon); 0 for fewer than two."""
    a, b = F.try_element_at(coords, F.lit(1)), F.try_element_at(coords, F.lit(-1))
    return F.when(F.size(coords) < 2, F.lit(0.0)).otherwise(bearing(a["lat"], a["lon"], b["lat"], b["lon"]))


def angle_between(a: Column, b: Column, oneway: Column) -> Column:
    """Smallest turn between two bearings; a two-way road may be met from either end."""
    turn = lambda x, y: F.least(F.pmod(x - y, F.lit(360.0)), F.pmod(y - x, F.lit(360.0)))
    return F.when(F.coalesce(oneway, F.lit(False)), turn(a, b)).otherwise(F.least(turn(a, b), turn(a, b + 180.0)))


def planar(lat: Column, lon: Column, ref_lat: Column | float) -> tuple[Column, Column]:
    """Metres east and north in the planar approximation about a reference latitude.

    A degree's length comes first, then the coordinate times it: distances that
    are nearly equal keep the order they have in SQL written that way.
    """
    c = math.cos(math.radians(ref_lat)) if isinstance(ref_lat, (int, float)) else F.cos(F.radians(ref_lat))
    return lon * (F.lit(DEGREE) * c), lat * F.lit(DEGREE)


def project(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column]:
    """The share of the way from a to b at which p comes nearest, within the segment, and the distance there."""
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    t = ((px - ax) * dx + (py - ay) * dy) / F.when(square == 0, F.lit(1.0)).otherwise(square)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return t, F.sqrt(F.pow(px - (ax + t * dx), 2) + F.pow(py - (ay + t * dy), 2))


def cell(v: Column, size: float) -> Column:
    """The lower edge of the grid cell that holds a coordinate, to the digits of the cell size."""
    digits = max(0, -math.floor(math.log10(size)))
    scale = float(10**digits)
    return F.rint(F.floor(v / F.lit(size)) * F.lit(size) * scale) / scale


#: Bits of each coordinate in a place's key: some two metres at the equator.
CURVE_BITS = 24
#: Steps that move the bits of a number to every second place (fixed values).
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def curve_key(lat: Column, lon: Column) -> Column:
    """A place's number on a Z-shaped curve, whose neighbours on the curve are near each other; null without a position."""
    top = (1 << CURVE_BITS) - 1

    def spread(share: Column) -> Column:
        x = F.greatest(F.lit(0), F.least(F.lit(top), F.floor(share * float(top + 1)))).cast("long")
        for shift, mask in SPREAD:
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
        return x

    both = F.shiftleft(spread((lat + 90.0) / 180.0), 1).bitwiseOR(spread((lon + 180.0) / 360.0))
    return F.when(lat.isNotNull() & lon.isNotNull(), both)


def ring(lat: Column, lon: Column, size: float) -> Column:
    """The five corners of a closed square cell from its lower edge."""
    point = lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))
    return F.array(point(lat, lon), point(lat, lon + size), point(lat + size, lon + size), point(lat + size, lon), point(lat, lon))


def in_ring(lat: Column, lon: Column, corners: Column) -> Column:
    """Whether a point lies inside a closed ring, an array of (lat, lon), by counting edges to its right."""
    edges = F.arrays_zip(F.slice(corners, F.lit(1), F.size(corners) - 1).alias("a"), F.slice(corners, F.lit(2), F.size(corners) - 1).alias("b"))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        at = a["lon"] + F.try_divide((lat - a["lat"]) * (b["lon"] - a["lon"]), b["lat"] - a["lat"])
        return ((a["lat"] > lat) != (b["lat"] > lat)) & F.coalesce(lon < at, F.lit(False))

    return F.size(F.filter(edges, crosses)) % 2 == 1
