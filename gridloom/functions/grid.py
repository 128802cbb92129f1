"""Latitudes, longitudes and 10-degree tiles named by their south-west corner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TILE_DEG = 10


def longitude(lon: Column) -> Column:
    """Any longitude to [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def tile_origin_lat(lat: Column) -> Column:
    return (F.floor(lat / TILE_DEG) * TILE_DEG).cast("int")


def tile_origin_lon(lon: Column) -> Column:
    """Only what is 180 or more is wrapped, and once."""
    return (F.floor(F.when(lon >= 180.0, lon - 360.0).otherwise(lon) / TILE_DEG) * TILE_DEG).cast("int")


def tile_id(lat0: Column, lon0: Column) -> Column:
    """N40W010 for 40, -10."""
    lat0, lon0 = lat0.cast("int"), lon0.cast("int")
    return F.format_string("%s%02d%s%03d", F.when(lat0 >= 0, "N").otherwise("S"), F.abs(lat0), F.when(lon0 >= 0, "E").otherwise("W"), F.abs(lon0))


def z_res(degrees: Column) -> Column:
    """z025 for 0.25: hundredths of a degree, half to even."""
    return F.format_string("z%03d", F.rint(degrees * 100).cast("int"))
