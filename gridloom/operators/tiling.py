"""10-degree tiles: cells to tiles by a derived key, never by a range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import tile_id, tile_origin_lat, tile_origin_lon

TILE_DEG = 10


def grid_points(spark: SparkSession, lat0: float, lon0: float, dlat: float, dlon: float, nlat: int, nlon: int) -> DataFrame:
    """i, j, lat, lon of a regular grid; coordinates are computed in double precision, without rounding."""
    rows = spark.range(nlat).select(F.col("id").cast("int").alias("i"))
    return rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(nlon - 1)))).select("i", "j", (F.lit(lat0) + F.col("i") * F.lit(dlat)).alias("lat"), (F.lit(lon0) + F.col("j") * F.lit(dlon)).alias("lon"))


def tiles_between(spark: SparkSession, lat_min: float = -90.0, lat_max: float = 90.0, lon_min: float = -180.0, lon_max: float = 180.0) -> DataFrame:
    """lat0, lon0, tile_id of the tiles that a box touches; the pole itself belongs to none."""
    first = lambda x, low: int(max(x, low) // TILE_DEG) * TILE_DEG
    lats = F.sequence(F.lit(first(lat_min, -90.0)), F.lit(first(min(lat_max, 89.999), -90.0)), F.lit(TILE_DEG))
    lons = F.sequence(F.lit(first(lon_min, -180.0)), F.lit(first(min(lon_max, 179.999), -180.0)), F.lit(TILE_DEG))
    corners = spark.range(1).select(F.explode(lats).alias("lat0")).withColumn("lon0", F.explode(lons))
    return corners.withColumn("tile_id", tile_id(F.col("lat0"), F.col("lon0")))


def with_tile(cells: DataFrame) -> DataFrame:
    """cells with tile_lat0, tile_lon0, tile_id; cells at the pole fall out."""
    placed = cells.where("lat < 90").withColumns({"tile_lat0": tile_origin_lat(F.col("lat")), "tile_lon0": tile_origin_lon(F.col("lon"))})
    return placed.withColumn("tile_id", tile_id(F.col("tile_lat0"), F.col("tile_lon0")))


def tile_extents(cells: DataFrame) -> DataFrame:
    """One row for each tile: its first cell's coordinates (not its corner's), rows and columns, and whether any variable has data; NaN is none.

    A tile has few distinct coordinates, so sets of them combine on the map side; distinct counts
    would copy every cell three times.
    """
    some = F.col("value").isNotNull() & ~F.isnan("value")
    distinct = lambda c: F.size(F.collect_set(c)).cast("long")
    return with_tile(cells).groupBy("tile_id").agg(
        F.min("lat").alias("lat0"), F.min("lon").alias("lon0"), distinct("lat").alias("nlat"), distinct("lon").alias("nlon"),
        F.bool_or(some).alias("has_data"),
    )
