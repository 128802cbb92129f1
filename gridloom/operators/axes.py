"""Checks and set operations on forecast axes, as rows (axis, pos, offset_h) or arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exploded(axes: DataFrame, keys: tuple[str, ...] = ("axis",)) -> DataFrame:
    return axes.select(*keys, F.posexplode("offsets_h").alias("pos", "offset_h"))


def monotonic(rows: DataFrame, keys: tuple[str, ...] = ("axis",)) -> DataFrame:
    """keys, monotonic: whether each offset is over the one before; axes are driver-sized, so a window per axis is small."""
    before = F.lag("offset_h").over(Window.partitionBy(*keys).orderBy("pos"))
    rising = F.coalesce(F.col("offset_h") > before, F.lit(True))
    return rows.withColumn("rising", rising).groupBy(*keys).agg(F.bool_and("rising").alias("monotonic"), F.count("*").alias("steps"))


def complete(found: DataFrame, expected: DataFrame, keys: tuple[str, ...] = ("axis",)) -> DataFrame:
    """keys, complete: whether an expected axis is there with just its offsets, in order."""
    return expected.select(*keys, F.col("offsets_h").alias("wanted")).join(found.select(*keys, "offsets_h"), list(keys), "left").select(*keys, F.col("offsets_h").eqNullSafe(F.col("wanted")).alias("complete"))


def overlaps(segments: DataFrame) -> DataFrame:
    """Segments (axis, seg, first, last) that begin at or before where the one before ends."""
    before = F.lag("last").over(Window.partitionBy("axis").orderBy("seg"))
    return segments.withColumn("before", before).where(F.col("first") <= F.col("before"))


def union_of(axes: DataFrame) -> DataFrame:
    """All offsets of all axes once, in order."""
    return axes.select(F.explode("offsets_h").alias("offset_h")).distinct().orderBy("offset_h")
