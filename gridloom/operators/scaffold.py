"""Dense scaffolds, first matches and gates on what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_match(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key: a minimum with map-side combining instead of a window."""
    names = rows.columns
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*names), order).alias("row")).select("row.*")


def scaffold(steps: DataFrame, others: DataFrame) -> DataFrame:
    """Every step with every row of another dimension table; both are catalogue-sized."""
    return steps.crossJoin(F.broadcast(others))


def filled(dense: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The scaffold with what was found; missing values stay null."""
    return dense.join(found, keys, "left")


def missing(dense: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return dense.join(found.select(*keys).distinct(), keys, "left_anti")


def require_nothing(rows: DataFrame, what: str) -> None:
    """Raises with the first five rows, if there are any."""
    if some := rows.limit(5).collect():
        raise LookupError(f"{what}: {[tuple(r) for r in some]}")


def next_start(rows: DataFrame, keys: list[str], order: str, start: str = "start") -> DataFrame:
    """rows with end: the start of the next in the order, null for the last."""
    return rows.withColumn("end", F.lead(start).over(Window.partitionBy(*keys).orderBy(order)))


def rolled(columns: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of a grid renumbered so that the least longitude is the first."""
    return columns.withColumn("j_rolled", F.row_number().over(Window.partitionBy(*keys).orderBy("lon")) - 1)


def flipped(rows: DataFrame, nlat: int, lat_last: float, dlat: float) -> DataFrame:
    """Rows of a grid that is stored from the north: i counted from the south, coordinates from the last latitude."""
    up = F.lit(nlat - 1) - F.col("i")
    return rows.withColumn("i_up", up).withColumn("lat_up", F.lit(lat_last) - F.lit(dlat) * F.lit(nlat - 1) + F.col("i_up") * F.lit(dlat))
