"""Ensemble statistics over members of one point: a window, not a join back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.catalog import ANOMALY_LIMIT
from gridloom.functions import clip


def mean_and_anomaly(speeds: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """speeds with mean and anom: single-precision mean over the members of keys, and what differs from it, cut at 25.

    A point where a member is missing has neither.
    """
    point = Window.partitionBy(*keys)
    mean = F.when(F.count(value).over(point) == F.count(F.lit(1)).over(point), F.avg(F.col(value).cast("double")).over(point)).cast("float")
    return speeds.withColumn("mean", mean).withColumn("anom", clip((F.col(value).cast("float") - F.col("mean")).cast("double"), -ANOMALY_LIMIT, ANOMALY_LIMIT).cast("float"))


def ensemble_mean(speeds: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, mean, members, complete; map-side combining, where only the mean is wanted."""
    complete = F.count(value) == F.count(F.lit(1))
    return speeds.groupBy(*keys).agg(F.when(complete, F.avg(F.col(value).cast("double"))).cast("float").alias("mean"), F.count(F.lit(1)).alias("members"), complete.alias("complete"))


def reconstruct(statistics: DataFrame) -> DataFrame:
    """Members' speeds again, from mean and anom; exact to the precision where nothing was cut off."""
    return statistics.withColumn("speed", F.col("mean") + F.col("anom"))
