"""Sizes of tiles, and runs extrapolated from sampled steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: bytes of one generation of all layers up to which the verdict is GO.
GO_BYTES = 4_000_000_000


def compression(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, gz_bytes, raw_bytes, ratio."""
    return tiles.groupBy(*keys).agg(F.sum("gz_bytes").alias("gz_bytes"), F.sum("raw_bytes").alias("raw_bytes")).withColumn("ratio", F.col("gz_bytes") / F.col("raw_bytes"))


def extrapolated(samples: DataFrame, keys: list[str]) -> DataFrame:
    """keys, full_bytes: each stretch's bytes for a sampled step times the steps that it has in full."""
    return samples.groupBy(*keys).agg(F.sum(F.col("gz_bytes") / F.col("sampled_steps") * F.col("full_steps")).alias("full_bytes"))


def verdict(layers: DataFrame, limit: int = GO_BYTES) -> DataFrame:
    """total_bytes, failed, verdict: GO if no layer failed and the total is within the limit."""
    both = layers.agg(F.sum("full_bytes").alias("total_bytes"), F.count_if("failed").alias("failed"))
    return both.withColumn("verdict", F.when((F.col("failed") == 0) & (F.col("total_bytes") <= limit), "GO").otherwise("NO-GO"))
