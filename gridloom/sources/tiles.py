"""Published tiles as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.codec import read_tiles


def published_cells(spark: SparkSession, root: str, run_id: str | None = None, layer: str = "*") -> DataFrame:
    """Cells of the tiles under a store's folder; a run and a layer prune the files that are read."""
    files = spark.read.format("binaryFile").load(f"{root}/forecast-runs/{run_id or '*'}/{layer}/*/*.bin.gz")
    return read_tiles(files)


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """run_id, layer, cycle, tile_count, bytes of the runs that are complete."""
    rows = spark.read.option("multiLine", True).schema("run_id string, layer string, cycle string, totals struct<tile_count: long, bytes: long>").json(f"{root}/forecast-runs/*/manifest.json")
    return rows.select("run_id", "layer", "cycle", F.col("totals.tile_count").alias("tile_count"), F.col("totals.bytes").alias("bytes"))


def register_views(spark: SparkSession, root: str) -> None:
    """Views published_cells and published_runs for SQL."""
    published_cells(spark, root).createOrReplaceTempView("published_cells")
    manifests(spark, root).createOrReplaceTempView("published_runs")
