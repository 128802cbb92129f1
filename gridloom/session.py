"""Session helpers shared by every part of the engine."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

REPO_ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "gridloom") -> SparkSession:
    """A UTC, ANSI, AQE session for tests, the command line and the bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GRIDLOOM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package even if the driver found it through sys.path."""
    env = spark.sparkContext.environment
    if REPO_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO_ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
