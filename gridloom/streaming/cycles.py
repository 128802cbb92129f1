"""Arrivals of a layer's files as a stream: a cycle is published once all its steps are there, never before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import floor_to_cycle


def complete_cycles(arrivals: DataFrame, steps: int) -> DataFrame:
    """cycle, step count of arrivals (cycle, step_h) where as many distinct steps have come as there are."""
    return arrivals.groupBy("cycle").agg(F.count_distinct("step_h").alias("steps")).where(F.col("steps") >= steps)


def by_cycle(events: DataFrame, at: str = "ts", late: str = "12 hours", cadence_h: int = 6) -> DataFrame:
    """Counts of events by six-hour cycle; on a stream, what comes later than allowed is left out."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.window(at, f"{cadence_h} hours").start.alias("cycle")).agg(F.count("*").alias("n"))


def publish_new(arrivals: DataFrame, known: Callable[[], DataFrame], publish: Callable[[DataFrame], None], checkpoint: str, steps: int, seen: str):
    """Runs over what has arrived and stops: appends each batch's arrivals to the table ``seen`` under its batch, then publishes cycles that are complete and not known.

    A batch that is run again overwrites its own part, and a cycle that is already known is not
    published again, so a repeated batch changes nothing.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        rows.select("cycle", "step_h").write.mode("overwrite").parquet(f"{seen}/batch={number}")
        have = spark.read.parquet(seen).select("cycle", "step_h").distinct()
        publish(complete_cycles(have, steps).join(known(), "cycle", "left_anti"))

    return arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


__all__ = ["by_cycle", "complete_cycles", "floor_to_cycle", "publish_new"]
