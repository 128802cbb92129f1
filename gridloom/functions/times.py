"""Cycles, runs and forecast hours. The session's time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cycle_compact(cycle: Column) -> Column:
    return F.date_format(cycle, "yyyyMMdd'T'HH'Z'")


def cycle_iso(cycle: Column) -> Column:
    return F.date_format(cycle, "yyyy-MM-dd'T'HH:mm'Z'")


def parse_cycle(text: Column) -> Column:
    return F.to_timestamp(text, "yyyyMMdd'T'HH")


def floor_to_cycle(at: Column, cadence_h: int = 6) -> Column:
    step = cadence_h * 3600
    return F.timestamp_seconds(F.floor(F.unix_timestamp(at) / step) * step)


def run_id(layer: Column, cycle: Column) -> Column:
    return F.concat_ws("-", layer, cycle_compact(cycle))


def forecast_times(base: Column, offsets_h: Column) -> Column:
    return F.transform(offsets_h, lambda h: F.timestamp_seconds(F.unix_timestamp(base) + h * 3600))
