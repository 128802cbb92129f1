"""Providers that are reached through their own clients: an ocean model's toolbox and an open-data service.

Both clients are optional packages, loaded only where they are used; every function takes what it
calls as an argument, so the rules here are tested without them.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridloom import catalog
from gridloom.sources import grib, providers
from gridloom.sources.providers import CycleNotAvailable

#: Fixed value: the dataset with six-hourly surface currents; its name may be set, as the provider renames it from time to time.
CURRENTS_DATASET = os.environ.get("CMEMS_DATASET_ID", "cmems_mod_glo_phy-cur_anfc_0.083deg_PT6H-i")
GRID = "time timestamp, depth_idx int, i int, j int, lat double, lon double, uo float, vo float"


def open_currents():
    """The ocean model's dataset: time, depth, latitude, longitude; uo and vo."""
    import copernicusmarine

    return copernicusmarine.open_dataset(dataset_id=CURRENTS_DATASET, variables=["uo", "vo"])


def is_auth_failure(e: Exception) -> bool:
    return "auth" in f"{type(e).__name__} {e}".lower()


def _instants(batches: Iterator[pa.RecordBatch], opened: Callable, sleep: Callable[[float], None]) -> Iterator[pa.RecordBatch]:
    data = None
    for batch in batches:
        for unix in batch.column("unix").to_pylist():
            data = data if data is not None else providers.with_auth_retries(opened, is_auth_failure, sleep)
            at = np.datetime64(int(unix), "s").astype("datetime64[ns]")
            if at not in data["time"].values:
                continue  # surface_currents() reports what lacks
            level = data.sel(time=at).isel(depth=0)
            lat, lon = (np.asarray(level[n].values, np.float64) for n in ("latitude", "longitude"))
            j, i = np.meshgrid(np.arange(len(lon), dtype=np.int32), np.arange(len(lat), dtype=np.int32))
            columns = [pa.array([int(unix) * 1_000_000] * i.size, pa.timestamp("us", "UTC")), pa.array(np.zeros(i.size, np.int32)), pa.array(i.ravel()), pa.array(j.ravel()), pa.array(lat[i.ravel()]), pa.array(lon[j.ravel()])]
            columns += [pa.array(np.asarray(level[n].values, np.float32).ravel()) for n in ("uo", "vo")]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in GRID.split(", ")])


def currents_grid(spark: SparkSession, cycle: datetime, opened: Callable = open_currents, sleep: Callable[[float], None] | None = None) -> DataFrame:
    """The surface fields of the cycle's instants, one instant at a time in each task."""
    import time

    rows = [(int(cycle.timestamp()) + s * 3600,) for s in catalog.axes("currents")["steps"]]
    wanted = spark.createDataFrame(rows, "unix long").repartition(len(rows), "unix")
    return wanted.mapInArrow(partial(_instants, opened=opened, sleep=sleep or time.sleep), GRID)


def open_data_client():
    from ecmwf.opendata import Client

    return Client(source="ecmwf", model="ifs", resol="0p25")


def latest_open_data(client) -> datetime:
    """The newest cycle with the last step; any failure means that there is none."""
    try:
        found = client.latest(type="fc", param="10u", step=catalog.axes("weather-ecmwf")["steps"][-1])
    except Exception as e:
        raise CycleNotAvailable(f"no cycle with the full horizon: {e}") from e
    return found if found.tzinfo else found.replace(tzinfo=UTC)


def named_message(data: bytes) -> tuple[str, str, dict, np.ndarray]:
    """shortName, stepRange, grid keys and values of a message; needs the optional decoder."""
    import eccodes

    handle = eccodes.codes_new_from_message(data)
    try:
        return eccodes.codes_get(handle, "shortName"), str(eccodes.codes_get(handle, "stepRange")), {k: eccodes.codes_get(handle, k) for k in grib.KEYS}, eccodes.codes_get_values(handle)
    finally:
        eccodes.codes_release(handle)


FIELDS = "short_name string, step_range string, i int, j int, lat double, lon double, value float"


def _named(batches: Iterator[pa.RecordBatch], message: Callable) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("message").to_pylist():
            name, span, keys, values = message(data)
            field, lat, lon = grib.normalised(keys, values)
            j, i = np.meshgrid(np.arange(len(lon), dtype=np.int32), np.arange(len(lat), dtype=np.int32))
            flat = field.ravel()
            columns = [pa.array([name] * flat.size), pa.array([span] * flat.size), pa.array(i.ravel()), pa.array(j.ravel()), pa.array(lat[i.ravel()]), pa.array(lon[j.ravel()]), pa.array(flat, mask=np.isnan(flat))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FIELDS.split(", ")])


def open_data_fields(spark: SparkSession, cycle: datetime, client, message: Callable = named_message) -> DataFrame:
    """Wind, and gusts under the first name that has them, at the steps of the axis; one retrieval for each."""
    steps = catalog.axes("weather-ecmwf")["steps"]

    def retrieved(params: list[str], at: list[int]) -> bytes:
        with tempfile.TemporaryDirectory() as folder:
            target = Path(folder, "fields.grib2")
            client.retrieve(date=f"{cycle:%Y-%m-%d}", time=cycle.hour, type="fc", step=at, param=params, target=str(target))
            return target.read_bytes()

    def can(param: str) -> bool:
        try:
            return bool(retrieved([param], [3]))
        except Exception:
            return False

    messages = list(grib.split_messages(retrieved(["10u", "10v"], steps)))
    if gust := providers.probe_gust_param(can):
        messages += grib.split_messages(retrieved([gust], steps[1:]))
    rows = spark.createDataFrame([(bytearray(m),) for m in messages], "message binary")
    return rows.repartition(max(1, min(len(messages), 64))).mapInArrow(partial(_named, message=message), FIELDS)
