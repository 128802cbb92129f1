"""Messages of gridded files to cells, ascending in latitude and from -180 in longitude.

The decoder of a message's keys and values is an argument; the default one needs the optional
``eccodes`` package and is only loaded where messages are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.functions.quant import GRIB_MISSING_FROM

KEYS = ("Ni", "Nj", "latitudeOfFirstGridPointInDegrees", "latitudeOfLastGridPointInDegrees", "longitudeOfFirstGridPointInDegrees", "iDirectionIncrementInDegrees", "jDirectionIncrementInDegrees", "jScansPositively")
CELLS = "var string, level string, step_h int, member int, i int, j int, lat double, lon double, value float"


def eccodes_message(data: bytes) -> tuple[dict, np.ndarray]:
    import eccodes

    handle = eccodes.codes_new_from_message(data)
    try:
        return {k: eccodes.codes_get(handle, k) for k in KEYS}, eccodes.codes_get_values(handle)
    finally:
        eccodes.codes_release(handle)


def normalised(keys: dict, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values as [lat, lon] with NaN where missing, latitudes from the south, longitudes in [-180, 180) from the least."""
    ni, nj = int(keys["Ni"]), int(keys["Nj"])
    field = np.asarray(values, np.float32).reshape(nj, ni)
    field = np.where(field >= GRIB_MISSING_FROM, np.float32("nan"), field)
    dlat, dlon = float(keys["jDirectionIncrementInDegrees"]), float(keys["iDirectionIncrementInDegrees"])
    south = float(keys["latitudeOfFirstGridPointInDegrees"])
    if not keys["jScansPositively"]:
        field, south = field[::-1], south - dlat * (nj - 1)
    lon = (float(keys["longitudeOfFirstGridPointInDegrees"]) + dlon * np.arange(ni) + 180.0) % 360.0 - 180.0
    west = int(lon.argmin())
    return np.roll(field, -west, axis=1), south + dlat * np.arange(nj), lon[west] + dlon * np.arange(ni)


def _batches(batches: Iterator[pa.RecordBatch], message: Callable) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            field, lat, lon = normalised(*message(row["message"]))
            j, i = np.meshgrid(np.arange(len(lon), dtype=np.int32), np.arange(len(lat), dtype=np.int32))
            flat, n = field.ravel(), field.size
            same = lambda x, t, n=n: pa.array([x] * n, t)
            yield pa.RecordBatch.from_arrays(
                [same(row["var"], pa.string()), same(row["level"], pa.string()), same(row["step_h"], pa.int32()), same(row["member"], pa.int32()), pa.array(i.ravel()), pa.array(j.ravel()),
                 pa.array(lat[i.ravel()]), pa.array(lon[j.ravel()]), pa.array(flat, mask=np.isnan(flat))],
                [c.split()[0] for c in CELLS.split(", ")],
            )


def decode_messages(messages: DataFrame, message: Callable = eccodes_message) -> DataFrame:
    """messages (var, level, step_h, member, message) to cells; missing values are null."""
    return messages.select("var", "level", "step_h", "member", "message").mapInArrow(partial(_batches, message=message), CELLS)


def split_messages(data: bytes) -> Iterator[bytes]:
    """The messages of one file, by the length that each has in its head."""
    at = data.find(b"GRIB")
    while at >= 0:
        size = int.from_bytes(data[at + 8 : at + 16], "big")
        yield data[at : at + size]
        at = data.find(b"GRIB", at + size)
