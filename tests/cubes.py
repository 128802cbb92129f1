"""Small runs for the tests: smooth waves over two neighbouring tiles, of the catalogue's own variables.

Values are closed formulas of (member, step, row, column), so a test can say what a cell holds. The
westernmost cell of the northern row has no wind and no gust at the last step.
"""

from datetime import UTC, datetime

import numpy as np

from gridloom import catalog

CYCLE = datetime(2025, 3, 9, 18, tzinfo=UTC)
RUN_ID, CYCLE_ISO = "weather-20250309T18Z", "2025-03-09T18:00Z"
#: Four rows from -8 to -2 and ten columns from 20 to 38: five columns for each of two tiles.
LAT0, LON0, STEP, ROWS, COLS, HALF = -8.0, 20.0, 2.0, 4, 10, 5
WEST, EAST = "S10E020", "S10E030"
MEMBERS = 6


def _taken(layer, *names):
    return [v for v in catalog.VARIABLES[layer] if v.name in names]


WEATHER = _taken("weather", "wind_u_kt", "wind_v_kt", "gust_kt", "visibility_m")
WEATHER_AXES = {"hourly": [0, 1, 2, 4], "h3": [0, 3, 6]}
ENSEMBLE = _taken("ensemble", "wind_kt_mean", "wind_kt_anom")
ENSEMBLE_AXES = {"steps": [0, 12]}
CELL_SCHEMA = "variable string, member int, step_h int, i int, j int, lat double, lon double, value float"
CELLS_OF_WEATHER = ROWS * COLS * (3 * 4 + 3)


def waves(shape, base, height, *turns):
    """base and a sine of the place, turns radians for each step along each dimension."""
    phase = sum(turn * places for turn, places in zip(turns, np.indices(shape), strict=True))
    return (base + height * np.sin(phase)).astype(np.float32)


def weather_arrays(empty_east=False):
    hourly, sparse = (4, ROWS, COLS), (3, ROWS, COLS)
    east, north = waves(hourly, 3, 14, 0.9, 0.4, 0.7), waves(hourly, -2, 11, 0.5, 1.1, 0.3)
    out = {"wind_u_kt": east, "wind_v_kt": north, "gust_kt": np.hypot(east, north) * np.float32(1.3) + 1, "visibility_m": waves(sparse, 20_000, 15_000, 0.2, 0.8, 0.6)}
    for name in ("wind_u_kt", "wind_v_kt", "gust_kt"):
        out[name][-1, -1, 0] = np.nan
    if empty_east:
        out = {name: np.where(np.arange(COLS) < HALF, x, np.float32("nan")) for name, x in out.items()}
    return out


def west_arrays():
    return {name: x[..., :HALF] for name, x in weather_arrays().items()}


def ensemble_arrays():
    return {"wind_kt_mean": waves((2, ROWS, HALF), 18, 9, 1.2, 0.5, 0.8), "wind_kt_anom": waves((MEMBERS, 2, ROWS, HALF), 0.3, 7, 1.7, 0.6, 0.9, 0.4)}


def cells_of(spark, arrays, axes_of, axes):
    """Cells of arrays [member?, step, row, column] by variable; NaN is null."""

    def rows(name, values):
        hours = axes[axes_of[name]]
        for place, value in np.ndenumerate(values):
            *member, t, i, j = place
            yield name, member[0] if member else None, hours[t], i, j, LAT0 + i * STEP, LON0 + j * STEP, None if np.isnan(value) else float(value)

    return spark.createDataFrame([r for name, values in arrays.items() for r in rows(name, values)], CELL_SCHEMA)
