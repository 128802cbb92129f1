"""What the layers hold: axes, variables, ranges, members. Fixed values that results depend on stand together here."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Variable:
    """A variable as published (name to per_member) and as its provider has it (grib to optional)."""

    name: str
    axis: str
    dtype: str
    scale: float | int
    offset: float = 0.0
    per_member: bool = False
    grib: tuple[str, str] | None = None
    to_kt: bool = False
    k_to_c: bool = False
    optional: bool = False

    def public(self) -> dict:
        """As headers and manifests show it: offset and per_member only where they say something."""
        out = {"name": self.name, "axis": self.axis, "dtype": self.dtype, "scale": self.scale}
        out |= {"offset": self.offset} if self.offset else {}
        return out | ({"per_member": True} if self.per_member else {})


def axis_offsets(*segments: tuple[int, int, int]) -> list[int]:
    """Forecast hours of segments (first, last, step); each must begin after the one before ends."""
    out: list[int] = []
    for first, last, step in segments:
        if out and first <= out[-1]:
            raise ValueError(f"the segment from {first} overlaps what ends at {out[-1]}")
        out += range(first, last + 1, step)
    return out


#: Segments of the axes.
SEGMENTS: dict[str, dict[str, list[tuple[int, int, int]]]] = {
    "weather": {"hourly": [(0, 120, 1), (123, 240, 3)], "h3": [(0, 240, 3)]},
    "ensemble": {"steps": [(0, 144, 3), (150, 384, 6)]},
    "waves": {"steps": [(0, 384, 3)]},
    "currents": {"steps": [(0, 240, 6)]},
    "weather-ecmwf": {"steps": [(0, 144, 3), (150, 240, 6)]},
}
#: Model, grid step, members, share of missing cells allowed, hours between cycles.
LAYERS = {
    "weather": ("gfs_0p25", 0.25, 1, 0.05, 6),
    "ensemble": ("gefs_0p50", 0.5, 31, 0.05, 6),
    "waves": ("gfswave_0p25", 0.25, 1, 0.80, 6),
    "currents": ("cmems_glo12", 1 / 12, 1, 0.80, 24),
    "weather-ecmwf": ("ecmwf_ifs_0p25", 0.25, 1, 0.05, 12),
}
_TEN_M, _TWO_M, _SURFACE = "10 m above ground", "2 m above ground", "surface"
#: Variables of the layers.
VARIABLES: dict[str, list[Variable]] = {
    "weather": [
        Variable("wind_u_kt", "hourly", "i16", 0.01, grib=("UGRD", _TEN_M), to_kt=True),
        Variable("wind_v_kt", "hourly", "i16", 0.01, grib=("VGRD", _TEN_M), to_kt=True),
        Variable("gust_kt", "hourly", "i16", 0.1, grib=("GUST", _SURFACE), to_kt=True),
        Variable("visibility_m", "h3", "i16", 50, grib=("VIS", _SURFACE)),
        Variable("cape_jkg", "h3", "i16", 1, grib=("CAPE", _SURFACE)),
        Variable("temp_c", "h3", "i16", 0.1, grib=("TMP", _TWO_M), k_to_c=True),
        Variable("dew_point_c", "h3", "i16", 0.1, grib=("DPT", _TWO_M), k_to_c=True),
        Variable("precip_mm", "h3", "i16", 0.1, grib=("APCP", _SURFACE), optional=True),
    ],
    "ensemble": [
        Variable("wind_kt_mean", "steps", "i16", 0.01),
        Variable("wind_kt_anom", "steps", "i8", 0.2, per_member=True),
        Variable("gust_kt_mean", "steps", "i16", 0.01, optional=True),
        Variable("gust_kt_anom", "steps", "i8", 0.2, per_member=True, optional=True),
    ],
    "waves": [
        Variable("hs_m", "steps", "i16", 0.01, grib=("HTSGW", _SURFACE)),
        Variable("period_s", "steps", "i16", 0.1, grib=("PERPW", _SURFACE)),
        Variable("dir_deg", "steps", "i16", 0.1, grib=("DIRPW", _SURFACE)),
        Variable("wind_wave_h_m", "steps", "i16", 0.01, grib=("WVHGT", _SURFACE)),
        Variable("wind_wave_period_s", "steps", "i16", 0.1, grib=("WVPER", _SURFACE)),
        Variable("wind_wave_dir_deg", "steps", "i16", 0.1, grib=("WVDIR", _SURFACE)),
        Variable("swell_h_m", "steps", "i16", 0.01, grib=("SWELL", "1 in sequence")),
        Variable("swell_period_s", "steps", "i16", 0.1, grib=("SWPER", "1 in sequence")),
        Variable("swell_dir_deg", "steps", "i16", 0.1, grib=("SWDIR", "1 in sequence")),
    ],
    "currents": [Variable("cur_u_kt", "steps", "i16", 0.01, grib=("uo", "depth 0"), to_kt=True), Variable("cur_v_kt", "steps", "i16", 0.01, grib=("vo", "depth 0"), to_kt=True)],
    "weather-ecmwf": [
        Variable("wind_u_kt", "steps", "i16", 0.01, grib=("u", _TEN_M), to_kt=True),
        Variable("wind_v_kt", "steps", "i16", 0.01, grib=("v", _TEN_M), to_kt=True),
        Variable("gust_kt", "steps", "i16", 0.1, grib=("gust", _TEN_M), to_kt=True, optional=True),
    ],
}
#: Physical ranges; a variable without one has no bounds.
RANGES = {
    "wind_u_kt": (-150.0, 150.0),
    "wind_v_kt": (-150.0, 150.0),
    "gust_kt": (0.0, 200.0),
    "wind_kt_mean": (0.0, 200.0),
    "wind_kt_anom": (-25.0, 25.0),
    "gust_kt_mean": (0.0, 250.0),
    "gust_kt_anom": (-25.0, 25.0),
    "visibility_m": (0.0, 100_000.0),
    "cape_jkg": (0.0, 10_000.0),
    "temp_c": (-90.0, 60.0),
    "dew_point_c": (-90.0, 60.0),
    "precip_mm": (0.0, 1_000.0),
    "hs_m": (0.0, 30.0),
    "wind_wave_h_m": (0.0, 30.0),
    "swell_h_m": (0.0, 30.0),
    "period_s": (0.0, 40.0),
    "wind_wave_period_s": (0.0, 40.0),
    "swell_period_s": (0.0, 40.0),
    "dir_deg": (0.0, 360.0),
    "wind_wave_dir_deg": (0.0, 360.0),
    "swell_dir_deg": (0.0, 360.0),
    "cur_u_kt": (-15.0, 15.0),
    "cur_v_kt": (-15.0, 15.0),
}
#: Wind may exceed gust by so many knots, at no more than this share of points; anomalies are cut at this.
GUST_SLACK_KT, GUST_SHARE, ANOMALY_LIMIT = 2.0, 0.99, 25.0


def axes(layer: str) -> dict[str, list[int]]:
    return {name: axis_offsets(*parts) for name, parts in SEGMENTS[layer].items()}


def axes_table(spark: SparkSession) -> DataFrame:
    """layer, axis, offsets_h."""
    return spark.createDataFrame([(layer, name, hours) for layer in SEGMENTS for name, hours in axes(layer).items()], "layer string, axis string, offsets_h array<int>")


def variables_table(spark: SparkSession) -> DataFrame:
    """layer, variable, ord, axis, dtype, scale, offset, per_member, optional."""
    rows = [(layer, v.name, i, v.axis, v.dtype, float(v.scale), v.offset, v.per_member, v.optional) for layer, vs in VARIABLES.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "layer string, variable string, ord int, axis string, dtype string, scale double, offset double, per_member boolean, optional boolean")


def ranges_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in RANGES.items()], "variable string, low double, high double")


def variables_for_step(layer: str, step: int) -> list[Variable]:
    """Variables whose axis has the step, in the order of the catalogue."""
    hours = axes(layer)
    return [v for v in VARIABLES[layer] if step in hours[v.axis]]
