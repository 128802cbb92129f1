import hashlib

import pytest
from pyspark.sql import functions as F

from gridloom import catalog
from gridloom import functions as G
from gridloom.operators import publishing


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("value", "dtype", "scale", "raw"), [(2.5, "i16", 1.0, 2), (3.5, "i16", 1.0, 4), (1e9, "i16", 0.01, 32767), (-1e9, "i16", 0.01, -32767), (None, "i16", 0.01, -32768), (float("nan"), "i8", 0.2, -128), (-1e3, "i8", 0.2, -127)])
def test_quantize_rounds_to_even_clamps_and_marks_missing(spark, value, dtype, scale, raw):
    assert one(spark, G.quantize(F.lit(value).cast("double"), dtype, scale)) == raw


def test_dequantize_is_within_half_a_step(spark):
    x = F.lit(12.3456)
    assert abs(one(spark, G.dequantize(G.quantize(x, "i16", 0.01), "i16", 0.01)) - 12.3456) <= 0.005001
    assert one(spark, G.dequantize(F.lit(-128).cast("tinyint"), "i8", 0.2)) is None


def test_clip_keeps_null(spark):
    assert one(spark, G.clip(F.lit(None).cast("double"), -25.0, 25.0)) is None
    assert one(spark, G.clip(F.lit(30.0), -25.0, 25.0)) == 25.0


def test_units_are_in_single_precision(spark):
    import numpy as np

    assert np.float32(one(spark, G.transform_units(F.lit(10.0), to_kt=True))) == np.float32(10) * np.float32(1.943844)
    assert np.float32(one(spark, G.transform_units(F.lit(300.0), k_to_c=True))) == np.float32(300) - np.float32(273.15)


@pytest.mark.parametrize(("lat", "lon", "name"), [(45.2, -7.5, "N40W010"), (-0.1, 0.0, "S10E000"), (-90.0, 179.9, "S90E170"), (5.0, 185.0, "N00W180")])
def test_tile_names(spark, lat, lon, name):
    assert one(spark, G.tile_id(G.tile_origin_lat(F.lit(lat)), G.tile_origin_lon(F.lit(lon)))) == name


@pytest.mark.parametrize(("degrees", "name"), [(0.25, "z025"), (0.5, "z050"), (1 / 12, "z008"), (2.5, "z250")])
def test_z_res(spark, degrees, name):
    assert one(spark, G.z_res(F.lit(degrees))) == name == publishing.z_name(degrees)


@pytest.mark.parametrize(("data", "digits"), [(b"", "cbf29ce484222325"), (b"a", "af63dc4c8601ec8c"), (b"foobar", "85944171f73967e8")])
def test_fnv64(spark, data, digits):
    assert one(spark, G.fnv64(F.lit(data))) == digits == publishing.fnv64(data)


def test_times(spark):
    cycle = F.lit("2026-07-13 06:00:00").cast("timestamp")
    assert one(spark, G.cycle_compact(cycle)) == "20260713T06Z"
    assert one(spark, G.cycle_iso(cycle)) == "2026-07-13T06:00Z"
    assert one(spark, G.run_id(F.lit("weather"), G.parse_cycle(F.lit("20260713T06")))) == "weather-20260713T06Z"
    assert one(spark, G.cycle_compact(G.floor_to_cycle(F.lit("2026-07-13 11:59:59").cast("timestamp")))) == "20260713T06Z"
    assert len(one(spark, G.forecast_times(cycle, F.array(F.lit(0), F.lit(3))))) == 2


def test_little_endian_payload_and_padding(spark):
    raws = F.array(*[F.lit(x).cast("smallint") for x in (1, -2, -32768)])
    assert bytes(one(spark, G.le_payload(raws, 2))) == (1).to_bytes(2, "little") + (-2).to_bytes(2, "little", signed=True) + (-32768).to_bytes(2, "little", signed=True)
    assert one(spark, G.padded_length(F.lit(6))) == 8
    assert bytes(one(spark, G.pad_to_four(F.lit(b"abcde")))) == b"abcde\0\0\0"


def test_axes_have_their_lengths():
    assert {k: {n: len(h) for n, h in catalog.axes(k).items()} for k in catalog.LAYERS} == {"weather": {"hourly": 161, "h3": 81}, "ensemble": {"steps": 89}, "waves": {"steps": 129}, "currents": {"steps": 41}, "weather-ecmwf": {"steps": 65}}
    with pytest.raises(ValueError, match="overlaps"):
        catalog.axis_offsets((0, 10, 1), (10, 20, 2))
    assert [v.name for v in catalog.variables_for_step("weather", 1)] == ["wind_u_kt", "wind_v_kt", "gust_kt"]
    assert catalog.VARIABLES["ensemble"][1].public() == {"name": "wind_kt_anom", "axis": "steps", "dtype": "i8", "scale": 0.2, "per_member": True}


def test_hash_is_not_a_signed_number(spark):
    data = hashlib.sha256(b"x").digest()
    assert one(spark, G.fnv64(F.lit(data))) == publishing.fnv64(data)
