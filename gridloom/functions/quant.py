"""Values to small integers and back; units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Knots per metre and second, zero Celsius in kelvin, what GRIB has for missing and from where it is taken for it.
MS_TO_KT, KELVIN = 1.943844, 273.15
GRIB_MISSING_FROM = 9.0e19
#: SQL type, least and largest integer, of which the least means missing.
DTYPES = {"i16": ("smallint", -32768, 32767), "i8": ("tinyint", -128, 127)}


def f32(x: float) -> Column:
    return F.lit(x).cast("float")


def finite(value: Column) -> Column:
    """NaN and what GRIB has for missing become null."""
    return F.when(~F.isnan(value) & (value < GRIB_MISSING_FROM), value)


def clip(value: Column, low: float, high: float) -> Column:
    """Null stays null (greatest and least would drop it)."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def quantize(value: Column, dtype: str, scale: float | Column, offset: float | Column = 0.0) -> Column:
    """Half-to-even steps of scale, clamped beside the missing integer; null and NaN give that one."""
    kind, low, high = DTYPES[dtype]
    x = value.cast("double")
    steps = F.rint((x - F.lit(offset)) / F.lit(scale))
    return F.when(x.isNull() | F.isnan(x), F.lit(low)).otherwise(clip(steps, float(low + 1), float(high))).cast(kind)


def dequantize(raw: Column, dtype: str, scale: float, offset: float = 0.0) -> Column:
    """In single precision; the missing integer gives null."""
    return F.when(raw != DTYPES[dtype][1], raw.cast("float") * f32(scale) + f32(offset))


def transform_units(value: Column, to_kt: bool = False, k_to_c: bool = False) -> Column:
    """In single precision, knots first."""
    value = value.cast("float")
    value = value * f32(MS_TO_KT) if to_kt else value
    return value - f32(KELVIN) if k_to_c else value


def quantize_field(value: Column, dtype: str, scale: float, to_kt: bool = False, k_to_c: bool = False) -> Column:
    return quantize(transform_units(value, to_kt, k_to_c), dtype, scale)


def speed_kt(u: Column, v: Column, to_kt: bool = True) -> Column:
    """Length of (u, v), in knots if the parts are in metres a second."""
    speed = F.sqrt(u * u + v * v).cast("float")
    return speed * f32(MS_TO_KT) if to_kt else speed
