"""Column functions: grid arithmetic, quantization, time labels, hashing and byte layout. All run inside the JVM."""

from gridloom.functions.bytes_ import fnv64, le_hex, le_payload, pad_to_four, padded_length
from gridloom.functions.grid import longitude, tile_id, tile_origin_lat, tile_origin_lon, z_res
from gridloom.functions.quant import clip, dequantize, finite, quantize, quantize_field, speed_kt, transform_units
from gridloom.functions.times import cycle_compact, cycle_iso, floor_to_cycle, forecast_times, parse_cycle, run_id

__all__ = [
    "clip", "cycle_compact", "cycle_iso", "dequantize", "finite", "floor_to_cycle", "fnv64", "forecast_times", "le_hex", "le_payload", "longitude", "pad_to_four",
    "padded_length", "parse_cycle", "quantize", "quantize_field", "run_id", "speed_kt", "tile_id", "tile_origin_lat", "tile_origin_lon", "transform_units", "z_res",
]
