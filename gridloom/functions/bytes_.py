"""Hashes and little-endian layout of binary columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Halves of the FNV-1a 64 basis; the prime is 2**40 + 435.
BASIS = (3421674724, 2216829733)


def fnv64(data: Column) -> Column:
    """FNV-1a 64 as 16 hexadecimal digits. The state is two 32-bit halves in longs, so nothing overflows."""
    digits = F.hex(data)
    count = F.octet_length(data)
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    values = F.transform(places, lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("long"))
    low32 = F.lit(0xFFFFFFFF)
    start = F.struct(F.lit(BASIS[0]).cast("long").alias("hi"), F.lit(BASIS[1]).cast("long").alias("lo"))

    def step(state: Column, x: Column) -> Column:
        m = state["lo"].bitwiseXOR(x)
        carry = F.shiftright(m * 435, 32)
        hi = (state["hi"] * 435 + carry + F.shiftleft(m.bitwiseAND(F.lit(0xFFFFFF)), 8)).bitwiseAND(low32)
        return F.struct(hi.alias("hi"), (m * 435).bitwiseAND(low32).alias("lo"))

    text = lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")
    return F.aggregate(values, start, step, lambda s: F.concat(text(s["hi"]), text(s["lo"])))


def padded_length(length: Column, to: int = 4) -> Column:
    return length + F.pmod(-length, F.lit(to))


def pad_to_four(data: Column) -> Column:
    zeros = F.unhex(F.repeat(F.lit("00"), F.pmod(-F.octet_length(data), F.lit(4))))
    return F.concat(data, zeros)


def le_hex(raw: Column, width: int) -> Column:
    """A signed integer as hexadecimal digits of so many little-endian bytes."""
    digits = F.lpad(F.hex(F.pmod(raw.cast("long"), F.lit(1 << 8 * width))), 2 * width, "0")
    return F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(width))])


def le_payload(raws: Column, width: int) -> Column:
    """An array of integers as one binary."""
    return F.unhex(F.array_join(F.transform(raws, lambda x: le_hex(x, width)), ""))
