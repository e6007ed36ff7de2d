"""Raw element bytes to values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def decode_int(data: Column, size: int, signed: bool, big_endian: bool, offset: int = 0) -> Column:
    """Integer of ``size`` bytes at a byte offset of a binary column.

    Unsigned 8-byte values come back as DECIMAL(20,0), all others as BIGINT.
    """
    digits = F.hex(F.substring(data, offset + 1, size))
    if not big_endian:
        digits = F.concat(*[F.substring(digits, 2 * i + 1, 2) for i in reversed(range(size))])
    if size == 8:
        # conv wraps at 64 bits; a negative base asks for the signed reading.
        return F.conv(digits, 16, -10).cast("bigint") if signed else F.conv(digits, 16, 10).cast("decimal(20,0)")
    value = F.conv(digits, 16, 10).cast("bigint")
    if signed:
        span = 2 ** (8 * size)
        value = F.when(value >= span // 2, value - span).otherwise(value)
    return value


def fixed_string(data: Column, padding: Column | str) -> Column:
    """Text of a fixed-length binary field.

    ``padding`` is ``nullterm`` (ends at the first zero byte), ``nullpad``
    (trailing zero bytes go) or ``spacepad`` (trailing spaces go).
    """
    if isinstance(padding, str):
        padding = F.lit(padding)
    text = F.decode(data, "UTF-8")
    return (
        F.when(padding == "nullterm", F.substring_index(text, "\0", 1))
        .when(padding == "nullpad", F.rtrim(text, F.lit("\0")))
        .when(padding == "spacepad", F.rtrim(text, F.lit(" ")))
    )


def physical_value(raw: Column, scale, zero) -> Column:
    """``zero + scale * raw`` in double precision."""
    return F.lit(zero).cast("double") + F.lit(scale).cast("double") * raw.cast("double")
