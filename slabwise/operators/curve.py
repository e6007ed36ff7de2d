"""Slabs along a space-filling curve, so that boxes in any dimension read few files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slabwise.functions.coords import integer_div
from slabwise.schema import ArrayError, ArraySchema


def curve_number(origins: list[Column], shape, chunks) -> Column:
    """Morton number of a slab: the bits of its indices in turn, the last dimension lowest.

    A dimension takes part with as many bits as its slabs need, so long and short
    dimensions mix without gaps at the top.  63 bits hold any array that has slab numbers.
    """
    indexes = [integer_div(o.cast("bigint"), c) for o, c in zip(origins, chunks, strict=True)]
    widths = [(-(-n // c) - 1).bit_length() for n, c in zip(shape, chunks, strict=True)]
    if sum(widths) > 63:
        raise ArrayError("more slabs than 63 bits can number")
    number, position = F.lit(0).cast("bigint"), 0
    for bit in range(max(widths, default=0)):
        for index, width in reversed(list(zip(indexes, widths, strict=True))):
            if bit < width:
                one = F.shiftright(index, bit).bitwiseAND(F.lit(1).cast("bigint"))
                number = number.bitwiseOR(F.shiftleft(one, position))
                position += 1
    return number


def slab_curve(slabs: DataFrame, schema: ArraySchema) -> Column:
    """The number for rows of slabs."""
    return curve_number([F.col(f"origin_{d}") for d in schema.dim_names], schema.shape, schema.chunks)


def redistribute_by_curve(slabs: DataFrame, schema: ArraySchema, partitions: int | None = None) -> DataFrame:
    """Slabs in ranges of the curve: each range is a compact box, whatever the dimension.

    Stored files, and row groups within them, then have narrow origin ranges in every
    dimension.  With ``by_range`` of ``redistribute`` only the first dimension's are narrow.
    """
    key = slab_curve(slabs, schema).alias("_curve")
    keyed = slabs.select("*", key)
    ranged = keyed.repartitionByRange(partitions, "_curve") if partitions else keyed.repartitionByRange("_curve")
    return ranged.sortWithinPartitions("_curve").drop("_curve")
