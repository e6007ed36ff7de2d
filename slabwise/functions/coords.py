"""Coordinate arithmetic.  Everything here is plain LONG arithmetic in codegen."""

from __future__ import annotations

from math import prod

from pyspark.sql import Column, functions as F


def integer_div(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("bigint"))


def linearize(coords: list[Column], shape) -> Column:
    """Row-major offset of a cell, last dimension fastest."""
    offset = coords[0].cast("bigint")
    for coord, size in zip(coords[1:], shape[1:], strict=True):
        offset = offset * F.lit(size).cast("bigint") + coord.cast("bigint")
    return offset


def delinearize(offset: Column, shape) -> list[Column]:
    """Inverse of :func:`linearize`; the first coordinate is left unbounded."""
    offset = offset.cast("bigint")
    coords = []
    for axis, size in enumerate(shape):
        stride = prod(shape[axis + 1 :])
        coord = integer_div(offset, stride) if stride != 1 else offset
        coords.append(coord if axis == 0 else coord % F.lit(size).cast("bigint"))
    return coords


def slab_origin(coord: Column, chunk: int) -> Column:
    """First coordinate of the slab that holds a (non-negative) coordinate."""
    coord = coord.cast("bigint")
    return coord - coord % F.lit(chunk).cast("bigint")


def slab_number(origins: list[Column], shape, chunks) -> Column:
    """Position of a slab in the slab order, first dimension fastest."""
    number, weight = F.lit(0).cast("bigint"), 1
    for origin, size, chunk in zip(origins, shape, chunks, strict=True):
        number = number + integer_div(origin.cast("bigint"), chunk) * F.lit(weight).cast("bigint")
        weight *= -(-size // chunk) if chunk else 1
    return number


def slab_cell_count(origins: list[Column], shape, chunks) -> Column:
    """Cells of a slab, clipped at the array edge."""
    count = F.lit(1).cast("bigint")
    for origin, size, chunk in zip(origins, shape, chunks, strict=True):
        left = F.lit(size).cast("bigint") - origin.cast("bigint")
        count = count * F.least(F.lit(chunk).cast("bigint"), left)
    return count
