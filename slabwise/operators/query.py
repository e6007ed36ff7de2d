"""Counting, slicing and statistics over cells and slabs."""

from __future__ import annotations

from math import prod

from pyspark.sql import DataFrame, functions as F

from slabwise.functions.coords import linearize
from slabwise.operators.restructure import unpack_slabs
from slabwise.schema import ArraySchema, BadBounds


def count_cells(cells: DataFrame) -> DataFrame:
    return cells.agg(F.count(F.lit(1)).alias("count"))


def avg_all(cells: DataFrame, attr: str) -> DataFrame:
    return cells.agg(F.avg(attr).alias("avg"))


def subarray(cells: DataFrame, dims: list[str], lo, hi, rebase: bool = False) -> DataFrame:
    """Cells within inclusive bounds; ``None`` leaves a side open."""
    sliced = cells
    for dim, low, high in zip(dims, lo, hi, strict=True):
        if low is not None and high is not None and low > high:
            raise BadBounds(f"{dim}: {low} > {high}")
        if low is not None:
            sliced = sliced.where(F.col(dim) >= low)
        if high is not None:
            sliced = sliced.where(F.col(dim) <= high)
    if rebase:
        moved = {d: (F.col(d) - low).alias(d) for d, low in zip(dims, lo) if low}
        sliced = sliced.select(*[moved.get(c, F.col(c)) for c in sliced.columns])
    return sliced


def touching_slabs(slabs: DataFrame, schema: ArraySchema, lo, hi) -> DataFrame:
    """Slabs that share a cell with the box.

    Origin and last coordinates are compared as bare columns with literals, so
    the predicates reach the Parquet row groups.
    """
    touching = slabs
    for dim, low, high in zip(schema.dim_names, lo, hi, strict=True):
        if high is not None:
            touching = touching.where(F.col(f"origin_{dim}") <= high)
        if low is not None:
            touching = touching.where(F.col(f"last_{dim}") >= low)
    return touching


def subarray_slabs(slabs: DataFrame, schema: ArraySchema, lo, hi) -> DataFrame:
    """Cells of stored slabs within inclusive bounds; only slabs that touch the box are read and exploded."""
    cells = unpack_slabs(touching_slabs(slabs, schema, lo, hi), schema.slowest_first, schema.attr_names)
    return subarray(cells.select(*schema.dim_names, *schema.attr_names), schema.dim_names, lo, hi)


def stats_by_dim(cells: DataFrame, dims: list[str], attr: str) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per coordinate of ``dims``.

    All five combine map-side, so a hot coordinate costs one row per task.
    """
    return cells.groupBy(*dims).agg(
        F.count(attr).alias("count"),
        F.avg(attr).alias("avg"),
        F.stddev_samp(attr).alias("stdev"),
        F.min(attr).alias("min"),
        F.max(attr).alias("max"),
    )


def stdev_by_dim(cells: DataFrame, dims: list[str], attr: str) -> DataFrame:
    return cells.groupBy(*dims).agg(F.stddev_samp(attr).alias("stdev"))


def first_n_elements(cells: DataFrame, schema: ArraySchema, n: int, first_fastest: bool | None = None) -> DataFrame:
    """The first ``n`` cells in file order, by default that of the description.

    No sort: the offset is arithmetic, and the bound on the slowest dimension is
    a bare comparison that prunes files and row groups.
    """
    reverse = schema.first_fastest if first_fastest is None else first_fastest
    dims = schema.dims[::-1] if reverse else schema.dims
    names, shape = [d.name for d in dims], [d.size for d in dims]
    offset = linearize([F.col(d) for d in names], shape)
    slowest = (n - 1) // prod(shape[1:])
    return cells.where(F.col(names[0]) <= slowest).where(offset < n)


def first_n_slabs(slabs: DataFrame, n: int) -> DataFrame:
    return slabs.where(F.col("slab_no") < n)
