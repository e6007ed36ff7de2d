"""Nested rows to N-dimensional cells and back."""

from __future__ import annotations

from math import prod

from pyspark.sql import DataFrame, functions as F, types as T

from slabwise.functions.coords import delinearize
from slabwise.schema import ArrayError, BadBounds


def unroll(
    df: DataFrame,
    outer: list[str],
    values: str,
    shape,
    attr: str,
    dims: list[str] | None = None,
    lo=None,
    hi=None,
) -> DataFrame:
    """A row-major ``values`` array per element to one row per cell.

    Outer dimensions come first, the inside dimensions of ``shape`` last.  With
    inclusive inside bounds ``lo``/``hi`` the array is sliced to the run that
    covers the box before it is exploded, so cells outside are never made.
    An array of another length than ``shape`` fails by name; a null one has no cells.
    """
    rank = len(shape)
    dims = dims or [f"unnamed{len(outer) + i}" for i in range(rank)]
    lo = [0 if b is None else b for b in (lo or [None] * rank)]
    hi = [n - 1 if b is None else b for b, n in zip(hi or [None] * rank, shape)]
    for low, high, size in zip(lo, hi, shape, strict=True):
        if not 0 <= low <= high < size:
            raise BadBounds(f"inside bounds {low}..{high} outside 0..{size - 1}")

    first = last = 0
    for low, high, size in zip(lo, hi, shape):
        first, last = first * size + low, last * size + high
    whole = first == 0 and last == prod(shape) - 1
    source = F.col(values) if whole else F.slice(F.col(values), first + 1, last - first + 1)
    wrong = F.concat(F.lit(f"{values} does not have {prod(shape)} values but "), F.size(values))
    source = F.when(F.size(values) != prod(shape), F.raise_error(wrong)).otherwise(source)

    names = [*outer, "_at", attr]
    cells = df.select(*outer, F.posexplode(source)).toDF(*names)
    coords = delinearize(F.col("_at") + first, shape)
    cells = cells.select(*outer, *[c.alias(d) for c, d in zip(coords, dims)], attr)
    for dim, low, high, size in zip(dims, lo, hi, shape):
        if (low, high) != (0, size - 1):
            cells = cells.where(F.col(dim).between(low, high))
    return cells


def unroll_nested(
    df: DataFrame, outer: list[str], values: str, depth: int, attr: str, dims: list[str] | None = None
) -> DataFrame:
    """The same for arrays of arrays: one ``posexplode`` per nesting level."""
    dims = dims or [f"unnamed{len(outer) + i}" for i in range(depth)]
    done = list(outer)
    current = df.select(*outer, F.col(values).alias(attr))
    for dim in dims:
        exploded = current.select(*done, F.posexplode(attr)).toDF(*done, dim, attr)
        current = exploded.withColumn(dim, F.col(dim).cast("bigint"))
        done.append(dim)
    return current


def compound_to_attrs(df: DataFrame, record: str) -> DataFrame:
    """Members of one record column become top-level columns."""
    others = [F.col(c) for c in df.columns if c != record]
    return df.select(*others, f"{record}.*")


def flatten_compound(df: DataFrame, sep: str = "_") -> DataFrame:
    """Records within records become ``parent_child`` columns, at any depth."""

    def leaves(dtype: T.StructType, path: list[str]):
        for field in dtype.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                yield F.col(quoted).alias(sep.join(here))

    return df.select(*leaves(df.schema, []))


def array_member_to_cols(df: DataFrame, member: str, n: int) -> DataFrame:
    """A fixed array member of ``n`` elements becomes ``m_0 .. m_{n-1}``."""
    others = [F.col(c) for c in df.columns if c != member]
    elements = [F.get(F.col(member), i).alias(f"{member}_{i}") for i in range(n)]
    return df.select(*others, *elements)


def vlen_unwrap(df: DataFrame, outer: list[str], values: str, dim: str) -> DataFrame:
    """A variable-length list of records becomes one more (ragged) dimension."""
    element = df.schema[values].dataType.elementType
    exploded = df.select(*outer, F.posexplode(values)).toDF(*outer, dim, "_rec")
    at = F.col(dim).cast("bigint").alias(dim)
    if isinstance(element, T.StructType):
        return exploded.select(*outer, at, "_rec.*")
    return exploded.select(*outer, at, F.col("_rec").alias(values))


def split_attrs(df: DataFrame, dims: list[str], attrs: list[str]) -> DataFrame:
    """One row per cell and attribute: ``(dims.., attr, value)``."""
    return df.unpivot(dims, attrs, "attr", "value")


def name_attrs(df: DataFrame, dims: list[str]) -> DataFrame:
    """Default attribute names: class plus 1-based position among the attributes."""
    mapping, position = {}, 0
    for field in df.schema.fields:
        if field.name in dims:
            continue
        position += 1
        mapping[field.name] = f"{_class_prefix(field.dataType)}{position}"
    return df.withColumnsRenamed(mapping)


def _class_prefix(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType) or isinstance(dtype, T.DecimalType):
        return "int"
    if isinstance(dtype, T.FractionalType):
        return "float"
    if isinstance(dtype, T.StringType):
        return "str"
    raise ArrayError(f"no default attribute name for {dtype.simpleString()}")


def name_dims(df: DataFrame, dims: list[str], prefix: str = "unnamed") -> DataFrame:
    """Default dimension names: ``unnamed0..`` (datasets) or ``dim0..`` (images)."""
    return df.withColumnsRenamed({d: f"{prefix}{i}" for i, d in enumerate(dims)})


def scalar_array(df: DataFrame, dim: str = "unnamed0") -> DataFrame:
    """Each scalar row as a one-cell array: coordinate 0 is put in front."""
    return df.select(F.lit(0).cast("bigint").alias(dim), *df.columns)


def unpack_slabs(slabs: DataFrame, dims: list[str], attrs: list[str], keep: list[str] | None = None) -> DataFrame:
    """Slabs back to cells, with the columns ``keep`` repeated.

    ``dims`` run from the slowest to the fastest.  The offset within a slab is
    split by the slab's own clipped extents, so slabs at the array edge need no
    special case.
    """
    keep = keep or []
    keys = [*keep, *[f"{side}_{d}" for d in dims for side in ("origin", "last")]]
    packed = F.arrays_zip(*attrs) if len(attrs) > 1 else F.col(attrs[0])
    exploded = slabs.select(*keys, F.posexplode(packed)).toDF(*keys, "_at", "_cell")
    coords, rest = {}, F.col("_at").cast("bigint")
    for dim in reversed(dims[1:]):
        extent = F.col(f"last_{dim}") - F.col(f"origin_{dim}") + 1
        coords[dim] = F.col(f"origin_{dim}") + rest % extent
        rest = F.call_function("div", rest, extent)
    coords[dims[0]] = F.col(f"origin_{dims[0]}") + rest
    cell = F.col("_cell")
    values = [cell.getField(a).alias(a) for a in attrs] if len(attrs) > 1 else [cell.alias(attrs[0])]
    return exploded.select(*[coords[d].alias(d) for d in dims], *values, *keep)


def redistribute(df: DataFrame, keys: list[str], partitions: int | None = None, by_range: bool = False) -> DataFrame:
    """Spread slabs over the cluster by their origin.

    By default rows are rebalanced: those of a key stay together as far as
    partitions stay near the advisory size, so a hot key is split and small
    ones are merged.  ``partitions`` asks for an exact number instead, and
    ``by_range`` samples first and keeps neighbours together, which gives
    stored files narrow origin ranges.
    """
    if by_range:
        return df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    if partitions:
        return df.repartition(partitions, *keys)
    return df.hint("rebalance", *[F.col(k) for k in keys])
