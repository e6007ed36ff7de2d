"""Cells and frames to slabs, in one exchange and one pass.

Tasks gather neighbouring cells of a slab into one row before anything is exchanged, so a
slab of a million cells in file order travels as a few rows.  Rows are dealt by slab and
sorted by it; a streaming pass then puts the values of one slab at a time into place, and
checks while it does so that every place is filled exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from slabwise.functions.coords import slab_cell_count, slab_number, slab_origin
from slabwise.schema import ArrayError, ArraySchema, BadBounds
from slabwise.session import ship_package

#: Cells that a task looks at together before they are exchanged, and their bytes.
GATHERED_CELLS = 1 << 20
GATHERED_BYTES = 32 << 20


def pack_slabs(cells: DataFrame, schema: ArraySchema, checked: bool = True) -> DataFrame:
    """Cells to slabs: one row-major value list per (slab, attribute).

    A slab has exactly as many cells as its clipped chunk.  ``checked`` enforces that for
    any input.  A slab that gets more cells than it has places fails by name as soon as it
    does, so a coordinate repeated without end never piles up; one with fewer cells, or with
    a place filled twice, fails when it ends.  A coordinate that is null, negative or behind
    the box fails by its own name.  Slabs without any cell are no rows.

    The input is read once.  A task holds one slab and up to ``GATHERED_CELLS`` cells.
    Pass ``checked=False`` only for cells that a scan or ``unroll`` made.
    """
    dims, shape, chunks = schema.dim_names, schema.shape, schema.chunks
    if checked:
        cells = _inside(cells, dims, shape)
    origins = [slab_origin(F.col(d), c) for d, c in zip(dims, chunks, strict=True)]
    place = F.lit(0).cast("bigint")
    for dim, origin, size, chunk in zip(dims, origins, shape, chunks, strict=True):
        place = place * slab_cell_count([origin], [size], [chunk]) + (F.col(dim).cast("bigint") - origin)
    placed = cells.select(slab_number(origins, shape, chunks).alias("slab_no"), place.alias("_places"), *schema.attr_names)
    ship_package(cells.sparkSession)
    heads = [T.StructField("slab_no", T.LongType()), T.StructField("_places", T.ArrayType(T.LongType()))]
    values = [T.StructField(a, T.ArrayType(placed.schema[a].dataType)) for a in schema.attr_names]
    gathered = placed.mapInArrow(_gather, T.StructType(heads + values))
    return _filled(gathered, schema, schema, schema.attr_names, checked, nested=False)


def pack_frames(frames: DataFrame, values: str, schema: ArraySchema, checked: bool = True) -> DataFrame:
    """One-row-per-frame arrays to slabs of several frames.

    The first dimension of ``schema`` numbers the frames, the others lie inside
    ``values``.  Frames stay arrays all the way: next to packing cells, one row
    and one coordinate travel per frame instead of per cell.  ``checked`` refuses,
    each by name, frames outside the box, null or of another length, repeated or
    missing in a slab.
    """
    outer, *inside = schema.dims
    if any(d.step != d.size for d in inside):
        raise BadBounds("inside dimensions are never split")
    if checked:
        length = prod(d.size for d in inside)
        wrong = F.concat(F.lit(f"{values} does not have {length} values in frame "), F.col(outer.name).cast("string"))
        right = F.coalesce(F.size(values) == length, F.lit(False))
        frames = _inside(frames, [outer.name], [outer.size]).withColumn(values, F.when(right, F.col(values)).otherwise(F.raise_error(wrong)))
    origin = slab_origin(F.col(outer.name), outer.step)
    placed = frames.select(
        slab_number([origin], [outer.size], [outer.step]).alias("slab_no"),
        F.array(F.col(outer.name).cast("bigint") - origin).alias("_places"),
        F.array(F.col(values)).alias(schema.attr_names[0]),
    )
    ship_package(frames.sparkSession)
    numbered = ArraySchema(schema.name, schema.attrs, (outer,))
    return _filled(placed, schema, numbered, schema.attr_names[:1], checked, nested=True)


def _inside(rows: DataFrame, dims: list[str], shape) -> DataFrame:
    """The same rows; a coordinate outside the box fails by name."""
    checked = {}
    for dim, size in zip(dims, shape, strict=True):
        shown = F.coalesce(F.col(dim).cast("string"), F.lit("null"))
        outside = F.raise_error(F.concat(F.lit(f"{dim} outside 0..{size - 1}: "), shown))
        checked[dim] = F.when(F.coalesce(F.col(dim).between(0, size - 1), F.lit(False)), F.col(dim)).otherwise(outside)
    return rows.withColumns(checked)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of a task as lists per slab."""

    def lists(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        slabs = rows["slab_no"].to_numpy()
        if (np.diff(slabs) < 0).any():
            order = np.argsort(slabs, kind="stable")
            rows, slabs = rows.take(pa.array(order)).combine_chunks(), slabs[order]
        ends = _runs(slabs)
        offsets = pa.array(ends, pa.int32())
        columns = [pa.array(slabs[ends[:-1]])]
        columns += [pa.ListArray.from_arrays(offsets, _one(rows[c])) for c in rows.column_names[1:]]
        yield from pa.Table.from_arrays(columns, rows.column_names).to_batches(max_chunksize=256)

    held, cells, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cells += batch.num_rows
        size += batch.nbytes
        if cells >= GATHERED_CELLS or size >= GATHERED_BYTES:
            yield from lists(held)
            held, cells, size = [], 0, 0
    if held:
        yield from lists(held)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


class _Slab:
    """One slab as it fills up."""

    def __init__(self, number: int, origins: list[int], room: int, checked: bool):
        self.number, self.origins, self.room, self.checked = number, origins, room, checked
        self.places, self.values, self.filled = [], [], 0

    def _fail(self, what: str):
        raise ArrayError(f"{what} in slab {','.join(map(str, self.origins))}")

    def add(self, places: np.ndarray, values: list[pa.Array]) -> None:
        self.filled += len(places)
        if self.checked and self.filled > self.room:
            self._fail("duplicate cells: too many")
        self.places.append(places)
        self.values.append(values)

    def columns(self) -> list[pa.Array]:
        """Values in the order of their places."""
        places = np.concatenate(self.places)
        if self.checked and len(places) < self.room:
            self._fail("missing cells: too few")
        if self.checked:
            order = np.full(self.room, -1)
            order[places] = np.arange(len(places))
            if (order < 0).any():
                self._fail("duplicate cells: repeated")
        else:
            order = np.argsort(places, kind="stable")
        joined = [pa.concat_arrays(parts) for parts in zip(*self.values, strict=True)]
        return joined if (order == np.arange(len(order))).all() else [c.take(pa.array(order)) for c in joined]


def _fill(numbered: ArraySchema, out: ArraySchema, attrs: list[str], checked: bool, nested: bool):
    """Rows sorted by slab: one row per slab with all its values."""
    shape, steps = numbered.shape, numbered.chunks
    counts = [-(-n // s) for n, s in zip(shape, steps, strict=True)]

    def begun(number: int) -> _Slab:
        rest, origins, room = number, [], 1
        for size, step, count in zip(shape, steps, counts, strict=True):
            origins.append(rest % count * step)
            room *= min(step, size - origins[-1])
            rest //= count
        return _Slab(number, origins, room, checked)

    def row(slab: _Slab) -> pa.RecordBatch:
        columns = [c.flatten() if nested else c for c in slab.columns()]
        origins = [*slab.origins, *[0] * (len(out.dims) - len(slab.origins))]
        lasts = [min(o + d.step, d.size) - 1 for o, d in zip(origins, out.dims, strict=True)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
        names = ["slab_no", *[f"origin_{d}" for d in out.dim_names], *[f"last_{d}" for d in out.dim_names], *attrs]
        return pa.RecordBatch.from_arrays([*[pa.array([n], pa.int64()) for n in (slab.number, *origins, *lasts)], *lists], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = None
        for batch in batches:
            numbers = batch.column("slab_no").to_numpy()
            ends = _runs(numbers)
            for low, high in zip(ends, ends[1:], strict=False):
                if low == high:
                    continue
                if slab is None or numbers[low] != slab.number:
                    if slab is not None:
                        yield row(slab)
                    slab = begun(int(numbers[low]))
                part = batch.slice(low, high - low)
                slab.add(part.column("_places").flatten().to_numpy(), [part.column(a).flatten() for a in attrs])
        if slab is not None:
            yield row(slab)

    return run


def _filled(rows: DataFrame, schema: ArraySchema, numbered: ArraySchema, attrs: list[str], checked: bool, nested: bool) -> DataFrame:
    heads = ["slab_no", *[f"origin_{d}" for d in schema.dim_names], *[f"last_{d}" for d in schema.dim_names]]
    fields = [T.StructField(h, T.LongType(), False) for h in heads]
    for attr in attrs:
        kind = rows.schema[attr].dataType
        fields.append(T.StructField(attr, kind.elementType if nested else kind))
    dealt = rows.repartition("slab_no").sortWithinPartitions("slab_no")
    return dealt.mapInArrow(_fill(numbered, schema, attrs, checked, nested), T.StructType(fields))
