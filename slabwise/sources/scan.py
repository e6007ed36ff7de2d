"""Spark data sources ``fits_image`` and ``hdf5_array``.

    register(spark)
    spark.read.format("hdf5_array").option("dataset", "/run/image").load(folder)

The driver reads one header for the schema, whatever the number of files.
``load_*`` of a folder is two stages: tasks open the headers of the listed files
and make a table of splits (numbered ranges of a large file's slabs, or several
small files), and that table is dealt evenly to the tasks that read.  Each opens
its files, works out the slabs of its splits and reads only their bytes, so
headers, data and decoding are all spread over the executors.
``spark.read.format`` must name its tasks on the driver, so it cuts large files
by their length alone there; tasks find out which slabs that is.

``spark.readStream.format("hdf5_array")`` follows one file whose dataset grows.

Options: ``hdu`` or ``dataset``; ``layout`` = ``cells`` (default) or ``slabs``;
``columns`` = comma-separated attributes to read; ``lo`` / ``hi`` =
comma-separated inclusive bounds in dimension order, ``*`` for open;
``withPath`` = ``true`` adds a ``source_path`` column; ``splitBytes``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from slabwise.functions.types import SPARK_TYPES
from slabwise.operators.restructure import unpack_slabs
from slabwise.schema import ArrayError, ArraySchema, BadBounds
from slabwise.session import ship_package, task_count
from slabwise.sources.files import RangedFile, is_file, list_paths
from slabwise.sources.fits import FitsImage
from slabwise.sources.hdf5 import Hdf5Dataset

SPLIT_BYTES = 64 * 1024 * 1024
OPEN_COST = 4 * 1024 * 1024  # bytes one could read while a file is opened
BATCH_CELLS = 256 * 1024
HEADERS_PER_TASK = 16  # files whose headers one planning task opens, about
FORMATS = {"fits_image": FitsImage, "hdf5_array": Hdf5Dataset}
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"


@dataclass
class Splits(InputPartition):
    """Work of one task: ``(path, part, parts)``, part of a file's slabs each."""

    pieces: list[tuple[str, int, int]]
    extra: list = field(default_factory=list)


def _bounds(options: dict, side: str, rank: int) -> list[int | None]:
    text = options.get(side)
    if not text:
        return [None] * rank
    values = [None if v.strip() in ("*", "") else int(v) for v in text.split(",")]
    if len(values) != rank:
        raise BadBounds(f"{side} names {len(values)} bounds for {rank} dimensions")
    return values


def _wanted(array, options: dict) -> list[tuple[str, object]]:
    names = [n.strip() for n in options.get("columns", "").split(",") if n.strip()]
    known = dict(array.columns)
    missing = [n for n in names if n not in known]
    if missing:
        raise ArrayError(f"no attribute {', '.join(missing)}; there are {', '.join(known)}")
    return [(n, known[n]) for n in names] if names else list(array.columns)


def spark_schema(array, options: dict) -> StructType:
    """Columns of a scan, from one opened file."""
    slabs = options.get("layout", "cells") == "slabs"
    names = array.schema.dim_names
    if slabs:
        heads = ["slab_no", *[f"origin_{d}" for d in names], *[f"last_{d}" for d in names]]
    else:
        heads = names
    fields = [StructField(h, LongType(), False) for h in heads]
    for name, dtype in _wanted(array, options):
        fields.append(StructField(name, ArrayType(dtype) if slabs else dtype, True))
    if options.get("withpath", "false").lower() == "true":
        fields.append(StructField("source_path", StringType(), False))
    return StructType(fields)


def read_split(form: str, path: str, part: int, parts: int, options: dict, extra=()):
    """Arrow batches of one split.

    ``extra`` holds ``(dimension, low, high)`` bounds that came from filters.
    """
    with RangedFile(path) as file:
        array = FORMATS[form](file, options)
        yield from _read_slabs(array, path, part, parts, options, extra)


def read_array(array, path: str, part: int, parts: int, options: dict):
    """The same of an array that is open already."""
    return _read_slabs(array, path, part, parts, options, ())


def _window(array, options: dict, extra=()) -> tuple[list[int], list[int], list[int], list[int]] | None:
    """Bounds in file order, the first slab and the slab counts; ``None`` if empty."""
    dims = array.file_dims
    names = [d.name for d in dims]
    order = [names.index(n) for n in array.schema.dim_names]  # schema order -> file order
    low = [0] * len(dims)
    high = [d.size - 1 for d in dims]
    for side, bounds in (("lo", low), ("hi", high)):
        for position, value in zip(order, _bounds(options, side, len(dims))):
            if value is None:
                continue
            # Files of a growing set may differ in their slowest extent only.
            if value < 0 or (position > 0 and value >= dims[position].size):
                raise BadBounds(f"{names[position]}: {value} outside 0..{dims[position].size - 1}")
            bounds[position] = value if side == "lo" else min(value, high[position])
    for name, floor, ceiling in extra:
        at = names.index(name)
        low[at] = low[at] if floor is None else max(low[at], floor)
        high[at] = high[at] if ceiling is None else min(high[at], ceiling)
    if any(a > b for a, b in zip(low, high)):
        return None
    first = [a // d.step for a, d in zip(low, dims)]
    counts = [b // d.step - f + 1 for b, d, f in zip(high, dims, first)]
    return low, high, first, counts


def _read_slabs(array, path, part, parts, options, extra):
    window = _window(array, options, extra)
    if window is None:
        return
    low, high, first, counts = window
    dims = array.file_dims
    names, steps = [d.name for d in dims], [d.step for d in dims]
    order = [names.index(n) for n in array.schema.dim_names]
    total = prod(counts)
    wanted = _wanted(array, options)
    columns = [n for n, _ in wanted]
    slabs = options.get("layout", "cells") == "slabs"
    with_path = options.get("withpath", "false").lower() == "true"
    weights = _slab_weights(array.schema, dict(zip(names, steps)))

    def origin_of(number):
        index = np.unravel_index(number, counts)
        return [(int(i) + f) * s for i, f, s in zip(index, first, steps)]

    numbers = range(total * part // parts, total * (part + 1) // parts)
    if numbers:
        array.prepare(origin_of(numbers[0]), origin_of(numbers[-1]))
    heads, sizes, columns_held, held_cells = [], [], [[] for _ in columns], 0

    def flush():
        """What is held as batches: columns are joined once, not chunk by chunk."""
        values = [pa.concat_arrays(parts) for parts in columns_held]
        if slabs:
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("i4"))
            arrays = [pa.array(np.array(h, "i8")) for h in zip(*heads, strict=True)]
            arrays += [pa.ListArray.from_arrays(ends, v) for v in values]
        else:
            arrays = [pa.array(np.concatenate(c)) for c in zip(*heads, strict=True)] + values
        rows = len(sizes) if slabs else sum(sizes)
        if with_path:
            arrays.append(pa.array([path], pa.string()).take(pa.array(np.zeros(rows, "i4"))))
        whole = pa.Table.from_arrays(arrays, names=spark_schema(array, options).names)
        yield from whole.to_batches(max_chunksize=1024 if slabs else BATCH_CELLS)

    for number in numbers:
        origin = origin_of(number)
        # Read only the part of the slab that the bounds touch.
        start = [max(o, a) for o, a in zip(origin, low)]
        stop = [min(o + s - 1, b, d.size - 1) for o, s, b, d in zip(origin, steps, high, dims)]
        extent = [b - a + 1 for a, b in zip(start, stop)]
        values = array.to_arrow(array.read_box(start, extent), columns)
        cells = prod(extent)
        if slabs:
            slab_no = sum(
                origin[order[k]] // steps[order[k]] * w for k, w in enumerate(weights)
            )
            heads.append([slab_no, *[start[p] for p in order], *[stop[p] for p in order]])
        else:
            heads.append(_coordinates(start, extent, order))
        sizes.append(cells)
        for parts_held, value in zip(columns_held, values, strict=True):
            parts_held.append(value)
        held_cells += cells
        if held_cells >= BATCH_CELLS:
            yield from flush()
            heads, sizes, columns_held, held_cells = [], [], [[] for _ in columns], 0
    if sizes:
        yield from flush()


def _slab_weights(schema, steps: dict) -> list[int]:
    """Weight of each dimension in the slab number, first dimension fastest."""
    weights, weight = [], 1
    for dim in schema.dims:
        weights.append(weight)
        weight *= -(-dim.size // steps[dim.name]) if steps[dim.name] else 1
    return weights


def _coordinates(start, extent, order) -> list[np.ndarray]:
    rank = len(extent)
    columns = []
    for position in order:
        shape = [1] * rank
        shape[position] = extent[position]
        axis = np.arange(start[position], start[position] + extent[position], dtype="i8")
        columns.append(np.broadcast_to(axis.reshape(shape), extent).reshape(-1))
    return columns


class ArrayReader(DataSourceReader):
    def __init__(self, form: str, options: dict):
        self.form, self.options, self.extra = form, dict(options), []

    def partitions(self):
        paths = list_paths(self.options["path"], FORMATS[self.form].suffixes)
        return plan_splits(self.form, paths, self.options, self.extra)

    def read(self, partition: Splits):
        for path, part, parts in partition.pieces:
            yield from read_split(self.form, path, part, parts, self.options, partition.extra)


def parts_of_file(form: str, path: str, size: int, options: dict, extra=()) -> int:
    """Into how many splits a file is cut, from its header; 0 if nothing of it is wanted."""
    target = int(options.get("splitbytes", SPLIT_BYTES))
    if size <= target:
        return 1
    with RangedFile(path) as file:
        array = FORMATS[form](file, options)
        window = _window(array, options, extra)
        if window is None:
            return 0
        low, high, _, counts = window
        data = prod(b - a + 1 for a, b in zip(low, high)) * array.record.itemsize
        return max(1, min(-(-size // target), prod(counts), -(-data // target)))


def group_pieces(sized, target: int):
    """Lists of ``(path, part, parts)`` of about ``target`` bytes each, from ``(path, size, parts)``."""
    shared, filled = [], 0
    for path, size, parts in sized:
        if parts > 1:
            yield from ([(path, i, parts)] for i in range(parts))
        if parts != 1:
            continue
        cost = size + min(OPEN_COST, target)
        if shared and filled + cost > target:
            yield shared
            shared, filled = [], 0
        shared.append((path, 0, 1))
        filled += cost
    if shared:
        yield shared


def plan_splits(form: str, paths: list[tuple[str, int]], options: dict, extra=()) -> list[Splits]:
    """Tasks of about equal bytes, made on the driver: large files in parts, small files together.

    The header of a single file says how much of it is wanted.  Of several files only the
    lengths count: no header is opened here, and a task may find that its part has no slab.
    """
    target = int(options.get("splitbytes", SPLIT_BYTES))
    if len(paths) == 1:
        sized = [(*paths[0], parts_of_file(form, *paths[0], options, extra))]
    else:
        sized = [(path, size, max(1, -(-size // target))) for path, size in paths]
    # Spark would read an empty plan as one unnamed task, so it gets one with no work.
    return [Splits(pieces, list(extra)) for pieces in list(group_pieces(sized, target)) or [[]]]


class GrowingReader(DataSourceStreamReader):
    """New frames of one extendable dataset; the offset is its frame count."""

    def __init__(self, form: str, options: dict):
        self.form, self.options = form, dict(options)

    def _array(self, use):
        path, _ = self._file()
        with RangedFile(path) as file:
            return use(FORMATS[self.form](file, self.options))

    def _file(self):
        paths = list_paths(self.options["path"], FORMATS[self.form].suffixes)
        if len(paths) != 1:
            raise ArrayError("a growing dataset is one file; follow a folder with scan_stream")
        return paths[0]

    def initialOffset(self):
        return {"frames": 0}

    def latestOffset(self):
        return {"frames": self._array(lambda a: a.file_dims[0].size)}

    def partitions(self, start, end):
        name = self._array(lambda a: a.file_dims[0].name)
        fresh = [(name, start["frames"], end["frames"] - 1)]
        return plan_splits(self.form, [self._file()], self.options, fresh)

    def read(self, partition: Splits):
        for path, part, parts in partition.pieces:
            yield from read_split(self.form, path, part, parts, self.options, partition.extra)

    def commit(self, end):
        pass


class PushdownReader(ArrayReader):
    """Turns comparisons of a dimension with a literal into slab pruning.

    Filters are also left to Spark, so a pruned read never drops a row wrongly.
    """

    def pushFilters(self, filters):
        names = {d.name for d in probe(self.form, self.options, lambda a: a.schema.dims)}
        for f in filters:
            column = getattr(f, "attribute", (None,))
            if len(column) == 1 and column[0] in names:
                low = high = None
                if isinstance(f, (EqualTo, GreaterThanOrEqual)):
                    low = f.value
                if isinstance(f, (EqualTo, LessThanOrEqual)):
                    high = f.value
                if isinstance(f, GreaterThan):
                    low = f.value + 1
                if isinstance(f, LessThan):
                    high = f.value - 1
                if (low, high) != (None, None) and self.options.get("layout", "cells") == "cells":
                    self.extra.append((column[0], low, high))
            yield f


def probe(form: str, options: dict, use):
    """Open the first file and apply ``use`` to its array."""
    path, _ = list_paths(options["path"], FORMATS[form].suffixes)[0]
    with RangedFile(path) as file:
        return use(FORMATS[form](file, options))


def file_columns(form: str, options: dict) -> StructType:
    """Columns of a scan of these options, from the first file's header."""
    return probe(form, options, lambda a: spark_schema(a, options))


class _ArraySource(DataSource):
    form = ""
    reader_class = ArrayReader

    @classmethod
    def name(cls):
        return cls.form

    def schema(self):
        return file_columns(self.form, dict(self.options))

    def reader(self, schema):
        return self.reader_class(self.form, self.options)

    def streamReader(self, schema):
        return GrowingReader(self.form, self.options)


class FitsSource(_ArraySource):
    form = "fits_image"


class Hdf5Source(_ArraySource):
    form = "hdf5_array"


class FitsPushdownSource(FitsSource):
    reader_class = PushdownReader


class Hdf5PushdownSource(Hdf5Source):
    reader_class = PushdownReader


def register(spark: SparkSession) -> None:
    """Make both formats known to the session."""
    ship_package(spark)
    push = spark.conf.get(PUSHDOWN_CONF, "false").lower() == "true"
    for source in (FitsPushdownSource, Hdf5PushdownSource) if push else (FitsSource, Hdf5Source):
        spark.dataSource.register(source)


def _load(spark: SparkSession, form: str, path: str, options: dict) -> DataFrame:
    register(spark)
    reader = spark.read.format(form)
    for key, value in options.items():
        if isinstance(value, (list, tuple)):
            value = ",".join("*" if v is None else str(v) for v in value)
        reader = reader.option(key, str(value).lower() if isinstance(value, bool) else value)
    return reader.load(path)


def _cells(slabs: DataFrame, form: str) -> DataFrame:
    """Cells made in the JVM from scanned slabs.

    Only values cross from Python; coordinates are computed in generated code,
    and only those a query uses.
    """
    dims = [c.removeprefix("origin_") for c in slabs.columns if c.startswith("origin_")]
    heads = {"slab_no", "source_path", *[f"{side}_{d}" for d in dims for side in ("origin", "last")]}
    attrs = [c for c in slabs.columns if c not in heads]
    keep = [c for c in slabs.columns if c == "source_path"]
    slowest_first = dims[::-1] if form == "fits_image" else dims
    return unpack_slabs(slabs, slowest_first, attrs, keep).select(*dims, *attrs, *keep)


def _through_slabs(form: str, options: dict) -> bool:
    """Whether cells are better made from slabs than sent row by row.

    They are for one attribute; zipping several arrays costs more than the
    coordinates of their cells.
    """
    return form == "fits_image" or probe(form, options, lambda a: len(_wanted(a, options))) == 1


def _load_cells(spark: SparkSession, form: str, path: str, options: dict) -> DataFrame:
    if not is_file(path):
        return _load_folder(spark, form, path, options)
    given = _texts({**options, "path": path})
    if options.get("layout", "cells") != "cells" or not _through_slabs(form, given):
        return _load(spark, form, path, options)
    return _cells(_load(spark, form, path, {**options, "layout": "slabs"}), form)


def _texts(options: dict) -> dict[str, str]:
    """Options as a data source gets them: small names, all values texts."""

    def text(value) -> str:
        if isinstance(value, (list, tuple)):
            return ",".join("*" if v is None else str(v) for v in value)
        return str(value).lower() if isinstance(value, bool) else str(value)

    return {k.lower(): text(v) for k, v in options.items() if v is not None}


def listed_files(spark: SparkSession, path: str, form: str) -> DataFrame:
    """``(path, length)`` of the files of a folder or a glob, by Spark's own listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    if any(c in path.rstrip("/").rpartition("/")[2] for c in "*?[{"):
        return files
    return files.where(F.lower(F.substring_index("path", "/", -1)).rlike("(" + "|".join(s.replace(".", "[.]") for s in FORMATS[form].suffixes) + ")$"))


def _load_folder(spark: SparkSession, form: str, path: str, options: dict) -> DataFrame:
    files, given = listed_files(spark, path, form), _texts(options)
    target = int(given.get("splitbytes", SPLIT_BYTES))
    cost = F.col("length") + min(OPEN_COST, target)
    found = files.agg(F.min("path").alias("sample"), F.sum(cost).alias("bytes"), F.count(F.lit(1)).alias("files")).first()
    if not found["files"]:
        raise FileNotFoundError(path)
    tasks = max(1, -(-found["bytes"] // target))
    return _planned(files, form, found["sample"], given, tasks, -(-found["files"] // HEADERS_PER_TASK))


def load_fits(spark: SparkSession, path: str, hdu: int = 0, **options) -> DataFrame:
    """One image unit of a FITS file, or of all FITS files of a folder."""
    return _load_cells(spark, "fits_image", path, {"hdu": hdu, **options})


def load_hdf5(spark: SparkSession, path: str, dataset: str, **options) -> DataFrame:
    """One dataset of an HDF5 file, or of all HDF5 files of a folder."""
    return _load_cells(spark, "hdf5_array", path, {"dataset": dataset, **options})


def describe_fits(path: str, hdu: int = 0) -> ArraySchema:
    """Array description of an image unit, from the (first) file's header."""
    planned = probe("fits_image", {"path": path, "hdu": hdu}, lambda a: a.schema.planned())
    return replace(planned, first_fastest=True)


def describe_hdf5(path: str, dataset: str) -> ArraySchema:
    """Array description of a dataset, from the (first) file's header."""
    return probe("hdf5_array", {"path": path, "dataset": dataset}, lambda a: a.schema)


def describe_slabs(form: str, path: str, options: dict) -> ArraySchema:
    """The description that the slabs of a scan of one file follow: the chunks they are read by."""
    if len(list_paths(path, FORMATS[form].suffixes)) != 1:
        raise ArrayError(f"{path}: several files are not one array; store them one by one")

    def described(array) -> ArraySchema:
        steps = {d.name: d.step for d in array.file_dims}
        chunked = array.schema.with_chunks([steps[n] for n in array.schema.dim_names])
        return replace(chunked, first_fastest=form == "fits_image")

    return probe(form, {**options, "path": path}, described)


_SPLITS = "pieces array<struct<path: string, part: bigint, parts: bigint>>"


def _planned(files: DataFrame, form: str, sample: str | None, options: dict, tasks: int, header_tasks: int, cells: StructType | None = None) -> DataFrame:
    """Cells (or slabs) of listed files: a stage that plans, then one that reads."""
    ship_package(files.sparkSession)
    through = options.get("layout", "cells") == "cells" and (_is_one(cells) if cells else _through_slabs(form, {**options, "path": sample}))
    options = {**options, "layout": "slabs"} if through else options
    schema = _given_columns(cells, options) if cells else file_columns(form, {**options, "path": sample})
    target = int(options.get("splitbytes", SPLIT_BYTES))

    def plan(batches):
        for batch in batches:
            sizes = zip(batch.column("path").to_pylist(), batch.column("length").to_pylist())
            sized = ((path, size, parts_of_file(form, path, size, options)) for path, size in sizes)
            names = ("path", "part", "parts")
            rows = [{"pieces": [dict(zip(names, p, strict=True)) for p in pieces]} for pieces in group_pieces(sized, target)]
            if rows:
                kind = pa.struct([("path", pa.string()), ("part", pa.int64()), ("parts", pa.int64())])
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("pieces", pa.list_(kind))]))

    def read(batches):
        for batch in batches:
            for pieces in batch.column("pieces").to_pylist():
                for piece in pieces:
                    yield from read_split(form, piece["path"], piece["part"], piece["parts"], options)

    spread = files.repartition(header_tasks, "path") if header_tasks > 1 else files.coalesce(1)
    # Rows of the table of splits stand for about the same bytes, so they are dealt in turn.
    scanned = spread.mapInArrow(plan, _SPLITS).repartition(tasks).mapInArrow(read, schema)
    return _cells(scanned, form) if through else scanned


def _is_one(cells: StructType) -> bool:
    return sum("dim" not in f.metadata for f in cells.fields) == 1


def cell_columns(schema: ArraySchema) -> StructType:
    """Columns of the cells of a described array, for scans without a file to look at."""
    fields = [StructField(d, LongType(), False, {"dim": True}) for d in schema.dim_names]
    return StructType(fields + [StructField(a.name, SPARK_TYPES[a.type][0], True) for a in schema.attrs])


def _given_columns(cells: StructType, options: dict) -> StructType:
    """The columns of a scan, as ``spark_schema`` has them, from those of its cells."""
    dims = [f.name for f in cells.fields if "dim" in f.metadata]
    slabs = options.get("layout", "cells") == "slabs"
    heads = ["slab_no", *[f"origin_{d}" for d in dims], *[f"last_{d}" for d in dims]] if slabs else dims
    fields = [StructField(h, LongType(), False) for h in heads]
    fields += [StructField(f.name, ArrayType(f.dataType) if slabs else f.dataType, True) for f in cells.fields if f.name not in dims]
    return StructType(fields + [StructField("source_path", StringType(), False)] * (options.get("withpath") == "true"))


def scan_listed(files: DataFrame, form: str, sample: str | None, options: dict, schema: ArraySchema | None = None) -> DataFrame:
    """Cells of the files of a ``(path, length)`` DataFrame, batch or stream.

    The columns are those of ``schema``, or of the first header of ``sample`` (a file or a
    folder).  With ``schema`` no file needs to be there yet.  Large files become many rows
    before the shuffle, one per split.
    """
    given = {**_texts(options), "withpath": "true"}
    tasks = task_count(files.sparkSession)
    return _planned(files, form, sample, given, tasks, tasks, cell_columns(schema) if schema else None)
