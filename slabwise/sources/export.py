"""Text dump of one dataset, by its kind, and of all datasets of a folder in one plan."""

from __future__ import annotations

from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from slabwise.operators.dump import array_ddl, dump_frames, dump_records
from slabwise.operators.restructure import array_member_to_cols, flatten_compound
from slabwise.session import ship_package, task_count
from slabwise.sources.catalog import HDF5_FILES, hdf5_catalog
from slabwise.sources.files import RangedFile
from slabwise.sources.hdf5 import Hdf5Dataset
from slabwise.sources.scan import load_hdf5, parts_of_file, probe, read_array

# Places of the lines in front of a dataset's values.
DDL_LINE, HEADING_LINE = -2, -1


def frames_of_slabs(slabs: DataFrame, dim: str, attr: str, frame_cells: int) -> DataFrame:
    """One row per outer element: its coordinate and its own values."""
    first, last = F.col(f"origin_{dim}"), F.col(f"last_{dim}")
    numbered = slabs.select(f"origin_{dim}", attr, F.explode(F.sequence(first, last)).alias(dim))
    start = ((F.col(dim) - first) * frame_cells + 1).cast("int")
    return numbered.select(dim, F.slice(attr, start, F.lit(frame_cells)).alias(attr))


def dump_dataset(
    spark: SparkSession, path: str, dataset: str, outer_limit: int | None = None,
    inner_limit: int | None = None, frame_limit: int | None = None,
) -> DataFrame:
    """Lines ``(record, line)`` of a dataset of one file.

    A 1-D compound gives one line per record, a 1-D array of arrays one line per
    frame; other shapes give a notice.  The limits are those of ``dump_frames``.
    """
    schema, element = probe("hdf5_array", {"path": path, "dataset": dataset}, lambda a: (a.schema, a.element))
    outer = [d for d in schema.dims if not d.inside]
    if len(outer) == 1 and element.class_name == "COMPOUND":
        records = flatten_compound(load_hdf5(spark, path, dataset))
        for name, count in _array_members(element):
            records = array_member_to_cols(records, name, count)
        names = [outer[0].name, *_flat_names(element)]
        return dump_records(records.select(*[F.col(f"`{n}`") for n in names]), outer[0].name, dataset)
    if len(outer) == 1 and element.class_name == "ARRAY":
        # Bounds reach the scan, so frames beyond the limit are not read.
        hi = [None if outer_limit is None else min(outer_limit, outer[0].size) - 1, *[None] * len(element.shape)]
        slabs = load_hdf5(spark, path, dataset, layout="slabs", hi=hi)
        attr = schema.attrs[0].name
        frames = frames_of_slabs(slabs, outer[0].name, attr, prod(element.shape))
        return dump_frames(frames, outer[0].name, attr, element.shape, element.base.size, outer_limit, inner_limit, frame_limit)
    return spark.range(1).select(F.lit(-1).cast("bigint").alias("record"), F.lit(_notice(dataset)).alias("line"))


def _notice(dataset: str) -> str:
    return f"// Skipping {dataset}: only 1-d arrays of compound type or of arrays can be dumped"


def _array_members(element, prefix: str = ""):
    for name, _, part in element.members:
        if part.class_name == "COMPOUND":
            yield from _array_members(part, f"{prefix}{name}_")
        elif part.class_name == "ARRAY":
            yield f"{prefix}{name}", prod(part.shape)


def _flat_names(element, prefix: str = ""):
    """Columns in member order, array members in place."""
    for name, _, part in element.members:
        if part.class_name == "COMPOUND":
            yield from _flat_names(part, f"{prefix}{name}_")
        elif part.class_name == "ARRAY":
            yield from (f"{prefix}{name}_{i}" for i in range(prod(part.shape)))
        else:
            yield f"{prefix}{name}"


def dump_files(spark: SparkSession, path: str, pattern: str = HDF5_FILES, split_bytes: int = 16 * 1024 * 1024) -> DataFrame:
    """The text of every supported dataset of every HDF5 file of a folder, in one plan.

    Rows are ``(file, dataset, record, line)``: the ``CREATE ARRAY`` text (record -2), a
    heading or notice (-1), then one line per record or frame as ``dump_dataset`` has it.
    Datasets of any schema go through the same stages: the catalogue gives rows of datasets,
    a stage cuts them into ranges of slabs by their headers, and the tasks that read a range
    format it by the type descriptor they find there.  A null value is an empty text.
    ``write_dump`` keeps the order; nothing is sorted here.
    """
    ship_package(spark)
    listed = hdf5_catalog(spark, path, pattern).where("supported")
    titles = array_ddl(listed).select("file", F.col("path").alias("dataset"), F.lit(DDL_LINE).cast("bigint").alias("record"), F.col("ddl").alias("line"))
    options = {"splitbytes": str(split_bytes)}

    def plan(batches):
        for batch in batches:
            for file, dataset in zip(batch.column("file").to_pylist(), batch.column("path").to_pylist(), strict=True):
                with RangedFile(file) as opened:
                    size = opened.size
                parts = max(1, parts_of_file("hdf5_array", file, size, {**options, "dataset": dataset}))
                n = [parts] * parts
                yield pa.RecordBatch.from_pydict({"file": [file] * parts, "dataset": [dataset] * parts, "part": list(range(parts)), "parts": n})

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for records, lines in _split_lines(row["file"], row["dataset"], row["part"], row["parts"]):
                    same = [[row[c]] * len(lines) for c in ("file", "dataset")]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, same), pa.array(records, pa.int64()), pa.array(lines, pa.string())], ["file", "dataset", "record", "line"])

    tasks = task_count(spark)
    splits = listed.select("file", "path").repartition(tasks).mapInArrow(plan, "file string, dataset string, part bigint, parts bigint")
    values = splits.repartition(tasks).mapInArrow(read, "file string, dataset string, record bigint, line string")
    return titles.unionByName(values)


def write_dump(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The lines of ``dump_files`` as text files; read by name they give the whole text, file
    after file and dataset after dataset.  Long datasets are ranges of several text files."""
    order = ["file", "dataset", "record"]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select(F.col("line").alias("value")).write.mode(mode).text(path)


def _split_lines(file: str, dataset: str, part: int, parts: int):
    """Record numbers and lines of one range of a dataset's slabs, in bounded batches."""
    with RangedFile(file) as opened:
        array = Hdf5Dataset(opened, {"dataset": dataset})
        outer = [d for d in array.schema.dims if not d.inside]
        kind = array.element.class_name
        if len(outer) != 1 or kind not in ("COMPOUND", "ARRAY"):
            if not part:
                yield [HEADING_LINE], [_notice(dataset)]
            return
        if kind == "COMPOUND":
            if not part:
                yield [HEADING_LINE], [f"Data for {dataset}"]
            for batch in read_array(array, file, part, parts, {"dataset": dataset}):
                numbers = batch.column(0).to_pylist()
                texts = [_texts(batch.column(name), element) for name, element in array.parts]
                yield numbers, [f"#{n}: {{{', '.join(row)}}}" for n, *row in zip(numbers, *texts, strict=True)]
            return
        cells, element = prod(array.element.shape), array.element.base
        shape = ", ".join(map(str, array.element.shape))
        for batch in read_array(array, file, part, parts, {"dataset": dataset, "layout": "slabs"}):
            for first, values in zip(batch.column(f"origin_{outer[0].name}").to_pylist(), batch.column(array.columns[0][0]), strict=True):
                texts = _texts(values.values, element)
                frames = range(len(texts) // cells)
                head = f"{{array [{shape}], {cells * element.size}}} is "
                yield [first + i for i in frames], [f"{first + i}: {head}{' '.join(texts[i * cells : (i + 1) * cells])}" for i in frames]


def _texts(values: pa.Array, element) -> list[str]:
    """Values as text: numbers in six digits, quoted strings, members and items in a row."""
    kind = element.class_name
    if kind == "COMPOUND":
        members = [_texts(values.field(name), part) for name, _, part in element.members]
        return [", ".join(row) for row in zip(*members, strict=True)]
    if kind == "ARRAY":
        texts, ends = _texts(values.values, element.base), values.offsets.to_pylist()
        return [", ".join(texts[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
    if kind == "VLEN" and not element.variable_string:
        texts, ends = _texts(values.values, element.base), values.offsets.to_pylist()
        return [f"[{', '.join(texts[a:b])}]" for a, b in zip(ends, ends[1:], strict=False)]
    if kind == "FLOAT":
        return ["" if v is None else f"{v:g}" for v in values.to_pylist()]
    quoted = kind in ("STRING", "VLEN")
    return ["" if v is None else f'"{v}"' if quoted else str(v) for v in values.to_pylist()]
