"""Catalogues of array files: one row per object, unit or header card.

Spark lists the files (path column of ``binaryFile``, no content is read) and
every task reads only the headers of its own files.
"""

from __future__ import annotations

from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from slabwise.schema import UNLIMITED, UnsupportedType
from slabwise.session import ship_package, task_count
from slabwise.sources.files import RangedFile
from slabwise.sources.fits import units
from slabwise.sources.hdf5 import KNOWN_FILTERS, Hdf5File, describe

# The suffixes that the scans read, in either case.
FITS_FILES = "*.{fits,fit,fts,FITS,FIT,FTS}"
HDF5_FILES = "*.{h5,hdf5,hdf,he5,H5,HDF5,HDF,HE5}"
BATCH_ROWS = 4096
# Symbol nodes of an HDF5 group that are one unit of work (eight members each as a rule), and
# the levels of a file whose groups are cut into such units; a unit of the last one is walked whole.
PAGE_NODES = 32
PAGED_LEVELS = 3

HDF5_SCHEMA = (
    "file string, path string, kind string, class string, supported boolean, "
    "attrs array<struct<name:string,type:string,ddl_type:string,bytes:bigint>>, "
    "dims array<struct<name:string,size:bigint,limit:bigint,chunk:bigint,inside:boolean>>"
)
# A page of a group that is still to be listed: its symbol nodes, and the B-trees above it.
PAGE = "heap bigint, nodes array<bigint>, above array<bigint>"
FITS_SCHEMA = (
    "file string, hdu bigint, kind string, bitpix bigint, value_type string, bytes bigint, "
    "scale double, zero double, dims array<bigint>, pcount bigint, gcount bigint, "
    "footprint bigint, listing string"
)
HEADER_SCHEMA = "file string, hdu bigint, position bigint, key string, value string, comment string"


def _batched(rows, schema):
    """Rows of a generator as Arrow batches of bounded size."""
    while held := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def list_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``(path, length)`` of the files of a folder, at any depth."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def _per_file(files: DataFrame, rows_of, schema: str) -> DataFrame:
    """Run a header reader over the files of each task, in bounded batches."""
    ship_package(files.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches):
        paths = (path for batch in batches for path in batch.column(0).to_pylist())
        yield from _batched((row for path in paths for row in opened(path)), arrow)

    def opened(path):
        with RangedFile(path) as file:
            yield from rows_of(path, file)

    # Header reads wait on storage, so files are spread evenly, not by size.
    spread = files.select("path").repartition(task_count(files.sparkSession), "path")
    return spread.mapInArrow(read, schema)


def hdf5_catalog(spark: SparkSession, path: str, pattern: str = HDF5_FILES) -> DataFrame:
    """Every group and dataset of every HDF5 file of a folder.

    The unit of work is a page of a group: some leaves of its index.  A stage turns pages
    into the rows of their members, and groups among these into pages for the next stage, so
    neither a vast file nor a flat group of very many datasets is one task.
    """
    columns = f"{HDF5_SCHEMA}, {PAGE}"
    rows = _per_file(list_files(spark, path, pattern), _root_rows, columns)
    arrow = to_arrow_schema(StructType.fromDDL(columns))
    for level in range(PAGED_LEVELS):
        rows = rows.repartition(task_count(spark)).mapInArrow(_expanded(level == PAGED_LEVELS - 1, arrow), columns)
    return rows.drop("heap", "nodes", "above")


def _page_rows(path: str, name: str, h5: Hdf5File, head, above: list[int]):
    """The pages of a group, but for a link back to a group of its own branch."""
    if getattr(head, "group", None) and head.group[0] not in above:
        tree, heap = head.group
        for nodes in h5.pages(tree, PAGE_NODES):
            yield {"file": path, "path": name, "heap": heap, "nodes": nodes, "above": [*above, tree]}


def _root_rows(path: str, file: RangedFile):
    h5 = Hdf5File(file)
    head = h5.header(h5.root)
    yield _hdf5_row(path, "/", head)
    yield from _page_rows(path, "", h5, head, [])


def _expanded(whole: bool, arrow):
    """Rows that are ready as they are, pages as the rows of their members (and all below them)."""

    def members(row: dict, h5: Hdf5File):
        for name, address in h5.members(row["heap"], row["nodes"]):
            here = f"{row['path']}/{name}"
            try:
                head = h5.header(address)
            except UnsupportedType as error:
                head = error
            yield _hdf5_row(row["file"], here, head)
            yield from _page_rows(row["file"], here, h5, head, row["above"])

    def listed(row: dict, h5: Hdf5File):
        """Depth first with an explicit stack, which holds one branch and never the whole tree."""
        stack = [members(row, h5)]
        while stack:
            found = next(stack[-1], None)
            if found is None:
                stack.pop()
            elif whole and found.get("nodes"):
                stack.append(members(found, h5))
            else:
                yield found

    def all_rows(batches):
        name, file, h5 = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["nodes"] is None:
                    yield row
                    continue
                if row["file"] != name:
                    if file:
                        file.close()
                    name, file = row["file"], RangedFile(row["file"])
                    h5 = Hdf5File(file)
                yield from listed(row, h5)
        if file:
            file.close()

    return lambda batches: _batched(all_rows(batches), arrow)


def _hdf5_row(path: str, name: str, head) -> dict:
    row = {"file": path, "path": name, "kind": "other", "class": None, "supported": False, "attrs": None, "dims": None}
    if isinstance(head, UnsupportedType):
        return row
    row["kind"] = head.kind
    if head.kind != "dataset":
        return row
    row["class"] = head.element.class_name
    try:
        schema = describe(name, head)
        head.element.spark()
    except UnsupportedType:
        return row
    row["supported"] = KNOWN_FILTERS.issuperset(head.filters)
    row["attrs"] = [
        {"name": n, "type": t.type_name, "ddl_type": t.ddl_name, "bytes": t.size} for n, t in _leaf_types(head.element)
    ]
    row["dims"] = [
        {
            "name": d.name,
            "size": d.size,
            "limit": None if d.limit is not None and d.limit >= UNLIMITED else d.limit or d.size,
            "chunk": d.step,
            "inside": d.inside,
        }
        for d in schema.dims
    ]
    return row


def _leaf_types(element, prefix: str = ""):
    """Flat attribute list: nested members as ``parent_child``, array members as ``m_i``."""
    kind = element.class_name
    if kind != "COMPOUND":
        return [("", element.base if kind == "ARRAY" else element)]
    out = []
    for name, _, part in element.members:
        full = f"{prefix}{name}"
        if part.class_name == "COMPOUND":
            out += _leaf_types(part, f"{full}_")
        elif part.class_name == "VLEN" and part.base.class_name == "COMPOUND":
            out += _leaf_types(part.base, "" if len(element.members) == 1 else f"{full}_")
        elif part.class_name == "ARRAY":
            count = part.size // part.base.size
            out += [(f"{full}_{i}", part.base) for i in range(count)]
        else:
            out.append((full, part))
    return out


def fits_catalog(spark: SparkSession, path: str, pattern: str = FITS_FILES, max_units: int | None = None) -> DataFrame:
    """The units of every FITS file (or the first ``max_units``), with shape, value type and footprint."""
    def rows(name, file):
        return _fits_rows(name, file, max_units)

    return _per_file(list_files(spark, path, pattern), rows, FITS_SCHEMA)


def _fits_rows(path: str, file: RangedFile, max_units: int | None):
    for unit in units(file, max_units):
        image = unit.kind == "IMAGE" and bool(unit.axes)
        kind = unit.value_type if image else None
        listing = f"HDU ({unit.number}) (no array)"
        if image:
            size = abs(unit.bitpix) // 8
            word = "float" if unit.bitpix < 0 else ("uint" if kind.startswith("u") else "int")
            dims = "".join(f"{n}, " for n in unit.axes)
            listing = (
                f"HDU ({unit.number}) {size}-byte {word}(scale={unit.scale:g}) "
                f"array in dims: {dims}  footprint={unit.footprint}"
            )
        yield {
            "file": path,
            "hdu": unit.number,
            "kind": unit.kind,
            "bitpix": unit.bitpix,
            "value_type": kind,
            "bytes": abs(unit.bitpix) // 8,
            "scale": unit.scale,
            "zero": unit.zero,
            "dims": unit.axes,
            "pcount": unit.pcount,
            "gcount": unit.gcount,
            "footprint": unit.footprint,
            "listing": listing,
        }


def fits_header(spark: SparkSession, path: str, pattern: str = FITS_FILES, hdu: int | None = 0) -> DataFrame:
    """Header cards of one unit (default: the primary one) or, with ``None``, of all."""
    def rows(name, file):
        for unit in units(file, None if hdu is None else hdu + 1):
            if hdu is None or unit.number == hdu:
                for position, (key, value, comment) in enumerate(unit.cards):
                    yield {"file": name, "hdu": unit.number, "position": position, "key": key,
                           "value": value, "comment": comment}

    return _per_file(list_files(spark, path, pattern), rows, HEADER_SCHEMA)
