"""Stored arrays: versions of Parquet slabs or cells, with their description.

    <path>/v00000002-5f0c.../part-*.parquet     the rows that one write added
    <path>/_versions/00000002.json              a snapshot: which folders, which description

A write puts its rows into a new folder and becomes visible with one file, its manifest,
which appears at once and only if no other writer has taken the number.  A write that
fails leaves the array as it was; readers keep the snapshot they opened, until
``vacuum_array`` removes old ones.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType

from slabwise.schema import ArrayError, ArraySchema
from slabwise.sources.files import file_system, write_new
from slabwise.sources.scan import describe_slabs, load_fits, load_hdf5

# A slab row may hold a mebibyte of cells, so the Parquet writer must look at
# its buffers after few rows; by default it first looks after a hundred.
WIDE_ROW_OPTIONS = {
    "parquet.block.size.row.check.min": "4",
    "parquet.page.size.row.check.min": "1",
}
MANIFESTS = "_versions"
MODES = ("errorifexists", "error", "overwrite", "append", "ignore")


@dataclass(frozen=True)
class Snapshot:
    """One version of a stored array: the folders that hold its rows."""

    version: int
    folders: tuple[str, ...]
    schema: ArraySchema


def _numbers(path: str) -> list[int]:
    system, inner = file_system(path)
    found = system.get_file_info(fs.FileSelector(f"{inner}/{MANIFESTS}", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[:-5].isdigit())


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{version:08d}.json"


def snapshot(path: str, version: int | None = None) -> Snapshot | None:
    """A version of a stored array, by default the newest; ``None`` if there is no array."""
    numbers = _numbers(path)
    if version is None and not numbers:
        return None
    if version is not None and version not in numbers:
        raise ArrayError(f"{path}: no version {version}; there are {', '.join(map(str, numbers)) or 'none'}")
    version = numbers[-1] if version is None else version
    system, inner = file_system(_manifest(path, version))
    with system.open_input_stream(inner) as stream:
        raw = json.loads(stream.read())
    return Snapshot(version, tuple(raw["folders"]), ArraySchema.from_json(raw["schema"]))


def array_versions(path: str) -> list[Snapshot]:
    """All versions that can still be opened, oldest first."""
    return [snapshot(path, n) for n in _numbers(path)]


def _fits(held: ArraySchema, more: ArraySchema) -> bool:
    """Whether rows of both can lie side by side: they may differ in their extents."""

    def shape_free(schema: ArraySchema) -> tuple:
        return schema.attrs, [(d.name, d.chunk) for d in schema.dims], schema.first_fastest

    return shape_free(held) == shape_free(more)


def store_array(
    df: DataFrame, path: str, schema: ArraySchema, mode: str = "errorifexists",
    partition_by: list[str] | None = None,
) -> Snapshot:
    """Keep an array as a new version.

    ``overwrite`` replaces the rows, ``append`` adds to them without touching what is there,
    ``ignore`` does nothing if there is an array already.  Of two writers that started from
    the same version one fails by name.

    Nothing is shuffled: scans and packs already leave neighbouring slabs
    together, so origin statistics stay narrow.  Use ``redistribute`` first for
    another spread, or ``partition_by`` for folders.
    """
    if mode not in MODES:
        raise ArrayError(f"unknown mode {mode}; there are {', '.join(MODES)}")
    current = snapshot(path)
    if current and mode in ("errorifexists", "error"):
        raise ArrayError(f"{path}: there is an array already, version {current.version}")
    if current and mode == "ignore":
        return current
    if current and mode == "append" and not _fits(current.schema, schema):
        raise ArrayError(f"{path}: the array there is {current.schema.show()}")
    number = current.version + 1 if current else 1
    folder = f"v{number:08d}-{uuid.uuid4().hex[:12]}"
    writer = schema.attach(df).write
    if any(isinstance(f.dataType, ArrayType) for f in df.schema.fields):
        writer = writer.options(**WIDE_ROW_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path.rstrip('/')}/{folder}")
    before = current.folders if current and mode == "append" else ()
    made = Snapshot(number, (*before, folder), schema)
    text = json.dumps({"folders": made.folders, "schema": schema.to_json()})
    try:
        write_new(_manifest(path, number), text.encode())
    except FileExistsError:
        raise ArrayError(f"{path}: another writer made version {number} meanwhile") from None
    return made


def open_array(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, ArraySchema]:
    """A stored array and its description, by default the newest version.

    A plain Parquet folder that carries a description is an array, too.
    """
    found = snapshot(path, version)
    if found is None:
        df = spark.read.parquet(path)
        return df, ArraySchema.of(df)
    return spark.read.parquet(*[f"{path.rstrip('/')}/{f}" for f in found.folders]), found.schema


def vacuum_array(path: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` versions, and the folders that only they used.

    Manifests go first, so a version that can be opened is whole.  Folders of a number that
    no manifest has yet may belong to a running write and stay.  Returns the folders removed.
    """
    if keep < 1:
        raise ArrayError("keep at least one version")
    versions = array_versions(path)
    system, inner = file_system(path.rstrip("/"))
    used = {f for s in versions[-keep:] for f in s.folders}
    for old in versions[:-keep]:
        system.delete_file(file_system(_manifest(path, old.version))[1])
    newest = versions[-1].version if versions else 0
    gone = []
    for item in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        name = item.base_name
        if item.type == fs.FileType.Directory and name.startswith("v") and name[1:9].isdigit():
            if name not in used and int(name[1:9]) <= newest:
                system.delete_dir(item.path)
                gone.append(name)
    return sorted(gone)


def store_fits(spark: SparkSession, target: str, path: str, hdu: int = 0, layout: str = "cells") -> ArraySchema:
    """Load an image unit of one file into ``target``, replacing what was there.

    The description kept with it has the chunks and the cell order of its slabs.
    """
    schema = describe_slabs("fits_image", path, {"hdu": hdu})
    store_array(load_fits(spark, path, hdu, layout=layout), target, schema, mode="overwrite")
    return schema


def store_hdf5(
    spark: SparkSession, target: str, path: str, dataset: str, layout: str = "cells", mode: str = "errorifexists"
) -> ArraySchema:
    """Load a dataset of one file and keep it under ``target``, as ``store_fits`` does."""
    schema = describe_slabs("hdf5_array", path, {"dataset": dataset})
    store_array(load_hdf5(spark, path, dataset, layout=layout), target, schema, mode=mode)
    return schema
