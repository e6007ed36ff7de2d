"""Array files derived from the given tables by Spark jobs.

No array files are shipped, so the file queries first export a table: each task
writes whole files for runs of consecutive keys, streaming its sorted rows.  A
file is bounded by its number of keys and keys are checked to be dense, so no
task ever holds more than one file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slabwise.functions.coords import integer_div
from slabwise.plans import fits_bytes, hdf5_bytes as h5
from slabwise.schema import ArrayError
from slabwise.session import scratch_dir, ship_package
from slabwise.sources.files import write_atomic

FRAME = (8, 8)
# Keys per file: an eighth of the table, within these bounds.
FRAMES_PER_FILE = (64, 262_144)
RECORDS_PER_FILE = (250, 1_048_576)
FRAMES_PER_CHUNK = 20
KINDS = {"ECONOMY": 0, "SMALL": 1, "MEDIUM": 2, "LARGE": 3, "STANDARD": 4, "PROMO": 5, "OTHER": 6}

_written: dict[tuple, tuple[str, int]] = {}


def per_file(total: int, bounds: tuple[int, int]) -> int:
    return min(bounds[1], max(bounds[0], -(-total // 8)))


def export_files(df: DataFrame, key: str, name: str, size: int, total: int, folder: str, build) -> None:
    """Write ``<name>-<number>`` files of ``size`` consecutive keys each.

    ``build(table)`` turns the sorted rows of one file into its bytes.  The
    manifest table is the action; files have fixed names and appear by rename,
    so a retried task repeats itself harmlessly.
    """
    ship_package(df.sparkSession)
    stem, suffix = name.rsplit(".", 1)

    def write(batches):
        block, held, rows = None, [], 0
        for batch in batches:
            numbers = batch.column("_block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if block is not None and numbers[a] != block:
                    yield flush(block, held)
                    held, rows = [], 0
                block, rows = int(numbers[a]), rows + b - a
                if rows > size:
                    raise ArrayError(f"{name}: more than {size} rows in block {block}, keys repeat")
                held.append(batch.slice(a, b - a))
        if block is not None:
            yield flush(block, held)

    def flush(block, held):
        table = pa.Table.from_batches(held).combine_chunks()
        start = block * size
        expected = np.arange(start, min(start + size, total))
        if not np.array_equal(table.column(key).to_numpy(), expected):
            raise ArrayError(f"{name}: keys of block {block} are not dense")
        path = f"{folder}/{stem}-{block:06d}.{suffix}"
        write_atomic(path, [build(table)])
        return pa.RecordBatch.from_pylist([{"file": path, "rows": table.num_rows}])

    blocked = df.withColumn("_block", integer_div(F.col(key), size))
    placed = blocked.repartition("_block").sortWithinPartitions("_block", key)
    placed.mapInArrow(write, "file string, rows bigint").write.parquet(f"{folder}/_manifest")


def _frames_of(table: pa.Table, column: str) -> np.ndarray:
    values = table.column(column).combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.astype("f4").reshape(len(values), -1)


def _fits_file(table: pa.Table) -> bytes:
    label = table.column("label").to_numpy().astype("i4")
    if len(label) and not 0 <= label.min() <= label.max() < 1 << 15:
        raise ArrayError("label does not fit both 16-bit images")
    return (
        fits_bytes.primary()
        + fits_bytes.image(_frames_of(table, "embedding"), -32)
        + fits_bytes.image(label - 32768, 16, [("BSCALE", 1.0), ("BZERO", 32768.0)])
        + fits_bytes.image(label, 16, [("BSCALE", 0.5), ("BZERO", 10.0)])
    )


def _frame_file(table: pa.Table) -> bytes:
    file = h5.FileBuilder()
    frames, labels = _frames_of(table, "embedding"), table.column("label").to_numpy()
    kind = h5.array_type(FRAME, h5.float_type(4))
    file.dataset(
        "/Run:0000/Cam.0/image", kind, (len(frames),), frames.astype("<f4"), limits=(None,),
        chunk=(FRAMES_PER_CHUNK,), shuffle=True, deflate=True,
    )
    file.dataset("/Run:0000/Cam.0/label", h5.int_type(4, big=True), (len(frames),), labels.astype(">i4"))
    return file.build()


PART_LAYOUT = np.dtype(
    {
        "names": ["p_partkey", "p_size", "p_retailprice", "p_brand", "p_kind"],
        "formats": ["<i8", "<u2", "<f8", "S12", "u1"],
        "offsets": [0, 8, 16, 24, 36],
        "itemsize": 40,
    }
)


def _part_file(table: pa.Table) -> bytes:
    rows = np.zeros(table.num_rows, PART_LAYOUT)
    for name in ("p_partkey", "p_size", "p_retailprice"):
        rows[name] = table.column(name).to_numpy()
    brands = [b.encode() for b in table.column("p_brand").to_pylist()]
    if max(map(len, brands), default=0) > PART_LAYOUT["p_brand"].itemsize:
        raise ArrayError(f"p_brand has more than {PART_LAYOUT['p_brand'].itemsize} bytes")
    rows["p_brand"] = brands
    rows["p_kind"] = [KINDS.get(t, KINDS["OTHER"]) for t in table.column("p_type").to_pylist()]
    messages = {
        "p_partkey": h5.int_type(8),
        "p_size": h5.int_type(2, signed=False),
        "p_retailprice": h5.float_type(8),
        "p_brand": h5.string_type(12, padding=0),
        "p_kind": h5.enum_type(h5.int_type(1, signed=False), KINDS),
    }
    members = [(n, PART_LAYOUT.fields[n][1], m) for n, m in messages.items()]
    file = h5.FileBuilder()
    file.dataset("/store/part", h5.compound_type(40, members), (len(rows),), rows)
    return file.build()


def _export(spark: SparkSession, sf_dir: str, kind: str) -> tuple[str, int]:
    """Folder of a table's files and keys per file; written once per session."""
    done = (spark.sparkContext.applicationId, sf_dir, kind)
    if done in _written:
        return _written[done]
    table, key, columns, bounds, name, build = {
        "fits": ("embeddings", "vec_id", ["embedding", "label"], FRAMES_PER_FILE, "sky.fits", _fits_file),
        "frames": ("embeddings", "vec_id", ["embedding", "label"], FRAMES_PER_FILE, "frames.h5", _frame_file),
        "parts": (
            "part", "p_partkey", ["p_size", "p_retailprice", "p_brand", "p_type"], RECORDS_PER_FILE,
            "parts.h5", _part_file,
        ),
    }[kind]
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key, *columns)
    total = rows.agg(F.max(key)).first()[0] + 1
    size, folder = per_file(total, bounds), scratch_dir(spark, kind)
    export_files(rows, key, name, size, total, folder, build)
    _written[done] = folder, size
    return folder, size


def fits_files(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """``embeddings`` as FITS: empty primary, float image, unsigned and scaled labels."""
    return _export(spark, sf_dir, "fits")


def frame_files(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """``embeddings`` as HDF5: an extendable, compressed array of frames, and labels."""
    return _export(spark, sf_dir, "frames")


def part_files(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """``part`` as an HDF5 compound dataset with padding, an enum and fixed text."""
    return _export(spark, sf_dir, "parts")


def number_of(path) -> Column:
    """The number that ``export_files`` put into a file name."""
    return F.regexp_extract(path, r"-(\d+)\.\w+$", 1).cast("bigint")


def base_name(path) -> Column:
    return F.substring_index(path, "/", -1)
