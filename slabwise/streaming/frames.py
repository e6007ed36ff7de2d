"""New frames as they arrive: file streams, windows and stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from slabwise.schema import ArraySchema
from slabwise.sources.scan import FORMATS, register, scan_listed

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _stream_files(spark: SparkSession, folder: str, pattern: str, max_files: int | None) -> DataFrame:
    """Paths and sizes of files as they appear; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("pathGlobFilter", pattern).load(folder).select("path", "length")


def any_suffix(form: str) -> str:
    """A glob of the suffixes that batch scans read, in small or capital letters."""
    return "*{" + ",".join(x for s in FORMATS[form].suffixes for x in (s, s.upper())) + "}"


def scan_stream(
    spark: SparkSession, folder: str, form: str, pattern: str | None, options: dict,
    schema: ArraySchema | None = None, max_files: int | None = None,
) -> DataFrame:
    """Cells of every new file, decoded split by split on the executors.

    With ``schema`` the folder may still be empty; otherwise the first file there gives the
    columns.  ``max_files`` bounds the files of one batch.
    """
    files = _stream_files(spark, folder, pattern or any_suffix(form), max_files)
    return scan_listed(files, form, folder, options, schema)


def follow_hdf5(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """A stream of the frames appended to one extendable dataset."""
    register(spark)
    return spark.readStream.format("hdf5_array").option("dataset", dataset).load(path)


def _start(frames: DataFrame, target: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = frames.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(target)


def ingest_fits(
    spark: SparkSession, folder: str, target: str, checkpoint: str, hdu: int = 0,
    pattern: str | None = None, trigger: dict | None = None, schema: ArraySchema | None = None,
    max_files: int | None = None, **options,
) -> StreamingQuery:
    """Append the cells of every new FITS file to a stored array.

    The file log of the checkpoint makes each file count once, also after a
    restart.  The default trigger takes what is there and stops.
    """
    cells = scan_stream(spark, folder, "fits_image", pattern, {"hdu": hdu, **options}, schema, max_files)
    return _start(cells, target, checkpoint, trigger)


def ingest_hdf5(
    spark: SparkSession, folder: str, target: str, checkpoint: str, dataset: str,
    pattern: str | None = None, trigger: dict | None = None, schema: ArraySchema | None = None,
    max_files: int | None = None, **options,
) -> StreamingQuery:
    """The same for one dataset of every new HDF5 file."""
    cells = scan_stream(spark, folder, "hdf5_array", pattern, {"dataset": dataset, **options}, schema, max_files)
    return _start(cells, target, checkpoint, trigger)


def ingest_frames(
    spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append new Parquet frames or slabs to a stored array."""
    frames = spark.readStream.schema(schema).parquet(source)
    return _start(frames, target, checkpoint, trigger)


def window_stats(frames: DataFrame, time: str, attr: str, width: str, by: list[str] | None = None) -> DataFrame:
    """Count, mean and deviation per tumbling window, batch or stream."""
    stats = frames.groupBy(F.window(time, width).alias("_w"), *(by or [])).agg(
        F.count(F.lit(1)).alias("frames"),
        F.avg(attr).alias("avg"),
        F.stddev_samp(attr).alias("stdev"),
    )
    return stats.select(F.col("_w.start").alias("start"), *(by or []), "frames", "avg", "stdev")


def window_stats_stream(
    frames: DataFrame, time: str, attr: str, width: str, late: str, by: list[str] | None = None
) -> DataFrame:
    """The same with a watermark: state is dropped once a window can get no more frames.

    Watermarks need instants, so a zone-less time is read in the session zone.
    """
    timed = frames.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return window_stats(timed, time, attr, width, by)
