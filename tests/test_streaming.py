import numpy as np
from pyspark.sql import functions as F

from slabwise.plans import fits_bytes, hdf5_bytes as h5
from slabwise import ArraySchema, Attr, Dim
from slabwise.streaming import follow_hdf5, ingest_fits, ingest_frames, ingest_hdf5, window_stats, window_stats_stream

SF_DIR = "/root/testdata/sf0.001"


def test_fits_ingest_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        ingest_fits(spark, str(source), target, state).awaitTermination()
        return spark.read.parquet(target)

    first = np.arange(12, dtype="i4").reshape(3, 4)
    (source / "a.fits").write_bytes(fits_bytes.image(first, 32, first=True))
    assert run().agg(F.count("*"), F.sum("unknown")).first() == (12, 66)
    assert run().count() == 12  # nothing new: a restart adds nothing
    (source / "b.fits").write_bytes(fits_bytes.image(first + 100, 32, first=True))
    cells = run()
    assert cells.count() == 24
    got = {(r.source_path[-6:], r.dim0, r.dim1): r.unknown for r in cells.collect()}
    assert got[("b.fits", 3, 2)] == 111 and got[("a.fits", 0, 1)] == 4


def test_hdf5_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(3):
        file = h5.FileBuilder()
        file.dataset("/x", h5.int_type(4), (10,), np.full(10, n, "<i4"), chunk=(4,), limits=(None,))
        (source / f"{n}.h5").write_bytes(file.build())
    ingest_hdf5(spark, str(source), str(tmp_path / "out"), str(tmp_path / "s"), "/x").awaitTermination()
    cells = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, cells.groupBy("int1").count().collect())) == [(0, 10), (1, 10), (2, 10)]


def test_growing_dataset_gives_each_frame_once(spark, tmp_path):
    path, target = tmp_path / "grow.h5", str(tmp_path / "out")

    def grow(frames):
        data = np.arange(frames * 6, dtype="<i4").reshape(frames, 2, 3)
        file = h5.FileBuilder()
        file.dataset("/image", h5.array_type((2, 3), h5.int_type(4)), (frames,), data, limits=(None,), chunk=(4,))
        path.write_bytes(file.build())

    def run():
        query = (
            follow_hdf5(spark, str(path), "/image").writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(target)
        )
        query.awaitTermination()
        return spark.read.parquet(target)

    grow(5)
    assert run().agg(F.count("*"), F.max("unnamed0")).first() == (30, 4)
    assert run().count() == 30
    grow(11)
    cells = run().collect()
    assert sorted((r.unnamed0 * 6 + r.unnamed1 * 3 + r.unnamed2, r.int1) for r in cells) == [(i, i) for i in range(66)]


def test_frame_ingest_and_stream_windows_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    source = str(tmp_path / "events")
    # Time-ordered files, one per trigger, as a growing dataset would arrive.
    for part in range(4):
        events.where(F.col("event_id").between(part * 250, part * 250 + 249)).coalesce(1).write.mode("append").parquet(source)
    target = str(tmp_path / "kept")
    ingest_frames(spark, source, events.schema, target, str(tmp_path / "k")).awaitTermination()
    assert sorted(spark.read.parquet(target).collect()) == sorted(events.collect())

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    windows = window_stats_stream(stream, "ts", "value", "1 hour", "2 hours", ["event_type"])
    out = str(tmp_path / "windows")
    running = (
        windows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "w")).trigger(availableNow=True).start(out)
    )
    running.awaitTermination()
    closed = spark.read.parquet(out)
    instants = events.withColumn("ts", F.col("ts").cast("timestamp"))
    batch = window_stats(instants, "ts", "value", "1 hour", ["event_type"])
    last = closed.agg(F.max("start")).first()[0]
    assert last is not None
    key = lambda r: (r.start, r.event_type, r.frames, round(r.avg, 6), r.stdev and round(r.stdev, 6))
    expected = sorted(map(key, batch.where(F.col("start") <= F.lit(last)).collect()), key=str)
    assert sorted(map(key, closed.collect()), key=str) == expected
    # Only windows behind the watermark are out; the rest is still open.
    assert closed.count() < batch.count()


def test_streams_start_on_an_empty_folder_and_go_on(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = ArraySchema("sky", (Attr("unknown", "int32"),), (Dim("dim0", 4), Dim("dim1", 3)))
    options = {"schema": schema, "max_files": 2}

    def run():
        ingest_fits(spark, str(source), str(tmp_path / "out"), str(tmp_path / "state"), **options).awaitTermination()
        return spark.read.schema("dim0 long, dim1 long, unknown int, source_path string").parquet(str(tmp_path / "out"))

    assert run().count() == 0
    frame = np.arange(12, dtype="i4").reshape(3, 4)
    for n, suffix in enumerate(("fits", "fit", "FTS", "fits", "txt")):  # the suffixes that batch scans read
        (source / f"{n}.{suffix}").write_bytes(fits_bytes.image(frame + 100 * n, 32, first=True))
    cells = run()
    assert cells.agg(F.count("*"), F.countDistinct("source_path"), F.max("unknown")).first() == (48, 4, 311)
    assert cells.where("unknown = 311").select("dim0", "dim1").first() == (3, 2)
    assert run().count() == 48

    h5_source = tmp_path / "h5"
    h5_source.mkdir()
    pair = ArraySchema("x", (Attr("int1", "int32"),), (Dim("unnamed0", 10),))
    ingest_hdf5(spark, str(h5_source), str(tmp_path / "out5"), str(tmp_path / "s5"), "/x", schema=pair).awaitTermination()
    file = h5.FileBuilder()
    file.dataset("/x", h5.int_type(4), (10,), np.arange(10, dtype="<i4"), chunk=(4,), limits=(None,))
    (h5_source / "a.hdf5").write_bytes(file.build())
    ingest_hdf5(spark, str(h5_source), str(tmp_path / "out5"), str(tmp_path / "s5"), "/x", schema=pair).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out5")).agg(F.sum("int1"), F.count("*")).first() == (45, 10)
