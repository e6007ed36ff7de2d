"""Frames in time: aligning datasets, timestamps, windows, streaming ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabwise.functions import from_wall_clock, to_wall_clock
from slabwise.operators import align_asof, align_frames
from slabwise.plans.derived_files import base_name, fits_files, number_of
from slabwise.plans.registry import query, rounded, table
from slabwise.session import scratch_dir
from slabwise.streaming.frames import ingest_fits, window_stats


@query(
    "align_frames",
    """
    SELECT vec_id AS unnamed0, list_sum(list_transform(embedding, lambda v: v::DOUBLE)).round(6) AS total,
           event_type, value, o_totalprice
    FROM embeddings JOIN events ON vec_id = event_id JOIN orders ON vec_id = o_orderkey
    """,
)
def _align_frames(spark, sf_dir):
    """Image, data and time of one frame index; images joined as one row per frame."""
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double"))
    images = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("unnamed0"), F.round(total, 6).alias("total")
    )
    data = table(spark, sf_dir, "events").select(F.col("event_id").alias("unnamed0"), "event_type", "value")
    prices = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("unnamed0"), "o_totalprice")
    return align_frames([images, data, prices], "unnamed0")


@query(
    "align_asof",
    """
    SELECT l.event_id, l.user_id, r.event_id AS found_id, r.value AS found_value,
           epoch_us(l.ts) - epoch_us(r.ts) AS age
    FROM (SELECT * FROM events WHERE event_type <> 'error') l
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') r ON l.user_id = r.user_id AND l.ts >= r.ts
    """,
)
def _align_asof(spark, sf_dir):
    """Every frame with the newest error of its user before it."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    errors = events.where("event_type = 'error'").select("user_id", "ts", "event_id", "value")
    found = align_asof(events.where("event_type <> 'error'"), errors, "ts", "6 hours", by=["user_id"])
    age = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("found.ts").cast("timestamp"))
    return found.select("event_id", "user_id", F.col("found.event_id").alias("found_id"), F.col("found.value").alias("found_value"), age.alias("age"))


@query(
    "frame_time",
    """
    SELECT event_id, epoch_us(ts) // 1000000 AS seconds, epoch_us(ts) % 1000000 * 1000 AS nanoseconds,
           ts AS back FROM events
    """,
)
def _frame_time(spark, sf_dir):
    seconds, nanoseconds = from_wall_clock(F.col("ts"))
    split = table(spark, sf_dir, "events").select(
        "event_id", seconds.alias("seconds"), nanoseconds.alias("nanoseconds")
    )
    return split.withColumn("back", to_wall_clock(F.col("seconds"), F.col("nanoseconds")))


@query(
    "frame_window_avg",
    """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS frames,
           round(avg(value), 8) AS avg, round(stddev_samp(value), 8) AS stdev
    FROM events GROUP BY 1, 2
    """,
)
def _frame_window_avg(spark, sf_dir):
    stats = window_stats(table(spark, sf_dir, "events"), "ts", "value", "1 hour", ["event_type"])
    # Means of cents have short decimal texts; eight places keep clear of ties.
    return rounded(stats, "avg", "stdev", places=8)


@query(
    "frame_stream",
    """
    SELECT vec_id AS frame, unnest(range(len(embedding))) AS dim0, unnest(embedding)::DOUBLE AS value
    FROM embeddings
    """,
)
def _frame_stream(spark, sf_dir):
    """FITS files ingested as a stream into a stored array, read back."""
    folder, size = fits_files(spark, sf_dir)
    target, state = scratch_dir(spark, "ingested"), scratch_dir(spark, "ingest-state")
    ingest_fits(spark, folder, target, state, hdu=1).awaitTermination()
    cells = spark.read.parquet(target)
    return cells.select(
        (number_of(base_name(F.col("source_path"))) * size + F.col("dim1")).alias("frame"),
        "dim0",
        F.col("unknown").cast("double").alias("value"),
    )
