"""Joining sibling datasets on their shared frame index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def align_frames(frames: list[DataFrame], dim: str, how: str = "inner") -> DataFrame:
    """Equi-join of datasets on the frame coordinate.

    No broadcast is forced: Catalyst broadcasts a side only below its measured
    size threshold, and adaptive execution splits partitions that turn out hot.
    Slice and aggregate each side before aligning; image cells join best as one
    row per frame.
    """
    return reduce(lambda left, right: left.join(right, dim, how), frames)


def align_asof(left: DataFrame, right: DataFrame, time: str, bucket: str | int, by: list[str] | None = None) -> DataFrame:
    """Every row of ``left`` with the newest row of ``right`` that is not later, per ``by``.

    ``left`` and ``right`` have the columns ``time`` and ``by``; the others of ``right`` come
    as a struct ``found``, with its time, or null if there is none.  Of several rows of
    ``right`` with one time the largest (as a struct) counts.  ``bucket`` is a width: an
    interval like ``"1 hour"`` for instants, a number for numbers.

    Rows meet in buckets of time, so one busy ``by`` is many tasks; a running last row goes
    from bucket to bucket and is all that crosses their borders.  Nothing is joined by range.
    Rows of ``left`` without a time find nothing; those of ``right`` without one are nobody's.
    """
    by = by or []
    at: Column = F.window(time, bucket)["start"] if isinstance(bucket, str) else F.floor(F.col(time) / bucket)
    payload = F.struct(F.col(time), *[F.col(c) for c in right.columns if c != time and c not in by])
    none = F.lit(None).cast(right.select(payload.alias("x")).schema["x"].dataType)
    own = F.struct(*[F.col(c) for c in left.columns])
    lefts = left.where(F.col(time).isNotNull()).select(*by, F.col(time).alias("_time"), at.alias("_bucket"), F.lit(1).alias("_side"), own.alias("_row"), none.alias("_found"))
    empty = F.lit(None).cast(lefts.schema["_row"].dataType)
    rights = right.where(F.col(time).isNotNull()).select(*by, F.col(time).alias("_time"), at.alias("_bucket"), F.lit(0).alias("_side"), empty.alias("_row"), payload.alias("_found"))

    ends = rights.groupBy(*by, "_bucket").agg(F.max("_found").alias("_last"))
    touched = lefts.select(*by, "_bucket").distinct().withColumn("_last", none).unionByName(ends).groupBy(*by, "_bucket").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = touched.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).drop("_last")

    # At one time rows of the right come first, the largest last.
    order = Window.partitionBy(*by, "_bucket").orderBy("_time", "_side", "_found").rowsBetween(Window.unboundedPreceding, 0)
    met = lefts.unionByName(rights).withColumn("_here", F.last("_found", ignorenulls=True).over(order)).where("_side = 1")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, "_bucket"]]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    joined = met.alias("l").join(carried.alias("r"), condition, "left").select("l._row", F.coalesce("l._here", "r._carried").alias("found"))
    timeless = left.where(F.col(time).isNull()).select(own.alias("_row"), none.alias("found"))
    return joined.unionByName(timeless).select("_row.*", "found")
