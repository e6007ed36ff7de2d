"""Counting, slicing and statistics.  ``embeddings`` is read as 8x8 frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabwise.operators import (
    avg_all,
    count_cells,
    first_n_elements,
    stats_by_dim,
    stdev_by_dim,
    subarray,
    unroll,
)
from slabwise.plans.registry import query, rounded, table
from slabwise.schema import ArraySchema, Attr, Dim

FRAME = (8, 8)

# One row per cell of the 3-D view.
CELLS_SQL = """
    SELECT vec_id AS unnamed0, p // 8 AS unnamed1, p % 8 AS unnamed2, v::DOUBLE AS value
    FROM (SELECT vec_id, unnest(range(len(embedding))) AS p, unnest(embedding) AS v FROM embeddings)
"""


def frames(spark, sf_dir):
    """One row per frame: ``unnamed0`` and its 64 values."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("unnamed0"), F.col("embedding").alias("value")
    )


def cells(spark, sf_dir, lo=None, hi=None):
    """One row per cell ``(unnamed0, unnamed1, unnamed2, value)``, values as doubles."""
    flat = unroll(frames(spark, sf_dir), ["unnamed0"], "value", FRAME, "value", lo=lo, hi=hi)
    return flat.withColumn("value", F.col("value").cast("double"))


def frame_schema(spark, sf_dir) -> ArraySchema:
    """Description of the 3-D view; the frame count comes from Parquet statistics."""
    top = frames(spark, sf_dir).agg(F.max("unnamed0")).first()[0]
    dims = (Dim("unnamed0", top + 1), Dim("unnamed1", 8, inside=True), Dim("unnamed2", 8, inside=True))
    return ArraySchema("image", (Attr("value", "float"),), dims).planned()


@query("count_cells", f"SELECT count(*) AS count FROM ({CELLS_SQL})")
def _count_cells(spark, sf_dir):
    return count_cells(cells(spark, sf_dir))


@query("avg_all", f"SELECT round(avg(value), 6) AS avg FROM ({CELLS_SQL})")
def _avg_all(spark, sf_dir):
    return rounded(avg_all(cells(spark, sf_dir), "value"), "avg")


@query(
    "subarray",
    f"""
    SELECT unnamed0, unnamed1 - 1 AS unnamed1, unnamed2 - 2 AS unnamed2, value FROM ({CELLS_SQL})
    WHERE unnamed1 BETWEEN 1 AND 6 AND unnamed2 BETWEEN 2 AND 5
    """,
)
def _subarray(spark, sf_dir):
    dims = ["unnamed0", "unnamed1", "unnamed2"]
    return subarray(cells(spark, sf_dir), dims, (None, 1, 2), (None, 6, 5), rebase=True)


@query(
    "stdev_by_dim",
    f"""
    SELECT unnamed1, unnamed2, round(stddev_samp(value), 6) AS stdev FROM ({CELLS_SQL})
    GROUP BY unnamed1, unnamed2
    """,
)
def _stdev_by_dim(spark, sf_dir):
    return rounded(stdev_by_dim(cells(spark, sf_dir), ["unnamed1", "unnamed2"], "value"), "stdev")


@query(
    "stats_by_dim",
    f"""
    SELECT unnamed0, count(value) AS count, round(avg(value), 6) AS avg,
           round(stddev_samp(value), 6) AS stdev, min(value) AS min, max(value) AS max
    FROM ({CELLS_SQL}) GROUP BY unnamed0
    """,
)
def _stats_by_dim(spark, sf_dir):
    return rounded(stats_by_dim(cells(spark, sf_dir), ["unnamed0"], "value"), "avg", "stdev")


@query(
    "subarray_stdev",
    f"""
    SELECT unnamed0, round(stddev_samp(value), 6) AS stdev FROM ({CELLS_SQL})
    WHERE unnamed1 BETWEEN 0 AND 3 AND unnamed2 BETWEEN 1 AND 6 GROUP BY unnamed0
    """,
)
def subarray_stdev(spark, sf_dir):
    """The flagship: deviation per frame over a window of every frame."""
    window = cells(spark, sf_dir, lo=(0, 1), hi=(3, 6))
    return rounded(stdev_by_dim(window, ["unnamed0"], "value"), "stdev")


@query(
    "first_n_elements",
    f"SELECT * FROM ({CELLS_SQL}) WHERE unnamed0 * 64 + unnamed1 * 8 + unnamed2 < 1000",
)
def _first_n_elements(spark, sf_dir):
    return first_n_elements(cells(spark, sf_dir), frame_schema(spark, sf_dir), 1000)
