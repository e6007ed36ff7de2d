"""Chunk plans, slab grids, packing and stored slabs."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabwise.functions import slab_number, slab_origin, type_bytes
from slabwise.operators import (
    array_size,
    box_stats,
    buffer_bytes,
    dense_check,
    dense_check_box,
    dim_bounds,
    first_n_slabs,
    holes,
    pack_frames,
    pack_slabs,
    redistribute,
    redistribute_by_curve,
    slab_bytes,
    slab_curve,
    slab_grid,
    stdev_by_dim,
    subarray_slabs,
    unpack_slabs,
    unroll,
    with_synopses,
)
from slabwise.plans.array_queries import CELLS_SQL, frame_schema, frames
from slabwise.plans.registry import query, rounded, table
from slabwise.schema import ArraySchema, Attr, Dim, chunk_plan_column
from slabwise.session import scratch_dir
from slabwise.sources.store import open_array, store_array

CHUNK = (100, 16)

# The 2-D view of embeddings: one row per cell, with the origin of its slab.
PLANE_SQL = """
    SELECT vec_id AS unnamed0, p AS unnamed1, v::DOUBLE AS value,
           vec_id - vec_id % 100 AS origin_unnamed0, p - p % 16 AS origin_unnamed1,
           (vec_id // 100) + (p // 16) * ((max(vec_id) OVER () + 100) // 100) AS slab_no
    FROM (SELECT vec_id, unnest(range(len(embedding))) AS p, unnest(embedding) AS v FROM embeddings)
"""

# One array per part: extents from its columns.
ARRAYS_SQL = "SELECT p_partkey AS id, p_size * 10 + 1 AS n0, p_partkey % 90 + 1 AS n1 FROM part"


def plane(spark, sf_dir):
    """Cells ``(unnamed0, unnamed1, value)`` of the 2-D view."""
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "unnamed0")
    return unroll(vectors, ["unnamed0"], "embedding", (64,), "value", dims=["unnamed1"])


def plane_schema(spark, sf_dir) -> ArraySchema:
    top = table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0]
    dims = (Dim("unnamed0", top + 1), Dim("unnamed1", 64))
    return ArraySchema("plane", (Attr("value", "float"),), dims).with_chunks(CHUNK)


def part_arrays(spark, sf_dir):
    """Catalogue rows ``(id, dims, chunks)``, one array per part."""
    extents = F.array((F.col("p_size") * 10 + 1).cast("bigint"), F.col("p_partkey") % 90 + 1)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        extents.alias("dims"),
        F.array(*[F.lit(c).cast("bigint") for c in CHUNK]).alias("chunks"),
    )


_stored: dict[tuple, str] = {}


def stored_plane(spark, sf_dir):
    """Path of the 2-D view packed and stored as slabs; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        schema, path = plane_schema(spark, sf_dir), scratch_dir(spark, "plane")
        store_array(pack_slabs(plane(spark, sf_dir), schema), path, schema)
        _stored[key] = path
    return _stored[key]


@query(
    "chunk_plan",
    """
    SELECT o_orderkey, c0, c1, c2 FROM (
        SELECT *, CASE WHEN a1 * n0 <= 1048576 THEN n0 ELSE 1 END AS c0 FROM (
            SELECT *, CASE WHEN n2 * n1 <= 1048576 THEN n1 ELSE 1 END AS c1,
                   CASE WHEN n2 * n1 <= 1048576 THEN n2 * n1 ELSE n2 END AS a1, n2 AS c2
            FROM (SELECT o_orderkey, o_orderkey % 50000 + 1 AS n0, o_custkey * 7 % 1500 + 1 AS n1,
                         o_totalprice::BIGINT % 1500 + 1 AS n2 FROM orders)))
    """,
)
def _chunk_plan(spark, sf_dir):
    dims = F.array(
        F.col("o_orderkey") % 50000 + 1,
        F.col("o_custkey") * 7 % 1500 + 1,
        F.rint("o_totalprice").cast("bigint") % 1500 + 1,
    )
    planned = table(spark, sf_dir, "orders").select("o_orderkey", chunk_plan_column(dims).alias("plan"))
    return planned.select("o_orderkey", *[F.get("plan", i).alias(f"c{i}") for i in range(3)])


@query(
    "slab_grid",
    f"""
    SELECT id, (i // 100) + (j // 16) * ((n0 + 99) // 100) AS slab_no, i AS origin_0, j AS origin_1,
           least(100, n0 - i) * least(16, n1 - j) AS cells
    FROM (SELECT *, unnest(range(0, n1, 16)) AS j
          FROM (SELECT *, unnest(range(0, n0, 100)) AS i FROM ({ARRAYS_SQL})))
    """,
)
def _slab_grid(spark, sf_dir):
    return slab_grid(part_arrays(spark, sf_dir), 2)


@query(
    "slab_cells",
    f"""
    SELECT slab_no, origin_unnamed0 AS origin_0, origin_unnamed1 AS origin_1, count(*) AS cells
    FROM ({PLANE_SQL}) GROUP BY ALL
    """,
)
def _slab_cells(spark, sf_dir):
    """Clipped slab sizes from the extents; the SQL counts the actual cells."""
    box = table(spark, sf_dir, "embeddings").agg(
        F.max("vec_id").alias("top"), F.max(F.size("embedding")).cast("bigint").alias("width")
    )
    arrays = box.select(
        F.array(F.col("top") + 1, F.col("width")).alias("dims"),
        F.array(*[F.lit(c).cast("bigint") for c in CHUNK]).alias("chunks"),
    )
    return slab_grid(arrays, 2)


@query(
    "slab_bytes",
    f"""
    SELECT id, slab_no, cells * 4 AS bytes_0, cells * size1 AS bytes_1, cells * (4 + size1) AS bytes
    FROM (SELECT id, n0, n1, CASE id % 3 WHEN 0 THEN 8 WHEN 1 THEN 2 ELSE 1 END AS size1,
                 (i // 100) + (j // 16) * ((n0 + 99) // 100) AS slab_no,
                 least(100, n0 - i) * least(16, n1 - j) AS cells
          FROM (SELECT *, unnest(range(0, n1, 16)) AS j
                FROM (SELECT *, unnest(range(0, n0, 100)) AS i FROM ({ARRAYS_SQL}))))
    """,
)
def _slab_bytes(spark, sf_dir):
    grid = slab_grid(part_arrays(spark, sf_dir), 2)
    second = F.element_at(F.array(F.lit("double"), F.lit("uint16"), F.lit("int8")), (F.col("id") % 3 + 1).cast("int"))
    sizes = [type_bytes(F.lit("float")), type_bytes(second)]
    per_attr, total = slab_bytes(F.col("cells"), sizes)
    return grid.select(
        "id", "slab_no", per_attr[0].alias("bytes_0"), per_attr[1].alias("bytes_1"), total.alias("bytes")
    )


@query(
    "slab_buffer_bytes",
    f"""
    SELECT id, slab_no, least(100, n0 - i) * least(16, n1 - j) * 12 AS bytes, 6400::BIGINT AS buffer_0,
           12800::BIGINT AS buffer_1, 19200::BIGINT AS buffer_bytes
    FROM (SELECT id, n0, n1, i, j, (i // 100) + (j // 16) * ((n0 + 99) // 100) AS slab_no
          FROM (SELECT *, unnest(range(0, n1, 16)) AS j
                FROM (SELECT *, unnest(range(0, n0, 100)) AS i FROM ({ARRAYS_SQL}))))
    """,
)
def _slab_buffer_bytes(spark, sf_dir):
    """What a slab has, clipped at the edge, and what its buffer holds, whole."""
    grid = slab_grid(part_arrays(spark, sf_dir), 2)
    per_attr, total = buffer_bytes(F.array(*[F.lit(c).cast("bigint") for c in CHUNK]), [4, 8])
    return grid.select(
        "id", "slab_no", slab_bytes(F.col("cells"), [4, 8])[1].alias("bytes"), per_attr[0].alias("buffer_0"),
        per_attr[1].alias("buffer_1"), total.alias("buffer_bytes"),
    )


@query(
    "array_size",
    f"""
    SELECT a.id, 2::BIGINT AS rank, 2::BIGINT AS attr_count, n0 * n1 AS elements,
           12 * (p_size % 3 + 1)::BIGINT * (n0 * n1 + p_size)::BIGINT AS footprint
    FROM ({ARRAYS_SQL}) a JOIN part ON a.id = p_partkey
    """,
)
def _array_size(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    extents = F.array((F.col("p_size") * 10 + 1).cast("bigint"), F.col("p_partkey") % 90 + 1)
    arrays = parts.select(
        F.col("p_partkey").alias("id"),
        extents.alias("dims"),
        F.array(F.lit(4), F.lit(8)).alias("type_sizes"),
        (F.col("p_size") % 3 + 1).alias("gcount"),
        F.col("p_size").alias("pcount"),
    )
    sized = array_size(arrays, gcount="gcount", pcount="pcount")
    return sized.select("id", "rank", "attr_count", "elements", "footprint")


@query(
    "cell_to_slab",
    f"SELECT unnamed0, unnamed1, origin_unnamed0, origin_unnamed1, slab_no FROM ({PLANE_SQL})",
)
def _cell_to_slab(spark, sf_dir):
    schema = plane_schema(spark, sf_dir)
    origins = [slab_origin(F.col(d.name), d.step) for d in schema.dims]
    return plane(spark, sf_dir).select(
        *schema.dim_names,
        *[o.alias(f"origin_{d}") for o, d in zip(origins, schema.dim_names)],
        slab_number(origins, schema.shape, schema.chunks).alias("slab_no"),
    )


@query(
    "dim_bounds",
    """
    SELECT 0::BIGINT AS position, 'o_custkey' AS dim, lo0 AS min, lo0 AS start, hi0 AS "end",
           9223372036854775807::BIGINT AS max,
           CASE WHEN least(n1, 1048576) * n0 <= 1048576 THEN n0 ELSE 1 END AS chunk, 0::BIGINT AS overlap
    FROM box
    UNION ALL
    SELECT 1::BIGINT, 'o_orderkey', lo1, lo1, hi1, hi1, least(n1, 1048576), 0::BIGINT FROM box
    """.replace(
        "FROM box",
        """FROM (SELECT *, hi0 - lo0 + 1 AS n0, hi1 - lo1 + 1 AS n1 FROM (
                SELECT min(o_custkey) AS lo0, max(o_custkey) AS hi0, min(o_orderkey) AS lo1,
                       max(o_orderkey) AS hi1 FROM orders))""",
    ),
)
def _dim_bounds(spark, sf_dir):
    return dim_bounds(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey"], extendable=True)


@query(
    "dense_check",
    """
    SELECT 'lineitem' AS name, count(*) AS cells, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_cells,
           (max(l_orderkey) + 1) * (max(l_linenumber) + 1)::BIGINT AS box_cells,
           count(*) = count(DISTINCT (l_orderkey, l_linenumber))
           AND count(*) = (max(l_orderkey) + 1) * (max(l_linenumber) + 1) AS dense FROM lineitem
    UNION ALL
    SELECT 'labels', count(*), count(DISTINCT doc_id), max(doc_id) + 1,
           count(*) = count(DISTINCT doc_id) AND count(*) = max(doc_id) + 1 FROM labels
    UNION ALL
    SELECT 'part', count(*), count(DISTINCT p_partkey), max(p_partkey) + 1,
           count(*) = count(DISTINCT p_partkey) AND count(*) = max(p_partkey) + 1 FROM part
    """,
)
def _dense_check(spark, sf_dir):
    """Repeated coordinates, holes, and a dense array."""
    checks = None
    for name, dims in {"lineitem": ["l_orderkey", "l_linenumber"], "labels": ["doc_id"], "part": ["p_partkey"]}.items():
        row = dense_check(table(spark, sf_dir, name), dims).select(F.lit(name).alias("name"), "*")
        checks = row if checks is None else checks.unionByName(row)
    return checks


@query(
    "dense_check_box",
    """
    SELECT count(*) AS cells, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_cells, 0::BIGINT AS outside,
           (max(l_orderkey) + 1) * 8::BIGINT AS box_cells,
           count(*) = (max(l_orderkey) + 1) * 8
           AND count(DISTINCT (l_orderkey, l_linenumber)) = (max(l_orderkey) + 1) * 8 AS dense FROM lineitem
    """,
)
def _dense_check_box(spark, sf_dir):
    """Cells against a declared box: both copies and holes are found."""
    lines = table(spark, sf_dir, "lineitem")
    top = lines.agg(F.max("l_orderkey")).first()[0]
    dims = (Dim("l_orderkey", top + 1), Dim("l_linenumber", 8))
    return dense_check_box(lines, ArraySchema("lines", (), dims))


@query(
    "array_holes",
    """
    SELECT unnest(range((SELECT max(doc_id) + 1 FROM labels))) AS doc_id
    EXCEPT SELECT doc_id FROM labels
    """,
)
def _array_holes(spark, sf_dir):
    return holes(table(spark, sf_dir, "labels"), "doc_id")


@query(
    "pack_slabs",
    f"""
    SELECT slab_no, origin_unnamed0, origin_unnamed1, max(unnamed0) AS last_unnamed0,
           max(unnamed1) AS last_unnamed1, count(*) AS cells,
           string_agg(floor(value * 1000)::BIGINT::VARCHAR, ' ' ORDER BY unnamed0, unnamed1) AS text
    FROM ({PLANE_SQL}) GROUP BY slab_no, origin_unnamed0, origin_unnamed1
    """,
)
def _pack_slabs(spark, sf_dir):
    slabs = pack_slabs(plane(spark, sf_dir), plane_schema(spark, sf_dir))
    scaled = F.transform("value", lambda v: F.floor(v.cast("double") * 1000).cast("string"))
    return slabs.withColumns(
        {"cells": F.size("value").cast("bigint"), "text": F.array_join(scaled, " ")}
    ).drop("value")


@query(
    "pack_frames",
    f"""
    SELECT unnamed0 // 100 AS slab_no, unnamed0 // 100 * 100 AS origin_unnamed0, 0::BIGINT AS origin_unnamed1,
           0::BIGINT AS origin_unnamed2, max(unnamed0) AS last_unnamed0, max(unnamed1) AS last_unnamed1,
           max(unnamed2) AS last_unnamed2, count(*) AS cells,
           string_agg(floor(value * 1000)::BIGINT::VARCHAR, ' ' ORDER BY unnamed0, unnamed1, unnamed2) AS text
    FROM ({CELLS_SQL}) GROUP BY unnamed0 // 100
    """,
)
def _pack_frames(spark, sf_dir):
    """A hundred frames to a slab, without going through cells."""
    schema = frame_schema(spark, sf_dir).with_chunks((100, 8, 8))
    slabs = pack_frames(frames(spark, sf_dir), "value", schema)
    scaled = F.transform("value", lambda v: F.floor(v.cast("double") * 1000).cast("string"))
    return slabs.withColumns(
        {"cells": F.size("value").cast("bigint"), "text": F.array_join(scaled, " ")}
    ).drop("value")


@query("unpack_slabs", f"SELECT unnamed0, unnamed1, value FROM ({PLANE_SQL})")
def _unpack_slabs(spark, sf_dir):
    slabs, schema = open_array(spark, stored_plane(spark, sf_dir))
    cells = unpack_slabs(slabs, schema.dim_names, schema.attr_names)
    return cells.withColumn("value", F.col("value").cast("double"))


@query(
    "first_n_slabs",
    f"""
    SELECT slab_no, origin_unnamed0, origin_unnamed1, count(*) AS cells
    FROM ({PLANE_SQL}) WHERE slab_no < 7 GROUP BY ALL
    """,
)
def _first_n_slabs(spark, sf_dir):
    slabs, _ = open_array(spark, stored_plane(spark, sf_dir))
    counted = F.size("value").cast("bigint").alias("cells")
    return first_n_slabs(slabs, 7).select("slab_no", "origin_unnamed0", "origin_unnamed1", counted)


@query(
    "redistribute",
    f"""
    SELECT slab_no, count(*) AS cells, round(sum(value), 6) AS total FROM ({PLANE_SQL}) GROUP BY slab_no
    """,
)
def _redistribute(spark, sf_dir):
    slabs, schema = open_array(spark, stored_plane(spark, sf_dir))
    origins = [f"origin_{d}" for d in schema.dim_names]
    spread = redistribute(slabs, origins)
    total = F.aggregate("value", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return spread.select(
        "slab_no", F.size("value").cast("bigint").alias("cells"), F.round(total, 6).alias("total")
    )


@query("store_array", f"SELECT unnamed0, unnamed1, value, 'plane<value:float NOT NULL> [unnamed0=0:' || (max(unnamed0) OVER ()) || ',100,0,unnamed1=0:63,16,0]' AS shown FROM ({PLANE_SQL})")
def _store_array(spark, sf_dir):
    """Cells kept with their description and read back, with the schema text."""
    schema, path = plane_schema(spark, sf_dir), scratch_dir(spark, "cells")
    store_array(plane(spark, sf_dir), path, schema)
    cells, found = open_array(spark, path)
    return cells.withColumns({"value": F.col("value").cast("double"), "shown": F.lit(found.show())})


@query("store_overwrite", "SELECT o_orderkey AS unnamed0, o_totalprice AS float1 FROM orders")
def _store_overwrite(spark, sf_dir):
    """A second store replaces the first one."""
    path = scratch_dir(spark, "replaced")
    orders = table(spark, sf_dir, "orders")
    size = orders.agg(F.max("o_orderkey")).first()[0] + 1
    for column, name, kind in (("o_custkey", "int1", "int64"), ("o_totalprice", "float1", "double")):
        schema = ArraySchema("prices", (Attr(name, kind),), (Dim("unnamed0", size),)).planned()
        cells = orders.select(F.col("o_orderkey").alias("unnamed0"), F.col(column).alias(name))
        store_array(cells, path, schema, mode="overwrite")
    return open_array(spark, path)[0]


@query(
    "slab_subarray_stdev",
    f"""
    SELECT unnamed0, round(stddev_samp(value), 6) AS stdev FROM ({PLANE_SQL})
    WHERE unnamed1 BETWEEN 20 AND 43 GROUP BY unnamed0
    """,
)
def _slab_subarray_stdev(spark, sf_dir):
    """The flagship on stored slabs: prune by origin, explode, filter, group."""
    slabs, schema = open_array(spark, stored_plane(spark, sf_dir))
    window = subarray_slabs(slabs, schema, (None, 20), (None, 43))
    window = window.withColumn("value", F.col("value").cast("double"))
    return rounded(stdev_by_dim(window, ["unnamed0"], "value"), "stdev")


def stored_synopses(spark, sf_dir, chunks):
    """The 2-D view as slabs with moments beside them, along the curve; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, chunks)
    if key not in _stored:
        schema, path = plane_schema(spark, sf_dir).with_chunks(chunks), scratch_dir(spark, "moments")
        slabs = with_synopses(pack_slabs(plane(spark, sf_dir), schema), schema)
        store_array(redistribute_by_curve(slabs, schema), path, schema)
        _stored[key] = path
    return _stored[key]


@query(
    "slab_box_stats",
    f"""
    SELECT count(*) AS count, round(avg(value), 6) AS avg, round(stddev_samp(value), 6) AS stdev,
           min(value) AS min, max(value) AS max
    FROM ({PLANE_SQL}) WHERE unnamed0 >= 37 AND unnamed1 BETWEEN 10 AND 47
    """,
)
def _slab_box_stats(spark, sf_dir):
    """A box over whole slabs and cut ones: only the cut ones give up their cells."""
    slabs, schema = open_array(spark, stored_synopses(spark, sf_dir, CHUNK))
    return rounded(box_stats(slabs, schema, (37, 10), (None, 47), "value"), "avg", "stdev")


@query(
    "slab_frame_stats",
    f"""
    SELECT unnamed0, count(*) AS count, round(avg(value), 6) AS avg, round(stddev_samp(value), 6) AS stdev,
           min(value) AS min, max(value) AS max
    FROM ({PLANE_SQL}) WHERE unnamed1 >= 20 GROUP BY unnamed0
    """,
)
def _slab_frame_stats(spark, sf_dir):
    """The same per frame: slabs of one frame and 16 columns each."""
    slabs, schema = open_array(spark, stored_synopses(spark, sf_dir, (1, 16)))
    return rounded(box_stats(slabs, schema, (None, 20), (None, None), "value", by=["unnamed0"]), "avg", "stdev")


@query(
    "slab_curve",
    f"""
    SELECT slab_no, origin_unnamed0, origin_unnamed1, sum(bit)::BIGINT AS curve FROM (
        SELECT DISTINCT slab_no, origin_unnamed0, origin_unnamed1, b,
               ((origin_unnamed1 // 16) >> b & 1) * (1::BIGINT << (b + least(b, w0)))
               + ((origin_unnamed0 // 100) >> b & 1) * (1::BIGINT << (b + least(b + 1, w1))) AS bit
        FROM (SELECT *, unnest(range(20)) AS b, 2 AS w1, length(bin(max(unnamed0) OVER () // 100)) AS w0 FROM ({PLANE_SQL})))
    GROUP BY ALL
    """,
)
def _slab_curve(spark, sf_dir):
    """Slabs in the order of a Morton curve: bits of both slab indices in turn."""
    schema = plane_schema(spark, sf_dir)
    slabs = pack_slabs(plane(spark, sf_dir), schema)
    return slabs.select("slab_no", "origin_unnamed0", "origin_unnamed1", slab_curve(slabs, schema).alias("curve"))


@query(
    "store_versions",
    """
    SELECT 1 AS version, o_orderkey AS unnamed0, o_totalprice AS float1 FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT 2, o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT 3, o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0
    """,
)
def _store_versions(spark, sf_dir):
    """A store, an append and an overwrite; all three versions can be read."""
    path = scratch_dir(spark, "versions")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("unnamed0"), F.col("o_totalprice").alias("float1"))
    size = orders.agg(F.max("unnamed0")).first()[0] + 1
    schema = ArraySchema("prices", (Attr("float1", "double"),), (Dim("unnamed0", size),)).planned()
    for rows, mode in (("unnamed0 % 2 = 0", "errorifexists"), ("unnamed0 % 2 = 1", "append"), ("unnamed0 % 3 = 0", "overwrite")):
        store_array(orders.where(rows), path, schema, mode=mode)
    found = [open_array(spark, path, version)[0].select(F.lit(version).alias("version"), "*") for version in (1, 2, 3)]
    return found[0].unionByName(found[1]).unionByName(found[2])
