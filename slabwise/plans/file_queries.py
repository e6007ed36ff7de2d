"""Scans and catalogues of files derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from slabwise.operators import array_ddl
from slabwise.plans.derived_files import (
    KINDS,
    base_name,
    fits_files,
    frame_files,
    number_of,
    part_files,
)
from slabwise.plans.registry import query
from slabwise.sources import dump_files, fits_catalog, fits_header, hdf5_catalog, load_fits, load_hdf5

IMAGE, LABEL, PART = "/Run:0000/Cam.0/image", "/Run:0000/Cam.0/label", "/store/part"

# Files and frames per file, as the export lays them out.
SKY_FILES_SQL = """
    SELECT vec_id // size AS number, count(*) AS frames,
           '-' || lpad((vec_id // size)::VARCHAR, 6, '0') AS stem
    FROM embeddings, (SELECT least(262144, greatest(64, (max(vec_id) + 8) // 8)) AS size FROM embeddings)
    GROUP BY ALL
"""
PART_FILES_SQL = """
    SELECT p_partkey // size AS number, count(*) AS records,
           '-' || lpad((p_partkey // size)::VARCHAR, 6, '0') AS stem
    FROM part, (SELECT least(1048576, greatest(250, (max(p_partkey) + 8) // 8)) AS size FROM part)
    GROUP BY ALL
"""


def _global_frame(size: int, local: str):
    """Frame number over all files: files hold runs of equal length."""
    return (number_of(F.col("source_path")) * size + F.col(local)).alias("frame")


@query(
    "fits_scan",
    "SELECT vec_id AS frame, unnest(range(len(embedding))) AS dim0, unnest(embedding)::DOUBLE AS value FROM embeddings",
)
def _fits_scan(spark, sf_dir):
    folder, size = fits_files(spark, sf_dir)
    cells = load_fits(spark, folder, hdu=1, withPath=True)
    return cells.select(_global_frame(size, "dim1"), "dim0", F.col("unknown").cast("double").alias("value"))


@query(
    "fits_scaled",
    "SELECT vec_id AS frame, label AS stored, 10.0 + 0.5 * label::DOUBLE AS value FROM embeddings",
)
def _fits_scaled(spark, sf_dir):
    """Unsigned integers by offset, and physical values by scale, joined per frame."""
    folder, size = fits_files(spark, sf_dir)
    unsigned = load_fits(spark, folder, hdu=2, withPath=True).select(
        _global_frame(size, "dim0"), F.col("unknown").alias("stored")
    )
    scaled = load_fits(spark, folder, hdu=3, withPath=True).select(
        _global_frame(size, "dim0"), F.col("unknown").alias("value")
    )
    return unsigned.join(scaled, "frame")


@query(
    "hdf5_scan",
    """
    SELECT vec_id AS frame, p // 8 AS unnamed1, p % 8 AS unnamed2, v::DOUBLE AS float1
    FROM (SELECT vec_id, unnest(range(len(embedding))) AS p, unnest(embedding) AS v FROM embeddings)
    """,
)
def _hdf5_scan(spark, sf_dir):
    folder, size = frame_files(spark, sf_dir)
    cells = load_hdf5(spark, folder, IMAGE, withPath=True)
    return cells.select(
        _global_frame(size, "unnamed0"), "unnamed1", "unnamed2", F.col("float1").cast("double").alias("float1")
    )


@query(
    "hyperslab_read",
    """
    SELECT vec_id AS frame, p // 8 AS unnamed1, p % 8 AS unnamed2, v::DOUBLE AS float1
    FROM (SELECT vec_id, unnest(range(len(embedding))) AS p, unnest(embedding) AS v FROM embeddings)
    WHERE p // 8 BETWEEN 2 AND 5 AND p % 8 >= 3
    """,
)
def _hyperslab_read(spark, sf_dir):
    """A window of every frame, cut while reading."""
    folder, size = frame_files(spark, sf_dir)
    window = load_hdf5(spark, folder, IMAGE, withPath=True, lo=(None, 2, 3), hi=(None, 5, None))
    return window.select(
        _global_frame(size, "unnamed0"), "unnamed1", "unnamed2", F.col("float1").cast("double").alias("float1")
    )


@query("attr_read", "SELECT p_partkey AS frame, p_retailprice FROM part")
def _attr_read(spark, sf_dir):
    """One member of a compound."""
    folder, size = part_files(spark, sf_dir)
    cells = load_hdf5(spark, folder, PART, columns=["p_retailprice"], withPath=True)
    return cells.select(_global_frame(size, "unnamed0"), "p_retailprice")


@query(
    "hdf5_compound",
    f"""
    SELECT p_partkey AS frame, p_partkey, p_size, p_retailprice, p_brand,
           CASE p_type {" ".join(f"WHEN '{k}' THEN {v}" for k, v in KINDS.items())} ELSE 6 END AS p_kind
    FROM part
    """,
)
def _hdf5_compound(spark, sf_dir):
    """All members: padded record, unsigned integer, fixed text, enum code."""
    folder, size = part_files(spark, sf_dir)
    cells = load_hdf5(spark, folder, PART, withPath=True)
    return cells.select(
        _global_frame(size, "unnamed0"), "p_partkey", "p_size", "p_retailprice", "p_brand",
        F.col("p_kind").cast("int").alias("p_kind"),
    )


@query(
    "hdf5_catalog",
    f"""
    SELECT 'frames' || stem || '.h5' AS file, path, kind, class, supported, attrs, dims FROM ({SKY_FILES_SQL}),
        LATERAL (VALUES
            ('/', 'group', NULL, false, NULL, NULL),
            ('/Run:0000', 'group', NULL, false, NULL, NULL),
            ('/Run:0000/Cam.0', 'group', NULL, false, NULL, NULL),
            ('/Run:0000/Cam.0/image', 'dataset', 'ARRAY', true, ':float',
             'unnamed0=' || frames || '/' || frames || ' unnamed1=8/8 unnamed2=8/8'),
            ('/Run:0000/Cam.0/label', 'dataset', 'INTEGER', true, ':int32', 'unnamed0=' || frames || '/' || frames)
        ) AS t(path, kind, class, supported, attrs, dims)
    UNION ALL
    SELECT 'parts' || stem || '.h5', path, kind, class, supported, attrs, dims FROM ({PART_FILES_SQL}),
        LATERAL (VALUES
            ('/', 'group', NULL, false, NULL, NULL),
            ('/store', 'group', NULL, false, NULL, NULL),
            ('/store/part', 'dataset', 'COMPOUND', true,
             'p_partkey:int64 p_size:uint16 p_retailprice:double p_brand:string p_kind:uint8',
             'unnamed0=' || records || '/' || records)
        ) AS t(path, kind, class, supported, attrs, dims)
    """,
)
def _hdf5_catalog(spark, sf_dir):
    """Every object of every file; attributes and dimensions shown as text."""
    attrs = F.array_join(F.transform("attrs", lambda a: F.concat(a["name"], F.lit(":"), a["type"])), " ")
    dims = F.array_join(
        F.transform(
            "dims",
            lambda d: F.concat(d["name"], F.lit("="), d["size"].cast("string"), F.lit("/"), d["chunk"].cast("string")),
        ),
        " ",
    )
    folders = [frame_files(spark, sf_dir)[0], part_files(spark, sf_dir)[0]]
    catalog = hdf5_catalog(spark, folders[0]).unionByName(hdf5_catalog(spark, folders[1]))
    return catalog.select(
        base_name(F.col("file")).alias("file"), "path", "kind", "class", "supported", attrs.alias("attrs"),
        dims.alias("dims"),
    )


@query(
    "fits_catalog",
    f"""
    SELECT 'sky' || stem || '.fits' AS file, hdu, kind, bitpix, value_type, dims, footprint, listing
    FROM ({SKY_FILES_SQL}), LATERAL (VALUES
        (0::BIGINT, 'IMAGE', 8::BIGINT, NULL, '', 0::BIGINT, 'HDU (0) (no array)'),
        (1, 'IMAGE', -32, 'float', '64,' || frames, frames * 256, 'HDU (1) 4-byte float(scale=1) array in dims: 64, ' || frames || ',   footprint=' || frames * 256),
        (2, 'IMAGE', 16, 'uint16', '' || frames, frames * 2, 'HDU (2) 2-byte uint(scale=1) array in dims: ' || frames || ',   footprint=' || frames * 2),
        (3, 'IMAGE', 16, 'double', '' || frames, frames * 2, 'HDU (3) 2-byte int(scale=0.5) array in dims: ' || frames || ',   footprint=' || frames * 2)
    ) AS t(hdu, kind, bitpix, value_type, dims, footprint, listing)
    """,
)
def _fits_catalog(spark, sf_dir):
    folder, _ = fits_files(spark, sf_dir)
    dims = F.array_join(F.transform("dims", lambda n: n.cast("string")), ",")
    return fits_catalog(spark, folder).select(
        base_name(F.col("file")).alias("file"), "hdu", "kind", "bitpix", "value_type", dims.alias("dims"),
        "footprint", "listing",
    )


@query(
    "fits_header",
    f"""
    SELECT 'sky' || stem || '.fits' AS file, position, key, value, comment
    FROM ({SKY_FILES_SQL}), (VALUES
        (0::BIGINT, 'SIMPLE', 'T', 'conforms to FITS standard'),
        (1, 'BITPIX', '8', 'array data type'),
        (2, 'NAXIS', '0', 'number of array dimensions'),
        (3, 'EXTEND', 'T', NULL)
    ) AS t(position, key, value, comment)
    """,
)
def _fits_header(spark, sf_dir):
    folder, _ = fits_files(spark, sf_dir)
    return fits_header(spark, folder).select(
        base_name(F.col("file")).alias("file"), "position", "key", "value", "comment"
    )


@query(
    "dump_ddl",
    f"""
    SELECT 'frames' || stem || '.h5' AS file, ddl FROM ({SKY_FILES_SQL}), LATERAL (VALUES
        ('CREATE ARRAY Run_0000_Cam_0_image (' || chr(10) || '    FLOAT' || chr(10) || ') [0:*, 0:8, 0:8];'),
        ('CREATE ARRAY Run_0000_Cam_0_label (' || chr(10) || '    INT32' || chr(10) || ') [0:' || frames || '];')
    ) AS t(ddl)
    UNION ALL
    SELECT 'parts' || stem || '.h5', 'CREATE ARRAY store_part (' || chr(10) || '    LONG::p_partkey,' || chr(10)
        || '    UINT16::p_size,' || chr(10) || '    DOUBLE::p_retailprice,' || chr(10) || '    CHAR[12]::p_brand,'
        || chr(10) || '    UINT8::p_kind' || chr(10) || ') [0:' || records || '];' FROM ({PART_FILES_SQL})
    """,
)
def _dump_ddl(spark, sf_dir):
    folders = [frame_files(spark, sf_dir)[0], part_files(spark, sf_dir)[0]]
    catalog = hdf5_catalog(spark, folders[0]).unionByName(hdf5_catalog(spark, folders[1]))
    datasets = catalog.where("supported")
    return array_ddl(datasets).select(base_name(F.col("file")).alias("file"), "ddl")


@query(
    "dump_files",
    f"""
    WITH sky AS (
        SELECT 'frames' || stem || '.h5' AS file, number, frames FROM ({SKY_FILES_SQL})),
    parts AS (SELECT 'parts' || stem || '.h5' AS file, number, records FROM ({PART_FILES_SQL})),
    frame AS (
        SELECT file, vec_id - min(vec_id) OVER (PARTITION BY file) AS record, embedding
        FROM (SELECT vec_id, embedding, 'frames-' || lpad((vec_id // (SELECT least(262144, greatest(64, (max(vec_id) + 8) // 8)) FROM embeddings))::VARCHAR, 6, '0') || '.h5' AS file
              FROM embeddings)),
    piece AS (
        SELECT file, p_partkey - min(p_partkey) OVER (PARTITION BY file) AS record, p_partkey, p_size, p_retailprice, p_brand,
               CASE p_type {" ".join(f"WHEN '{k}' THEN {v}" for k, v in KINDS.items())} ELSE 6 END AS p_kind
        FROM (SELECT *, 'parts-' || lpad((p_partkey // (SELECT least(1048576, greatest(250, (max(p_partkey) + 8) // 8)) FROM part))::VARCHAR, 6, '0') || '.h5' AS file
              FROM part))
    SELECT file, '/Run:0000/Cam.0/image' AS dataset, -2 AS record,
           'CREATE ARRAY Run_0000_Cam_0_image (' || chr(10) || '    FLOAT' || chr(10) || ') [0:*, 0:8, 0:8];' AS line FROM sky
    UNION ALL
    SELECT file, '/Run:0000/Cam.0/image', record, record || ': {{array [8, 8], 256}} is '
           || array_to_string(list_transform(embedding, lambda v: printf('%g', v::DOUBLE)), ' ') FROM frame
    UNION ALL
    SELECT file, '/Run:0000/Cam.0/label', -2,
           'CREATE ARRAY Run_0000_Cam_0_label (' || chr(10) || '    INT32' || chr(10) || ') [0:' || frames || '];' FROM sky
    UNION ALL
    SELECT file, '/Run:0000/Cam.0/label', -1,
           '// Skipping /Run:0000/Cam.0/label: only 1-d arrays of compound type or of arrays can be dumped' FROM sky
    UNION ALL
    SELECT file, '/store/part', -2, 'CREATE ARRAY store_part (' || chr(10) || '    LONG::p_partkey,' || chr(10)
        || '    UINT16::p_size,' || chr(10) || '    DOUBLE::p_retailprice,' || chr(10) || '    CHAR[12]::p_brand,'
        || chr(10) || '    UINT8::p_kind' || chr(10) || ') [0:' || records || '];' FROM parts
    UNION ALL
    SELECT file, '/store/part', -1, 'Data for /store/part' FROM parts
    UNION ALL
    SELECT file, '/store/part', record, printf('#%d: {{%d, %d, %g, "%s", %d}}', record, p_partkey, p_size, p_retailprice, p_brand, p_kind) FROM piece
    """,
)
def _dump_files(spark, sf_dir):
    """Schema and values of every dataset of two folders of files."""
    folders = [frame_files(spark, sf_dir)[0], part_files(spark, sf_dir)[0]]
    lines = dump_files(spark, folders[0]).unionByName(dump_files(spark, folders[1]))
    return lines.withColumn("file", base_name(F.col("file")))
