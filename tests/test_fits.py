from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from slabwise import ArrayError, CorruptFile, UnsupportedType
from slabwise.plans import fits_bytes
from slabwise.operators import first_n_elements, slab_grid, subarray_slabs, unpack_slabs
from slabwise.sources import (
    describe_fits,
    fits_catalog,
    fits_header,
    list_files,
    load_fits,
    open_array,
    scan_listed,
    store_fits,
)
from slabwise.sources.files import RangedFile
from slabwise.sources.scan import read_split


def write(folder, name, *parts):
    path = folder / name
    path.write_bytes(b"".join(parts))
    return str(path)


def cells_of(df, dims):
    return {tuple(r[d] for d in dims): r["unknown"] for r in df.collect()}


def test_axis_order_and_values(spark, tmp_path):
    data = np.arange(6 * 4 * 5, dtype="f8").reshape(6, 4, 5) / 7
    path = write(tmp_path, "a.fits", fits_bytes.image(data, -64, first=True))
    df = load_fits(spark, path)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("dim0", "bigint"), ("dim1", "bigint"), ("dim2", "bigint"), ("unknown", "double"),
    ]
    got = cells_of(df, ["dim0", "dim1", "dim2"])
    assert got == {(x, y, z): data[z, y, x] for z, y, x in np.ndindex(6, 4, 5)}


@pytest.mark.parametrize(
    "bitpix,zero,kind",
    [
        (8, 0, "smallint"), (8, -128, "tinyint"), (16, 0, "smallint"), (16, 2**15, "int"),
        (32, 0, "int"), (32, 2**31, "bigint"), (64, 0, "bigint"), (64, 2**63, "decimal(20,0)"),
    ],
)
def test_integer_types_at_their_limits(spark, tmp_path, bitpix, zero, kind):
    low, high = (0, 255) if bitpix == 8 else (-(2 ** (bitpix - 1)), 2 ** (bitpix - 1) - 1)
    raw = np.array([low, low + 1, 0, 1, high], dtype="i8" if bitpix > 8 else "u1")
    path = write(tmp_path, "a.fits", fits_bytes.image(raw, bitpix, [("BZERO", float(zero))], first=True))
    df = load_fits(spark, path)
    assert df.schema["unknown"].dataType.simpleString() == kind
    assert [int(r.unknown) for r in df.orderBy("dim0").collect()] == [int(v) + zero for v in raw.tolist()]


def test_scale_and_blank(spark, tmp_path):
    raw = np.array([1, -999, 3], dtype="i2")
    extra = [("BSCALE", 0.25), ("BZERO", 2.0), ("BLANK", -999)]
    path = write(tmp_path, "a.fits", fits_bytes.image(raw, 16, extra, first=True))
    assert [r.unknown for r in load_fits(spark, path).orderBy("dim0").collect()] == [2.25, None, 2.75]
    text = (tmp_path / "a.fits").read_bytes().replace(b"                0.25", b"             0.25D+0")
    (tmp_path / "a.fits").write_bytes(text)
    assert load_fits(spark, path).where("dim0 = 0").first().unknown == 2.25


def test_many_splits_bounds_and_slabs(spark, tmp_path):
    data = np.random.default_rng(1).normal(size=(700, 2000)).astype("f4")
    path = write(tmp_path, "a.fits", fits_bytes.primary(), fits_bytes.image(data, -32))
    df = load_fits(spark, path, hdu=1, splitBytes=600_000)
    assert df.rdd.getNumPartitions() >= 8
    direct = spark.read.format("fits_image").option("hdu", 1).option("splitBytes", 600_000).load(path)
    assert direct.exceptAll(df).count() == 0 and df.exceptAll(direct).count() == 0
    row = df.agg(F.count("*").alias("n"), F.sum(F.col("unknown").cast("double")).alias("s")).first()
    assert row.n == data.size and abs(row.s - data.astype("f8").sum()) < 1e-6
    part = load_fits(spark, path, hdu=1, lo=(10, 690), hi=(12, None), splitBytes=600_000)
    assert cells_of(part, ["dim0", "dim1"]) == {
        (x, y): float(data[y, x]) for y in range(690, 700) for x in range(10, 13)
    }
    assert load_fits(spark, path, hdu=1, lo=(None, 700), splitBytes=600_000).count() == 0  # beyond the last row
    assert part.rdd.getNumPartitions() == 1  # tasks follow the window, not the file
    slabs = load_fits(spark, path, hdu=1, layout="slabs", splitBytes=600_000)
    rows = slabs.orderBy("slab_no").collect()
    assert [r.slab_no for r in rows] == list(range(len(rows)))
    assert (rows[5].origin_dim0, rows[5].last_dim0, rows[5].origin_dim1, rows[5].last_dim1) == (0, 1999, 5, 5)
    assert np.array_equal(np.array(rows[5].unknown, "f4"), data[5])


def test_pushed_filters_prune_and_keep_rows(spark, tmp_path):
    from slabwise.sources import register

    data = np.arange(300 * 400, dtype="i4").reshape(300, 400)
    path = write(tmp_path, "a.fits", fits_bytes.image(data, 32, first=True))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        register(spark)
        df = spark.read.format("fits_image").load(path).where("dim1 >= 297 and dim0 < 2 and unknown % 2 = 0")
        assert cells_of(df, ["dim0", "dim1"]) == {(0, y): y * 400 for y in (297, 298, 299)}
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
        register(spark)
    pruned = list(read_split("fits_image", path, 0, 1, {}, [("dim1", 297, None), ("dim0", None, 1)]))
    assert sum(b.num_rows for b in pruned) == 6


def test_sql_access(spark, tmp_path):
    path = write(tmp_path, "a.fits", fits_bytes.image(np.arange(12, dtype="i2").reshape(3, 4), 16, first=True))
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW sky USING fits_image OPTIONS (path '{path}', hdu '0')")
    assert spark.sql("SELECT dim1, avg(unknown) FROM sky GROUP BY dim1 ORDER BY dim1").collect() == [
        (0, 1.5), (1, 5.5), (2, 9.5),
    ]


def test_published_table_file(spark, tmp_path):
    """A real file: an empty primary unit and a binary table, which is no array."""
    sample = Path(np.__file__).parent / "_core/tests/data/recarray_from_file.fits"
    if not sample.exists():
        pytest.skip("numpy ships no FITS sample here")
    units = fits_catalog(spark, str(sample)).orderBy("hdu").collect()
    assert [(u.hdu, u.kind, u.value_type) for u in units] == [(0, "IMAGE", None), (1, "BINTABLE", None)]
    assert units[1].listing == "HDU (1) (no array)" and units[1].footprint == 17 * 3
    keys = {r.key: r.value for r in fits_header(spark, str(sample)).collect()}
    assert keys["SIMPLE"] == "T" and keys["NAXIS"] == "0"
    with pytest.raises(Exception, match="is a BINTABLE"):
        load_fits(spark, str(sample), hdu=1)


def test_listing_has_every_unit(spark, tmp_path):
    small = fits_bytes.image(np.zeros((2, 3), "i2"), 16)
    path = write(tmp_path, "a.fits", fits_bytes.primary(), *[small] * 14)
    assert fits_catalog(spark, path, max_units=10).count() == 10
    assert fits_catalog(spark, path).count() == 15
    assert fits_catalog(spark, path).where("hdu = 3").first().listing == (
        "HDU (3) 2-byte int(scale=1) array in dims: 3, 2,   footprint=12"
    )


def test_broken_files(spark, tmp_path):
    good = fits_bytes.image(np.zeros((50, 60), "f4"), -32, first=True)
    cut = write(tmp_path, "cut.fits", good[: 2880 + 100])
    with pytest.raises(Exception, match="cut short"):
        load_fits(spark, cut).count()
    text = write(tmp_path, "text.fits", b"not a fits file".ljust(4000))
    with pytest.raises(Exception, match="not a FITS file"):
        load_fits(spark, text)
    with pytest.raises(Exception, match="no unit 4"):
        load_fits(spark, write(tmp_path, "one.fits", good), hdu=4)
    with pytest.raises(Exception, match="outside"):
        load_fits(spark, write(tmp_path, "two.fits", good), lo=(60, 0)).count()
    with RangedFile(cut) as file, pytest.raises(CorruptFile):
        file.read(10, 10_000)


def test_quoted_cards(spark, tmp_path):
    extra = [("OBJECT", "O''Neil / x"), ("EXPTIME", 3.5, "seconds / long")]
    path = write(tmp_path, "a.fits", fits_bytes.image(np.zeros(3, "i2"), 16, extra, first=True))
    cards = {r.key: (r.value, r.comment) for r in fits_header(spark, path).collect()}
    assert cards["OBJECT"] == ("O'Neil / x", None) and cards["EXPTIME"] == ("3.5", "seconds / long")


def test_load_into_a_named_array_replaces_it(spark, tmp_path):
    first = write(tmp_path, "a.fits", fits_bytes.image(np.zeros((2, 2), "i2"), 16, first=True))
    second = write(tmp_path, "b.fits", fits_bytes.image(np.ones((3, 2), "i2"), 16, first=True))
    target = str(tmp_path / "stored")
    for path in (first, second):
        store_fits(spark, target, path)
    cells, found = open_array(spark, target)
    assert cells.count() == 6 and found.shape == (2, 3) and cells.agg(F.min("unknown")).first()[0] == 1
    assert found.show() == "unknown<unknown:int16 NOT NULL> [dim0=0:1,2,0,dim1=0:2,3,0]"


def test_slabs_stored_and_unpacked(spark, tmp_path):
    data = np.arange(30 * 20, dtype="f4").reshape(30, 20)
    path = write(tmp_path, "a.fits", fits_bytes.image(data, -32, first=True))
    slabs = load_fits(spark, path, layout="slabs")
    # Values lie in file order, so the slab is unpacked with the axes reversed.
    back = unpack_slabs(slabs, ["dim1", "dim0"], ["unknown"])
    assert cells_of(back, ["dim1", "dim0"]) == {(y, x): float(data[y, x]) for y, x in np.ndindex(30, 20)}


def grid_of(spark, schema):
    """Slab numbers and origins that a description promises."""
    row = spark.createDataFrame([(list(schema.shape), list(schema.chunks))], "dims array<bigint>, chunks array<bigint>")
    return sorted((r.slab_no, *r[1:1 + schema.rank]) for r in slab_grid(row, schema.rank).collect())


@pytest.mark.parametrize("shape", [(3, 4), (30, 20), (700, 2000)])
def test_stored_slabs_are_described(spark, tmp_path, shape):
    data = np.arange(np.prod(shape), dtype="i4").reshape(shape)
    path = write(tmp_path, "a.fits", fits_bytes.image(data, 32, first=True))
    store_fits(spark, str(tmp_path / "out"), path, layout="slabs")
    slabs, schema = open_array(spark, str(tmp_path / "out"))
    assert schema.dim_names == ["dim0", "dim1"] and schema.shape == shape[::-1]
    assert sorted((r.slab_no, r.origin_dim0, r.origin_dim1) for r in slabs.collect()) == grid_of(spark, schema)
    lo, hi = (1, 1), (min(12, shape[1] - 1), min(11, shape[0] - 1))
    cells = subarray_slabs(slabs, schema, lo, hi).collect()
    want = {(x, y): int(data[y, x]) for x in range(lo[0], hi[0] + 1) for y in range(lo[1], hi[1] + 1)}
    assert {(r.dim0, r.dim1): r.unknown for r in cells} == want and len(cells) == len(want)
    assert [r.unknown for r in first_n_elements(load_fits(spark, path), schema, 5).orderBy("unknown").collect()] == [0, 1, 2, 3, 4]


def test_folders_are_not_one_array(spark, tmp_path):
    for name in ("a.fits", "b.fits"):
        write(tmp_path, name, fits_bytes.image(np.zeros((3, 2), "i2"), 16, first=True))
    with pytest.raises(ArrayError, match="several files are not one array"):
        store_fits(spark, str(tmp_path / "out"), str(tmp_path))


def test_first_elements_in_file_order(spark, tmp_path):
    data = np.arange(30 * 20, dtype="i4").reshape(30, 20)
    path = write(tmp_path, "a.fits", fits_bytes.image(data, 32, first=True))
    first = first_n_elements(load_fits(spark, path), describe_fits(path), 53, first_fastest=True)
    assert sorted(r.unknown for r in first.collect()) == list(range(53))


def test_small_files_share_tasks_and_listed_scan_agrees(spark, tmp_path):
    for n in range(40):
        write(tmp_path, f"{n:03}.fits", fits_bytes.image(np.full((3, 2), n, "i2"), 16, first=True))
    whole = load_fits(spark, str(tmp_path))
    assert whole.rdd.getNumPartitions() < 5
    assert whole.agg(F.sum("unknown")).first()[0] == 6 * sum(range(40))
    some = load_fits(spark, str(tmp_path / "00*.fits"))
    assert some.agg(F.countDistinct("unknown")).first()[0] == 10
    files = list_files(spark, str(tmp_path), "*.fits")
    listed = scan_listed(files, "fits_image", str(tmp_path), {"splitBytes": 1000})
    assert listed.groupBy("source_path").count().agg(F.min("count"), F.max("count"), F.count("*")).first() == (6, 6, 40)


def test_unsupported_bitpix():
    from slabwise.sources.fits import value_type

    with pytest.raises(UnsupportedType):
        value_type(12, 1.0, 0.0)
