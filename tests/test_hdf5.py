"""HDF5 scans.  No official library is at hand: the files are assembled byte by
byte from the published format specification and are unchecked against it."""

import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slabwise import ArrayError, UnsupportedType
from slabwise.operators import array_member_to_cols, flatten_compound, slab_grid, subarray_slabs, vlen_unwrap
from slabwise.plans import hdf5_bytes as h5
from slabwise.schema import UNLIMITED
from slabwise.sources import dump_dataset, dump_files, hdf5_catalog, load_hdf5, open_array, store_hdf5, write_dump
from slabwise.sources.catalog import _hdf5_row
from slabwise.sources.files import RangedFile, list_paths
from slabwise.sources.hdf5 import Hdf5Dataset, Hdf5File
from slabwise.sources.scan import plan_splits


def write(folder, name, build):
    file = h5.FileBuilder()
    build(file)
    path = folder / name
    path.write_bytes(file.build())
    return str(path)


def grid(df, rank, value):
    return {tuple(r[i] for i in range(rank)): r[value] for r in df.collect()}


def described(path, dataset):
    with RangedFile(path) as file:
        return Hdf5Dataset(file, {"dataset": dataset}).schema


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("size,signed", [(s, g) for s in (1, 2, 4, 8) for g in (True, False)])
def test_integers(spark, tmp_path, size, signed, big):
    dtype = np.dtype(f"{'>' if big else '<'}{'i' if signed else 'u'}{size}")
    info = np.iinfo(dtype)
    data = np.array([info.min, info.max, 1, 0, 77], dtype)
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/x", h5.int_type(size, signed, big), (5,), data))
    got = load_hdf5(spark, path, "/x").orderBy("unnamed0").collect()
    assert [int(r.int1) for r in got] == [int(v) for v in data]
    assert described(path, "/x").attrs[0].type == f"{'' if signed else 'u'}int{8 * size}"


@pytest.mark.parametrize("size", [2, 4, 8])
def test_floats(spark, tmp_path, size):
    data = np.array([0.5, -1.25, 3.0, np.inf], f">f{size}")
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/x", h5.float_type(size, big=True), (4,), data))
    assert [r.float1 for r in load_hdf5(spark, path, "/x").orderBy("unnamed0").collect()] == data.tolist()


@pytest.mark.parametrize("shuffle,deflate", [(False, False), (True, False), (False, True), (True, True)])
def test_chunked_with_ragged_edges(spark, tmp_path, shuffle, deflate):
    data = np.arange(11 * 13, dtype="<i4").reshape(11, 13)
    path = write(
        tmp_path, "a.h5",
        lambda f: f.dataset("/g/x", h5.int_type(4), data.shape, data, limits=(None, 20), chunk=(4, 5),
                            shuffle=shuffle, deflate=deflate),
    )
    expected = {(i, j): int(data[i, j]) for i, j in np.ndindex(11, 13)}
    assert grid(load_hdf5(spark, path, "/g/x"), 2, "int1") == expected
    window = load_hdf5(spark, path, "/g/x", lo=(3, 4), hi=(9, 10))
    assert grid(window, 2, "int1") == {k: v for k, v in expected.items() if 3 <= k[0] <= 9 and 4 <= k[1] <= 10}
    many = load_hdf5(spark, path, "/g/x", splitBytes=100)
    assert many.rdd.getNumPartitions() > 3 and grid(many, 2, "int1") == expected
    schema = described(path, "/g/x")
    assert (schema.dims[0].max, schema.dims[1].max) == (UNLIMITED, 19)
    slabs = load_hdf5(spark, path, "/g/x", layout="slabs").collect()
    assert len(slabs) == 9 and sum(len(r.int1) for r in slabs) == data.size
    for r in slabs:
        box = data[r.origin_unnamed0 : r.last_unnamed0 + 1, r.origin_unnamed1 : r.last_unnamed1 + 1]
        assert r.int1 == box.reshape(-1).tolist()
        assert r.slab_no == r.origin_unnamed0 // 4 + r.origin_unnamed1 // 5 * 3


def test_missing_chunks_hold_the_fill_value(spark, tmp_path):
    data = np.arange(24, dtype="<i2").reshape(6, 4)
    fill = struct.pack("<h", -7)
    path = write(
        tmp_path, "a.h5",
        lambda f: (
            f.dataset("/x", h5.int_type(2), (6, 4), data, chunk=(2, 2), fill=fill, skip={(1, 0), (2, 1)}),
            f.dataset("/none", h5.int_type(2), (6, 4), data, chunk=(2, 2), skip=set(np.ndindex(3, 2))),
        ),
    )
    expected = data.copy()
    expected[2:4, 0:2] = -7
    expected[4:6, 2:4] = -7
    got = grid(load_hdf5(spark, path, "/x"), 2, "int1")
    assert got == {(i, j): int(expected[i, j]) for i, j in np.ndindex(6, 4)}
    assert set(grid(load_hdf5(spark, path, "/none"), 2, "int1").values()) == {0}


def test_deep_chunk_index(spark, tmp_path):
    """More chunks than one index node holds, read whole and through a window."""
    data = np.arange(5000, dtype="<i4")
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/x", h5.int_type(4), (5000,), data, chunk=(1,)))
    total = load_hdf5(spark, path, "/x", splitBytes=2000).agg(F.sum("int1"), F.count("*")).first()
    assert total == (5000 * 4999 // 2, 5000)
    window = load_hdf5(spark, path, "/x", lo=(4321,), hi=(4330,))
    assert grid(window, 1, "int1") == {(i,): i for i in range(4321, 4331)}
    with RangedFile(path) as file:
        array = Hdf5Dataset(file, {"dataset": "/x"})
        array.prepare([100], [130])
        assert sorted(array.found) == [(i,) for i in range(100, 131)]


def test_array_of_arrays_is_one_array(spark, tmp_path):
    data = np.arange(5 * 3 * 4, dtype="<u2").reshape(5, 3, 4)
    kind = h5.array_type((3, 4), h5.int_type(2, signed=False))
    path = write(
        tmp_path, "a.h5",
        lambda f: (f.dataset("/c", kind, (5,), data), f.dataset("/k", kind, (5,), data, chunk=(2,), limits=(None,))),
    )
    expected = {ix: int(data[ix]) for ix in np.ndindex(5, 3, 4)}
    for dataset in ("/c", "/k"):
        assert grid(load_hdf5(spark, path, dataset), 3, "int1") == expected
        window = load_hdf5(spark, path, dataset, lo=(1, 0, 2), hi=(3, 1, 2))
        assert grid(window, 3, "int1") == {
            k: v for k, v in expected.items() if 1 <= k[0] <= 3 and k[1] <= 1 and k[2] == 2
        }
    schema = described(path, "/k")
    assert schema.chunks == (5, 3, 4) and [d.inside for d in schema.dims] == [False, True, True]


def nested_record():
    inner = np.dtype({"names": ["u", "w"], "formats": ["<i2", "<f4"], "offsets": [0, 4], "itemsize": 8})
    dtype = np.dtype(
        {"names": ["id", "tag", "in", "m"], "formats": ["<i8", "S6", inner, ("<i4", (2, 2))],
         "offsets": [0, 8, 16, 24], "itemsize": 48}
    )
    members = [
        ("id", 0, h5.int_type(8)),
        ("tag", 8, h5.string_type(6, padding=2)),
        ("in", 16, h5.compound_type(8, [("u", 0, h5.int_type(2)), ("w", 4, h5.float_type(4))])),
        ("m", 24, h5.array_type((2, 2), h5.int_type(4))),
    ]
    rows = np.zeros(7, dtype)
    for i in range(7):
        rows[i] = (i * 10, f"t{i}".ljust(6).encode(), (i, i / 2), [[i, i + 1], [i + 2, i + 3]])
    return rows, h5.compound_type(48, members)


def test_nested_compound_flattens(spark, tmp_path):
    rows, kind = nested_record()
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/r", kind, (7,), rows))
    flat = array_member_to_cols(flatten_compound(load_hdf5(spark, path, "/r")), "m", 4)
    assert flat.columns == ["unnamed0", "id", "tag", "in_u", "in_w", "m_0", "m_1", "m_2", "m_3"]
    got = flat.orderBy("unnamed0").collect()
    assert [tuple(r) for r in got] == [(i, i * 10, f"t{i}", i, i / 2, i, i + 1, i + 2, i + 3) for i in range(7)]
    listed = hdf5_catalog(spark, path).where("path = '/r'").first()
    assert [a.name for a in listed["attrs"]] == ["id", "tag", "in_u", "in_w", "m_0", "m_1", "m_2", "m_3"]
    one = load_hdf5(spark, path, "/r", columns=["tag"])
    assert one.columns == ["unnamed0", "tag"]
    with pytest.raises(Exception, match="no attribute nope"):
        load_hdf5(spark, path, "/r", columns=["nope"])


def test_dump_of_each_kind(spark, tmp_path):
    rows, kind = nested_record()
    frames = np.arange(30 * 6, dtype="<u2").reshape(30, 2, 3) + 65_000
    path = write(
        tmp_path, "a.h5",
        lambda f: (
            f.dataset("/r", kind, (7,), rows),
            f.dataset("/i", h5.array_type((2, 3), h5.int_type(2, signed=False)), (30,), frames, chunk=(4,)),
            f.dataset("/p", h5.int_type(2), (3, 4), np.zeros((3, 4), "<i2")),
        ),
    )
    lines = [r.line for r in dump_dataset(spark, path, "/r").orderBy("record").collect()]
    assert lines[:3] == ["Data for /r", '#0: {0, "t0", 0, 0, 0, 1, 2, 3}', '#1: {10, "t1", 1, 0.5, 1, 2, 3, 4}']
    lines = [r.line for r in dump_dataset(spark, path, "/i", outer_limit=10, inner_limit=4).orderBy("record").collect()]
    assert len(lines) == 10
    assert lines[7] == "7: {array [2, 3], 12} is 65042 65043 65044 65045 <limit 4 reached>"
    assert dump_dataset(spark, path, "/i", outer_limit=None).count() == 30
    assert "Skipping /p" in dump_dataset(spark, path, "/p").first().line


def test_compound_versions_and_padding(spark, tmp_path):
    dtype = np.dtype({"names": ["a", "b"], "formats": ["<i4", "<f8"], "offsets": [4, 16], "itemsize": 32})
    rows = np.zeros(3, dtype)
    rows["a"], rows["b"] = [1, 2, 3], [0.5, 1.5, 2.5]
    for version in (1, 2):
        kind = h5.compound_type(32, [("a", 4, h5.int_type(4)), ("b", 16, h5.float_type(8))], version)
        path = write(tmp_path, f"v{version}.h5", lambda f: f.dataset("/r", kind, (3,), rows))
        got = load_hdf5(spark, path, "/r").orderBy("unnamed0").collect()
        assert [tuple(r) for r in got] == [(0, 1, 0.5), (1, 2, 1.5), (2, 3, 2.5)]


def test_variable_length_records_become_a_dimension(spark, tmp_path):
    inner = np.dtype([("x", "<i4"), ("y", "<f4")])
    lists = [[(1, 0.5), (2, 1.5)], [], [(3, 2.5)]]

    def build(file):
        places = file.heap([np.array(v, inner).tobytes() for v in lists])
        raw = b"".join(struct.pack("<IQI", len(v), at, i) for v, (_, at, i) in zip(lists, places))
        record = h5.compound_type(8, [("x", 0, h5.int_type(4)), ("y", 4, h5.float_type(4))])
        file.dataset("/v", h5.compound_type(16, [("items", 0, h5.vlen_type(record))]), (3,), raw)

    path = write(tmp_path, "a.h5", build)
    ragged = load_hdf5(spark, path, "/v")
    got = vlen_unwrap(ragged, ["unnamed0"], "items", "unnamed1").orderBy("unnamed0", "unnamed1")
    assert [tuple(r) for r in got.collect()] == [(0, 0, 1, 0.5), (0, 1, 2, 1.5), (2, 0, 3, 2.5)]


def test_reading_units_stay_small(tmp_path):
    wide = h5.compound_type(4096, [("m", 0, h5.array_type((1024,), h5.int_type(4)))])
    lists = h5.vlen_type(h5.int_type(4))
    path = write(
        tmp_path, "a.h5",
        lambda f: (
            f.dataset("/wide", wide, (20_000,), bytes(20_000 * 4096)),
            f.dataset("/lists", h5.compound_type(16, [("v", 0, lists)]), (10_000,), bytes(160_000)),
        ),
    )
    with RangedFile(path) as file:
        assert Hdf5Dataset(file, {"dataset": "/wide"}).file_dims[0].step == 64 * 1024 * 1024 // 4096
        assert Hdf5Dataset(file, {"dataset": "/lists"}).file_dims[0].step == 4096


def test_strings_and_enums(spark, tmp_path):
    members = {"off": 0, "on": 5}
    dtype = np.dtype([("z", "S5"), ("p", "S5"), ("s", "S5"), ("e", "u1")])
    rows = np.zeros(2, dtype)
    rows[0] = (b"ab\0xx", b"ab", b" ab  ", 5)
    rows[1] = (b"full5", b"full5", b"full5", 0)
    kind = h5.compound_type(
        16,
        [("z", 0, h5.string_type(5, 0)), ("p", 5, h5.string_type(5, 1)), ("s", 10, h5.string_type(5, 2)),
         ("e", 15, h5.enum_type(h5.int_type(1, signed=False), members))],
    )
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/r", kind, (2,), rows))
    got = load_hdf5(spark, path, "/r").orderBy("unnamed0").collect()
    assert [tuple(r)[1:] for r in got] == [("ab", "ab", " ab", 5), ("full5", "full5", "full5", 0)]
    with RangedFile(path) as file:
        element = Hdf5Dataset(file, {"dataset": "/r"}).element
    assert dict(element.members[3][2].labels) == members


def test_user_block_before_the_data(spark, tmp_path):
    data = np.arange(10, dtype="<i4")
    file = h5.FileBuilder()
    file.dataset("/g/x", h5.int_type(4), (10,), data)
    file.dataset("/g/y", h5.int_type(4), (10,), data * 2, chunk=(3,), deflate=True)
    (tmp_path / "a.h5").write_bytes(file.build(user_block=1024))
    for name, factor in (("x", 1), ("y", 2)):
        got = grid(load_hdf5(spark, str(tmp_path / "a.h5"), f"/g/{name}"), 1, "int1")
        assert got == {(i,): i * factor for i in range(10)}


def test_scalar_dataset_is_one_cell(spark, tmp_path):
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/s", h5.float_type(8), (), np.array([2.5])))
    assert [tuple(r) for r in load_hdf5(spark, path, "/s").collect()] == [(0, 2.5)]


def test_unsupported_types_are_named(spark, tmp_path):
    path = write(
        tmp_path, "a.h5",
        lambda f: (
            f.dataset("/opaque", h5.opaque_type(4), (2,), bytes(8)),
            f.dataset("/enum", h5.enum_type(h5.int_type(1), {"a": 0}), (2,), bytes(2)),
            f.dataset("/text", h5.string_type(4), (2,), b"abcdefgh"),
            f.dataset("/ok", h5.int_type(1), (2,), bytes(2)),
        ),
    )
    for name, word in (("opaque", "OPAQUE"), ("enum", "ENUM"), ("text", "STRING")):
        with pytest.raises(Exception, match=word):
            load_hdf5(spark, path, f"/{name}")
    rows = {r.path: (r["class"], r.supported) for r in hdf5_catalog(spark, path).where("kind = 'dataset'").collect()}
    assert rows == {
        "/opaque": ("OPAQUE", False), "/enum": ("ENUM", False), "/text": ("STRING", False), "/ok": ("INTEGER", True),
    }


def test_catalog_of_many_groups(spark, tmp_path):
    def build(file):
        for g in range(30):
            for d in range(3):
                file.dataset(f"/run{g:02}/deep/d{d}", h5.int_type(2), (d + 1,), np.zeros(d + 1, "<i2"))

    for name in ("a.h5", "b.h5"):
        write(tmp_path, name, build)
    listed = hdf5_catalog(spark, str(tmp_path))
    assert listed.where("kind = 'dataset'").count() == 2 * 90
    assert listed.where("kind = 'group'").count() == 2 * (1 + 30 + 30)
    assert listed.where("path = '/run07/deep/d2'").select(F.col("dims")[0]["size"]).collect() == [(3,), (3,)]


def test_deep_trees_are_listed_once(spark, tmp_path):
    def build(file):
        for i in range(12):
            path = "".join(f"/g{k}" for k in range(i))
            file.dataset(f"{path}/x", h5.int_type(2), (1,), np.zeros(1, "<i2"))

    write(tmp_path, "a.h5", build)
    rows = [(r.path, r.kind) for r in hdf5_catalog(spark, str(tmp_path)).collect()]
    groups = ["/"] + ["".join(f"/g{k}" for k in range(i)) for i in range(1, 12)]
    expected = [(g, "group") for g in groups] + [(f"{'' if g == '/' else g}/x", "dataset") for g in groups]
    assert sorted(rows) == sorted(expected)


def test_link_back_is_not_followed(spark, tmp_path):
    """A hard link to an ancestor: patch a group's entry to point at another."""
    file = h5.FileBuilder()
    file.dataset("/a/b/c/x", h5.int_type(2), (1,), np.zeros(1, "<i2"))
    file.dataset("/a/b/c/loop", h5.int_type(2), (1,), np.zeros(1, "<i2"))
    raw = bytearray(file.build())
    path = tmp_path / "a.h5"
    path.write_bytes(bytes(raw))
    with RangedFile(str(path)) as opened:
        found = {p: address for p, _, address, _ in Hdf5File(opened).walk()}
    old, new = struct.pack("<Q", found["/a/b/c/loop"]), struct.pack("<Q", found["/a"])
    assert raw.count(old) == 1
    path.write_bytes(bytes(raw.replace(old, new)))
    listed = sorted(r.path for r in hdf5_catalog(spark, str(tmp_path)).collect())
    assert listed == ["/", "/a", "/a/b", "/a/b/c", "/a/b/c/loop", "/a/b/c/x"]


def test_broken_files(spark, tmp_path):
    data = np.arange(1000, dtype="<i8")
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/x", h5.int_type(8), (1000,), data))
    whole = open(path, "rb").read()
    (tmp_path / "text.h5").write_bytes(b"hello" * 100)
    with pytest.raises(Exception, match="not an HDF5 file"):
        load_hdf5(spark, str(tmp_path / "text.h5"), "/x")
    (tmp_path / "cut.h5").write_bytes(whole[:4000])
    with pytest.raises(Exception, match="lie beyond"):
        load_hdf5(spark, str(tmp_path / "cut.h5"), "/x").count()
    (tmp_path / "new.h5").write_bytes(whole[:8] + b"\x02" + whole[9:])
    with pytest.raises(Exception, match="superblock version 2"):
        load_hdf5(spark, str(tmp_path / "new.h5"), "/x")
    for dataset, word in (("/nope", "no object"), ("/", "is a group")):
        with pytest.raises(Exception, match=word):
            load_hdf5(spark, path, dataset)
    with pytest.raises(Exception, match="names 2 bounds for 1 dimensions"):
        load_hdf5(spark, path, "/x", lo=(0, 0)).count()
    with RangedFile(path) as file, pytest.raises(UnsupportedType, match="soft link"):
        Hdf5File(file).header(2**64 - 1)


def test_stored_slabs_follow_the_file_chunks(spark, tmp_path):
    data = np.arange(64 * 16, dtype="<i4").reshape(64, 16)
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/x", h5.int_type(4), data.shape, data, chunk=(20, 8)))
    store_hdf5(spark, str(tmp_path / "out"), path, "/x", layout="slabs")
    slabs, schema = open_array(spark, str(tmp_path / "out"))
    assert schema.chunks == (20, 8) and not schema.first_fastest
    row = spark.createDataFrame([(list(schema.shape), list(schema.chunks))], "dims array<bigint>, chunks array<bigint>")
    grid = sorted(tuple(r)[:3] for r in slab_grid(row, 2).collect())
    assert sorted((r.slab_no, r.origin_unnamed0, r.origin_unnamed1) for r in slabs.collect()) == grid
    cells = subarray_slabs(slabs, schema, (19, 7), (41, 9)).collect()
    assert {(r.unnamed0, r.unnamed1): r.int1 for r in cells} == {(y, x): int(data[y, x]) for y in range(19, 42) for x in range(7, 10)}
    write(tmp_path, "b.h5", lambda f: f.dataset("/x", h5.int_type(4), data.shape, data))
    with pytest.raises(ArrayError, match="several files"):
        store_hdf5(spark, str(tmp_path / "both"), str(tmp_path), "/x")


def test_a_large_user_block_and_more_files_than_threads(spark, tmp_path):
    data = np.arange(10, dtype="<i4")
    file = h5.FileBuilder()
    file.dataset("/x", h5.int_type(4), data.shape, data)
    body = file.build()
    (tmp_path / "far.h5").write_bytes(bytes(1 << 23) + body)
    with RangedFile(str(tmp_path / "far.h5")) as opened:
        assert Hdf5File(opened).base in (0, 1 << 23)
    for count in (2, 33):
        folder = tmp_path / str(count)
        folder.mkdir()
        for n in range(count):
            (folder / f"{n:03}.h5").write_bytes(body + bytes(1 << 16))
        opened = []

        def header(self, path, *rest, first=RangedFile.__init__):
            opened.append(path)
            first(self, path, *rest)

        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(RangedFile, "__init__", header)
            cells = load_hdf5(spark, str(folder), "/x", splitBytes=1000, withPath=True)
            by_length = plan_splits("hdf5_array", list_paths(str(folder), (".h5",)), {"dataset": "/x", "splitbytes": 1000})
        # The driver opens files for the columns only, and the same one however many there are.
        assert len(set(opened)) == 1 and len(by_length) > count
        assert cells.groupBy("source_path").agg(F.sum("int1").alias("s"), F.count("*").alias("n")).distinct().collect()[0][1:] == (45, 10)
        assert cells.select("source_path").distinct().count() == count
        direct = spark.read.format("hdf5_array").option("dataset", "/x").option("splitBytes", 1000).load(str(folder))
        assert direct.agg(F.sum("int1"), F.count("*")).first() == (45 * count, 10 * count)


def test_large_files_of_a_folder_are_cut_by_their_headers(spark, tmp_path):
    data = np.arange(4000 * 6, dtype="<i4").reshape(4000, 2, 3)
    for n in range(3):
        write(tmp_path, f"{n}.h5", lambda f, n=n: f.dataset("/x", h5.array_type((2, 3), h5.int_type(4)), (4000,), data + n * 24000, chunk=(100,)))
    (tmp_path / "notes.txt").write_text("no array")
    cells = load_hdf5(spark, str(tmp_path), "/x", splitBytes=20_000)
    assert cells.agg(F.count("*"), F.countDistinct("int1"), F.min("int1"), F.max("int1")).first() == (72000, 72000, 0, 71999)
    busy = cells.groupBy(F.spark_partition_id()).count()
    assert busy.count() > 6 and busy.agg(F.max("count")).first()[0] < 20_000
    window = load_hdf5(spark, str(tmp_path), "/x", splitBytes=20_000, lo=(3990, 1, 0), hi=(None, 1, 0))
    assert window.count() == 30
    slabs = load_hdf5(spark, str(tmp_path), "/x", splitBytes=20_000, layout="slabs", withPath=True)
    assert slabs.agg(F.sum(F.size("int1")), F.countDistinct("source_path")).first() == (72000, 3)
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        load_hdf5(spark, str(empty), "/x")


def test_what_cannot_be_read_is_not_listed_as_supported(spark, tmp_path):
    odd = struct.pack("<BBBBIHH", 0x10, 8, 0, 0, 4, 0, 12)  # 12 of 32 bits
    data = np.arange(4, dtype="<i4")
    path = write(tmp_path, "a.h5", lambda f: (f.dataset("/odd", odd, (4,), data), f.dataset("/x", h5.int_type(4), (4,), data, chunk=(2,), deflate=True)))
    listed = {r.path: r.supported for r in hdf5_catalog(spark, path).collect()}
    assert listed["/x"] is True and not listed["/odd"]
    with RangedFile(path) as file:
        head = Hdf5File(file).find("/x")
        head.filters = [4]
        assert _hdf5_row(path, "/x", head)["supported"] is False
        with pytest.raises(UnsupportedType, match="12 bits"):
            Hdf5File(file).find("/odd")


def test_text_that_is_not_utf8(spark, tmp_path):
    texts = np.array([b"ok", b"a\xffb", b""], "S4")
    path = write(tmp_path, "a.h5", lambda f: f.dataset("/s", h5.compound_type(4, [("t", 0, h5.string_type(4, padding=1))]), (3,), texts))
    assert [r.t for r in load_hdf5(spark, path, "/s").orderBy("unnamed0").collect()] == ["ok", "a�b", ""]


def test_a_flat_group_of_very_many_datasets_is_many_tasks(spark, tmp_path):
    def build(f):
        f.dataset("/flat/d", h5.int_type(4), (3,), np.arange(3, dtype="<i4"))
        f.dataset("/flat/sub/deep/er/z", h5.int_type(4), (3,), np.arange(3, dtype="<i4"))
        held = f.tree["flat"]
        held.update({f"d{i:06}-{'x' * (i % 90)}": held["d"] for i in range(20_000)})  # links to one dataset

    path = write(tmp_path, "many.h5", build)
    listed = hdf5_catalog(spark, path).select("path", "supported", F.spark_partition_id().alias("task")).collect()
    assert len(listed) == len({r.path for r in listed}) == 20_007
    shared = Counter(r.task for r in listed)
    assert len(shared) >= 8 and max(shared.values()) < 6_000
    assert [r.supported for r in listed if r.path == "/flat/sub/deep/er/z"] == [True]
    with RangedFile(path) as file:
        found = Hdf5File(file)
        looked_at = []
        first = Hdf5File.members
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(Hdf5File, "members", lambda self, heap, nodes: looked_at.extend(nodes) or first(self, heap, nodes))
            for i in (0, 1, 4711, 19_999):
                assert found.find(f"/flat/d{i:06}-{'x' * (i % 90)}").shape == (3,)
            for missing in ("/flat/nothing", "/flat/d999999", "/flat/A", "/else"):
                with pytest.raises(ArrayError, match="no object"):
                    found.find(missing)
        assert len(looked_at) < 40  # a search, not a listing


def test_empty_groups_and_links_to_a_group_above(spark, tmp_path):
    def build(f):
        f.dataset("/a/x", h5.int_type(4), (3,), np.arange(3, dtype="<i4"))
        f.tree["a"]["b"] = {}

    path = write(tmp_path, "a.h5", build)
    assert sorted(r.path for r in hdf5_catalog(spark, path).collect()) == ["/", "/a", "/a/b", "/a/x"]


def test_whole_files_are_dumped_in_one_plan(spark, tmp_path):
    values = np.zeros(900, np.dtype([("a", "<i4"), ("b", "<f8"), ("s", "S4"), ("m", "<f4", (2,))], align=False))
    values["a"], values["b"], values["s"], values["m"] = np.arange(900) - 3, np.arange(900) * 1234.5678, b"xy", np.arange(1800).reshape(900, 2) / 7

    def build(f):
        members = [("a", 0, h5.int_type(4)), ("b", 4, h5.float_type(8)), ("s", 12, h5.string_type(4, padding=1)), ("m", 16, h5.array_type((2,), h5.float_type(4)))]
        f.dataset("/rec", h5.compound_type(24, members), (900,), values)
        frames = np.arange(600 * 6, dtype="<i4").reshape(600, 2, 3)
        f.dataset("/deep/er/img", h5.array_type((2, 3), h5.int_type(4)), (600,), frames, chunk=(50,), limits=(None,))
        f.dataset("/plain", h5.int_type(4), (5,), np.arange(5, dtype="<i4"))

    folder = tmp_path / "in"
    folder.mkdir()
    path = write(folder, "a.h5", build)
    lines = dump_files(spark, str(folder), split_bytes=4000)
    got = {}
    for r in lines.collect():
        got.setdefault(r.dataset, {})[r.record] = r.line
    for dataset in ("/rec", "/deep/er/img", "/plain"):
        want = {r.record: r.line for r in dump_dataset(spark, path, dataset).collect()}
        assert {k: v for k, v in got[dataset].items() if k != -2} == want
        assert got[dataset][-2].startswith("CREATE ARRAY")
    write_dump(lines, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == "".join(got[d][r] + "\n" for d in sorted(got) for r in sorted(got[d]))
