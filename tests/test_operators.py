import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from slabwise import ArraySchema, Attr, BadBounds, Dim
from slabwise.operators import (
    align_frames,
    array_ddl,
    dense_check,
    dense_check_box,
    dump_frames,
    dump_records,
    first_n_elements,
    flatten_compound,
    holes,
    pack_frames,
    pack_slabs,
    slab_grid,
    stdev_by_dim,
    subarray,
    subarray_slabs,
    unpack_slabs,
    unroll,
    unroll_nested,
    vlen_unwrap,
    write_lines,
)
from slabwise.operators.chunks import _spread_range
from slabwise.operators.dump import FRAME_BYTES_LIMIT, TOO_LARGE


def box(spark, shape):
    total = 1
    for n in shape:
        total *= n
    from slabwise.functions import delinearize

    coords = [c.alias(f"d{i}") for i, c in enumerate(delinearize(F.col("id"), shape))]
    return spark.range(total).select(*coords, (F.col("id") * 3 + 1).alias("v"), (F.col("id") % 5).alias("w"))


def described(shape, chunks):
    dims = tuple(Dim(f"d{i}", n, c) for i, (n, c) in enumerate(zip(shape, chunks)))
    return ArraySchema("a", (Attr("v", "int64"), Attr("w", "int64")), dims)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_pack_then_unpack_is_identity(spark, data):
    shape = data.draw(st.lists(st.integers(1, 6), min_size=1, max_size=3))
    chunks = [data.draw(st.integers(1, n)) for n in shape]
    schema, cells = described(shape, chunks), box(spark, shape)
    slabs = pack_slabs(cells, schema)
    back = unpack_slabs(slabs, schema.dim_names, schema.attr_names)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cells.collect()))
    numbers = sorted(r.slab_no for r in slabs.collect())
    assert numbers == list(range(len(numbers)))  # disjoint, covering, densely numbered


def test_pack_rejects_repeated_cells(spark):
    cells = box(spark, (4,)).unionByName(box(spark, (4,)))
    with pytest.raises(Exception, match="duplicate cells: too many in slab"):
        pack_slabs(cells, described((4,), (2,))).collect()
    # A copy that fills a hole keeps the count right but is still found.
    moved = box(spark, (4,)).withColumn("d0", F.when(F.col("d0") == 3, 2).otherwise(F.col("d0")))
    with pytest.raises(Exception, match="duplicate cells: repeated in slab 2"):
        pack_slabs(moved, described((4,), (2,))).collect()


@pytest.mark.parametrize(
    ("where", "change", "message"),
    [
        ("d0 != 1", "d0", "missing cells: too few in slab 0"),
        ("true", "d0 - 1", "d0 outside 0..3: -1"),
        ("true", "d0 + 1", "d0 outside 0..3: 4"),
        ("true", "nullif(d0, 2)", "d0 outside 0..3: null"),
    ],
)
def test_pack_rejects_holes_and_cells_outside(spark, where, change, message):
    cells = box(spark, (4,)).where(where).withColumn("d0", F.expr(change).cast("bigint"))
    with pytest.raises(Exception, match=message.replace(".", "[.]")):
        pack_slabs(cells, described((4,), (2,))).collect()


def test_pack_leaves_out_slabs_without_cells(spark):
    kept = pack_slabs(box(spark, (4,)).where("d0 > 1"), described((4,), (2,))).collect()
    assert [(r.slab_no, len(r.v)) for r in kept] == [(1, 2)]


def test_pack_frames_and_unroll_reject_wrong_lengths(spark):
    schema = ArraySchema("a", (Attr("v", "int64"),), (Dim("d0", 2, 2), Dim("d1", 2, inside=True)))
    for short in ("array(1L)", "cast(null as array<bigint>)", "array(1L, 2L, 3L)"):
        frames = spark.range(2).selectExpr("id as d0", f"if(id = 1, {short}, array(1L, 2L)) as v")
        with pytest.raises(Exception, match="v does not have 2 values in frame 1"):
            pack_frames(frames, "v", schema).collect()
    with pytest.raises(Exception, match="v does not have 4 values but 5"):
        unroll(spark.sql("select 0L as d0, array(1, 2, 3, 4, 5) as v"), ["d0"], "v", (2, 2), "x").collect()
    with pytest.raises(Exception, match="missing cells: too few in slab 0"):
        pack_frames(spark.sql("select 0L as d0, array(1L, 2L) as v"), "v", schema).collect()


def test_pack_frames_equals_packed_cells(spark):
    values = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda x: x + F.col("d0") * 6)
    frames = spark.range(7).select(F.col("id").alias("d0")).withColumn("v", values)
    schema = ArraySchema("a", (Attr("v", "int64"),), (Dim("d0", 7, 3), Dim("d1", 2, inside=True), Dim("d2", 3, inside=True)))
    cells = unroll(frames, ["d0"], "v", (2, 3), "v", dims=["d1", "d2"])
    packed = pack_frames(frames, "v", schema)
    assert sorted(packed.collect()) == sorted(pack_slabs(cells, schema).collect())
    with pytest.raises(Exception, match="duplicate cells: too many in slab"):
        pack_frames(frames.unionByName(frames), "v", schema).collect()
    with pytest.raises(Exception, match="duplicate cells: repeated in slab 0"):
        twice = frames.withColumn("d0", F.when(F.col("d0") == 1, 0).otherwise(F.col("d0")))
        pack_frames(twice, "v", schema).collect()
    with pytest.raises(BadBounds):
        pack_frames(frames, "v", schema.with_chunks((3, 1, 3)))


def test_slab_grid_is_clipped_and_ordered(spark):
    arrays = spark.createDataFrame([("a", [450, 64], [100, 16])], "id string, dims array<bigint>, chunks array<bigint>")
    grid = slab_grid(arrays, 2).orderBy("slab_no").collect()
    assert len(grid) == 20 and sum(r.cells for r in grid) == 450 * 64
    assert [(r.origin_0, r.origin_1) for r in grid[:6]] == [(0, 0), (100, 0), (200, 0), (300, 0), (400, 0), (0, 16)]
    assert grid[4].cells == 50 * 16


def test_slab_grid_of_no_cells_and_many_blocks(spark):
    arrays = spark.createDataFrame([("a", [0, 4], [1, 1])], "id string, dims array<bigint>, chunks array<bigint>")
    assert slab_grid(arrays, 2).count() == 0
    one = spark.createDataFrame([(100_003,)], "n long")
    numbered = _spread_range(one, "n", "i", block=1000)
    assert numbered.agg(F.count("i"), F.countDistinct("i"), F.max("i")).first() == (100_003, 100_003, 100_002)


def test_flagship_first_three_images(spark):
    frames = spark.range(5).select("id", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda x: x * (F.col("id") + 1)).alias("a"))
    cells = unroll(frames, ["id"], "a", (4, 4), "int1")
    three = subarray(cells, ["id", "unnamed1", "unnamed2"], (0, 0, 0), (2, 3, 3))
    got = {r.id: r.stdev for r in stdev_by_dim(three, ["id"], "int1").collect()}
    base = 4.760952285695233  # sample deviation of 0..15
    assert got.keys() == {0, 1, 2} and all(abs(got[i] - base * (i + 1)) < 1e-9 for i in got)


def test_unroll_window_equals_filter(spark):
    frames = spark.range(3).select("id", F.transform(F.sequence(F.lit(0), F.lit(23)), lambda x: x + F.col("id")).alias("a"))
    whole = unroll(frames, ["id"], "a", (4, 6), "v")
    window = unroll(frames, ["id"], "a", (4, 6), "v", lo=(1, None), hi=(2, 3))
    expected = whole.where("unnamed1 between 1 and 2 and unnamed2 <= 3")
    assert sorted(window.collect()) == sorted(expected.collect())
    with pytest.raises(BadBounds):
        unroll(frames, ["id"], "a", (4, 6), "v", hi=(4, 0))


def test_unroll_nested_and_vlen(spark):
    rows = spark.createDataFrame([(0, [[1, 2], [3, 4]])], "id long, a array<array<int>>")
    got = unroll_nested(rows, ["id"], "a", 2, "v").collect()
    assert [tuple(r) for r in got] == [(0, 0, 0, 1), (0, 0, 1, 2), (0, 1, 0, 3), (0, 1, 1, 4)]
    ragged = spark.createDataFrame([(0, [(1, "a")]), (1, []), (2, [(2, "b"), (3, "c")])], "id long, r array<struct<x:int,y:string>>")
    assert [tuple(r) for r in vlen_unwrap(ragged, ["id"], "r", "k").collect()] == [
        (0, 0, 1, "a"), (2, 0, 2, "b"), (2, 1, 3, "c"),
    ]


def test_flatten_keeps_odd_names(spark):
    df = spark.range(1).select(F.struct(F.struct(F.lit(1).alias("x.y")).alias("in")).alias("out"))
    assert flatten_compound(df).columns == ["out_in_x.y"]


def test_subarray_slabs_equals_cells(spark):
    schema, cells = described((9, 7), (4, 3)), box(spark, (9, 7))
    slabs = pack_slabs(cells, schema)
    got = subarray_slabs(slabs, schema, (3, None), (7, 4))
    expected = subarray(cells, ["d0", "d1"], (3, None), (7, 4))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    rebased = subarray(cells, ["d0", "d1"], (3, 2), (7, 4), rebase=True)
    assert rebased.agg(F.min("d0"), F.max("d0"), F.min("d1"), F.max("d1")).first() == (0, 4, 0, 2)
    with pytest.raises(BadBounds):
        subarray(cells, ["d0", "d1"], (3, 2), (1, 4))


def test_first_n(spark):
    schema, cells = described((9, 7), (4, 3)), box(spark, (9, 7))
    assert sorted(r.v for r in first_n_elements(cells, schema, 10).collect()) == [i * 3 + 1 for i in range(10)]


@pytest.mark.parametrize("bad", ["-1L", "cast(null as bigint)"])
def test_holes_reject_what_is_no_coordinate(spark, bad):
    with pytest.raises(Exception, match="id is negative or null"):
        holes(spark.sql(f"select explode(array({bad}, 1L, 2L)) as id"), "id").collect()


def test_dense_check_and_holes(spark):
    dense = box(spark, (4, 3))
    assert dense_check(dense, ["d0", "d1"]).first().dense is True
    assert dense_check(dense.where("not (d0 = 1 and d1 = 1)"), ["d0", "d1"]).first().dense is False
    assert dense_check(dense.unionByName(dense), ["d0", "d1"]).first().dense is False
    # A hole and a copy cancel in the count but not in the check.
    swapped = dense.withColumn("d1", F.when((F.col("d0") == 1) & (F.col("d1") == 1), 0).otherwise(F.col("d1")))
    assert dense_check(swapped, ["d0", "d1"]).first().dense is False
    line = spark.range(50).where("id % 7 != 3").unionByName(spark.range(3))
    assert sorted(r.id for r in holes(line, "id").collect()) == [3, 10, 17, 24, 31, 38, 45]
    far = spark.range(200_001).where("id % 50021 != 7 and not (id between 70000 and 140000)")
    expected = sorted({7, 50028, 150070} | set(range(70_000, 140_001)))
    assert sorted(r.id for r in holes(far, "id").collect()) == expected


def test_dense_check_against_a_box(spark):
    schema, cells = described((40, 1000), (4, 3)), box(spark, (40, 1000))
    full = dense_check_box(cells, schema).first()
    assert full.dense is True and full.distinct_cells == full.cells == full.box_cells == 40_000
    assert dense_check_box(cells.where("not (d0 = 39 and d1 = 999)"), schema).first().dense is False
    moved = cells.withColumn("d1", F.when((F.col("d0") == 1) & (F.col("d1") == 1), 0).otherwise(F.col("d1")))
    found = dense_check_box(moved, schema).first()
    assert (found.cells, found.distinct_cells, found.dense) == (40_000, 39_999, False)
    beyond = cells.withColumn("d1", F.when((F.col("d0") == 1) & (F.col("d1") == 1), 1000).otherwise(F.col("d1")))
    found = dense_check_box(beyond, schema).first()
    assert (found.cells, found.distinct_cells, found.outside, found.dense) == (40_000, 39_999, 1, False)
    assert dense_check_box(cells.where("d0 < 0"), schema).first().dense is False


def test_lines_are_written_in_order(spark, tmp_path):
    lines = spark.range(1000).select(F.col("id").alias("record"), F.concat(F.lit("#"), F.col("id")).alias("line"))
    path = str(tmp_path / "dump")
    write_lines(lines.repartition(7), path, order="record")
    text = "".join(p.read_text() for p in sorted((tmp_path / "dump").glob("part-*")))
    assert text.splitlines() == [f"#{i}" for i in range(1000)]


def test_dump_texts(spark):
    records = spark.createDataFrame([(0, 7, 1.5, "x"), (1, -2, 1234567.0, "y")], "n long, a int, b double, s string")
    lines = dump_records(records, "n", "/d").orderBy("record").collect()
    assert [r.line for r in lines] == ["Data for /d", '#0: {7, 1.5, "x"}', '#1: {-2, 1.23457e+06, "y"}']

    frames = spark.range(600).select("id", F.array(*[F.col("id") * 0 + i for i in range(4)]).alias("a"))
    limited = dump_frames(frames, "id", "a", (2, 2), 4, outer_limit=500, inner_limit=3)
    assert limited.count() == 500
    assert limited.where("record = 0").first().line == "0: {array [2, 2], 16} is 0 1 2 <limit 3 reached>"
    assert dump_frames(frames, "id", "a", (2, 2), 4).count() == 600
    assert dump_frames(frames, "id", "a", (8192, 8192), 4).first().line == "0: {array [8192, 8192], 268435456} is 0 1 2 3"
    big = dump_frames(frames, "id", "a", (8192, 8192), 4, frame_limit=FRAME_BYTES_LIMIT)
    assert big.first().line == TOO_LARGE


def test_ddl_text(spark):
    catalog = spark.createDataFrame(
        [("/a/b.c", [("x", "INT32"), ("", "CHAR[4]")], [(None,), (9,)])],
        "path string, attrs array<struct<name:string,ddl_type:string>>, dims array<struct<limit:bigint>>",
    )
    assert array_ddl(catalog).first().ddl == "CREATE ARRAY a_b_c (\n    INT32::x,\n    CHAR[4]\n) [0:*, 0:9];"


def test_align_frames(spark):
    a = spark.range(5).select(F.col("id").alias("f"), (F.col("id") * 2).alias("x"))
    b = spark.range(3, 8).select(F.col("id").alias("f"), (F.col("id") + 1).alias("y"))
    assert sorted(map(tuple, align_frames([a, b], "f").collect())) == [(3, 6, 4), (4, 8, 5)]
