"""Moments of slabs, the curve, ragged lists and alignment by time."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slabwise import ArrayError, ArraySchema, Attr, Dim
from slabwise.operators import (
    align_asof,
    box_stats,
    curve_number,
    dense_check,
    pack_ragged,
    pack_slabs,
    prefix_sums,
    redistribute,
    redistribute_by_curve,
    stats_by_dim,
    subarray_slabs,
    unpack_lists,
    unpack_ragged,
    with_synopses,
)
from slabwise.sources import open_array, store_array


def stored(spark, path, value, shape=(60, 40), chunks=(7, 9)):
    dims = tuple(Dim(f"d{i}", n, c) for i, (n, c) in enumerate(zip(shape, chunks)))
    schema = ArraySchema("a", (Attr("v", "double"),), dims)
    cells = spark.range(shape[0] * shape[1]).select(F.expr(f"id div {shape[1]}").alias("d0"), F.expr(f"id % {shape[1]}").alias("d1"))
    slabs = with_synopses(pack_slabs(cells.withColumn("v", F.expr(value)), schema), schema)
    store_array(redistribute_by_curve(slabs, schema, 6), path, schema)
    return open_array(spark, path)


@pytest.mark.parametrize("value", ["sin(d0 * 41 + d1) * 3", "1e9 + sin(d0 + 7 * d1)", "if((d0 + d1) % 3 = 0, null, d0 - d1 * 0.5D)", "cast(null as double)"])
@pytest.mark.parametrize(("lo", "hi"), [((None, None), (None, None)), ((5, 3), (50, 30)), ((7, 9), (13, 17)), ((8, 10), (9, 11)), ((0, None), (0, 0))])
def test_box_stats_equal_those_of_all_cells(spark, tmp_path, value, lo, hi):
    slabs, schema = stored(spark, str(tmp_path / "a"), value)
    got = box_stats(slabs, schema, lo, hi, "v").first().asDict()
    box = subarray_slabs(slabs, schema, lo, hi)
    want = box.agg(F.count("v").alias("count"), F.avg("v").alias("avg"), F.stddev_samp("v").alias("stdev"), F.min("v").alias("min"), F.max("v").alias("max")).first().asDict()
    empty = [k for k, v in want.items() if v is None]
    assert empty == [k for k, v in got.items() if v is None]
    # At 1e9 the values themselves have seven digits left.
    assert {k: v for k, v in got.items() if v is not None} == pytest.approx({k: v for k, v in want.items() if v is not None}, rel=1e-6)


def test_box_stats_by_a_dimension(spark, tmp_path):
    slabs, schema = stored(spark, str(tmp_path / "a"), "sin(d0 * 41 + d1) * 3", chunks=(1, 9))
    got = {r.d0: r.asDict() for r in box_stats(slabs, schema, (3, 4), (40, None), "v", by=["d0"]).collect()}
    want = {r.d0: r.asDict() for r in stats_by_dim(subarray_slabs(slabs, schema, (3, 4), (40, None)), ["d0"], "v").collect()}
    assert got.keys() == want.keys()
    for d0, row in got.items():
        assert row == pytest.approx(want[d0], rel=1e-9)
    assert box_stats(slabs, schema, (60, None), (None, None), "v", by=["d0"]).count() == 0
    assert box_stats(slabs, schema, (60, None), (None, None), "v").first()[:] == (0, None, None, None, None)
    with pytest.raises(ArrayError, match="several coordinates of d1"):
        box_stats(slabs, schema, (None, None), (None, None), "v", by=["d1"])
    with pytest.raises(ArrayError, match="no synopsis"):
        box_stats(slabs.drop("moments_v"), schema, (None, None), (None, None), "v")


def test_whole_slabs_stay_unread(spark, tmp_path):
    slabs, schema = stored(spark, str(tmp_path / "a"), "d0 + d1")
    text = box_stats(slabs, schema, (5, 3), (50, 30), "v")._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>\n", text + "\n")
    assert len(scans) == 2
    whole, cut = scans
    assert "array<" not in whole[1] and "moments_v" in whole[1] and "GreaterThanOrEqual(origin_d0,5)" in whole[0]
    assert "v:array<" in cut[1] and "moments_v" not in cut[1] and "Or(" in cut[0]


def test_the_curve_numbers_every_slab_once(spark):
    rows = spark.range(5 * 3 * 8).selectExpr("id div 24 * 10 as a", "id div 8 % 3 * 2 as b", "id % 8 as c")
    got = rows.select("a", "b", "c", curve_number([F.col(x) for x in "abc"], (50, 6, 8), (10, 2, 1)).alias("n")).collect()

    def morton(index, widths):
        number, place = 0, 0
        for bit in range(max(widths)):
            for i, w in reversed(list(zip(index, widths))):
                if bit < w:
                    number |= (i >> bit & 1) << place
                    place += 1
        return number

    assert all(r.n == morton((r.a // 10, r.b // 2, r.c), (3, 2, 3)) for r in got)
    assert len({r.n for r in got}) == 120
    with pytest.raises(ArrayError):
        curve_number([F.col("a"), F.col("b")], (2**40, 2**40), (1, 1))


def test_boxes_in_any_dimension_read_few_files(spark, tmp_path):
    dims = tuple(Dim(f"d{i}", 64, 2) for i in range(2))
    schema = ArraySchema("a", (Attr("v", "int64"),), dims)
    cells = spark.range(64 * 64).selectExpr("id div 64 as d0", "id % 64 as d1", "id as v")
    slabs = pack_slabs(cells, schema)
    store_array(redistribute_by_curve(slabs, schema, 16), str(tmp_path / "curve"), schema)
    store_array(redistribute(slabs, ["origin_d0"], 16, by_range=True), str(tmp_path / "rows"), schema)

    def files(name, dim):
        """Files whose range of the dimension meets one of its slabs."""
        held, _ = open_array(spark, str(tmp_path / name))
        spans = held.groupBy(F.input_file_name().alias("f")).agg(F.min(f"origin_{dim}").alias("lo"), F.max(f"last_{dim}").alias("hi"))
        return spans.where("lo <= 30 and hi >= 30").count()

    assert files("rows", "d0") <= 2 and files("rows", "d1") >= 15  # one range, all files
    assert files("curve", "d0") <= 8 and files("curve", "d1") <= 8


def test_ragged_lists_of_any_length(spark):
    sizes = {0: 3, 1: 0, 2: 1005, 4: 1, 5: 100, 9: 99, 12: 1, 5000: 2, 70_000: 250}
    made = spark.createDataFrame([(k, list(range(k, k + n)) if n else None) for k, n in sizes.items()], "row long, xs array<long>")
    offsets, blocks = pack_ragged(made.repartition(3), "row", "xs", block=100)
    starts, at = {}, 0
    for k, n in sizes.items():
        starts[k], at = (at, n), at + n
    assert {r.row: (r.start, r.length) for r in offsets.collect()} == starts
    held = sorted((r.block_no, r.first, len(r.xs)) for r in blocks.collect())
    assert held == [(b, 100 * b, min(100, at - 100 * b)) for b in range(-(-at // 100))]
    cells = unpack_ragged(offsets, blocks, "row", "xs", "pos", block=100).collect()
    assert sorted((r.row, r.pos, r.xs) for r in cells) == [(k, i, k + i) for k, n in sizes.items() for i in range(n)]
    back = unpack_lists(offsets, blocks, "row", "xs", block=100).collect()
    assert {r.row: r.xs for r in back} == {k: list(range(k, k + n)) for k, n in sizes.items()}
    for bad in ("-1L", "cast(null as bigint)"):
        with pytest.raises(Exception, match="row is negative or null"):
            pack_ragged(spark.sql(f"select {bad} as row, array(1L) as xs"), "row", "xs")[0].collect()


def test_prefix_sums_over_several_levels(spark):
    rows = spark.range(0, 60_000_000, 1999).select(F.col("id").alias("k"), (F.col("id") % 7).alias("n"))
    got = prefix_sums(rows, "k", "n").orderBy("k").collect()
    total = 0
    for r in got:
        assert r.start == total
        total += r.n


@pytest.mark.parametrize("by", [["who"], []])
def test_asof_equals_a_search(spark, by):
    rng = random.Random(3)
    begin = datetime(2024, 1, 1)

    def rows(n, first):
        return [(first + i, rng.choice("ab"), None if rng.random() < 0.03 else begin + timedelta(minutes=rng.randrange(6000)), rng.randrange(9)) for i in range(n)]

    lefts, rights = rows(150, 0), [r for r in rows(60, 1000) if not (r[1] == "b" and r[2] and r[2].day == 2)]
    schema = "id long, who string, ts timestamp, x int"
    right = spark.createDataFrame(rights, schema)
    found = align_asof(spark.createDataFrame(lefts, schema), right if by else right.drop("who"), "ts", "1 hour", by)
    got = {r.id: r.found and (r.found.ts, r.found.id) for r in found.collect()}
    for i, who, ts, _ in lefts:
        earlier = [(r[2], r[0]) for r in rights if ts and r[2] and r[2] <= ts and (not by or r[1] == who)]
        assert got[i] == (max(earlier) if earlier else None)
    assert len(got) == len(lefts) and found.columns == ["id", "who", "ts", "x", "found"]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_asof_of_numbers(spark):
    left = spark.range(20).select(F.col("id").alias("t"))
    right = spark.createDataFrame([(3, "a"), (11, "b"), (11, "c")], "t long, s string")
    got = {r.t: r.found and r.found.s for r in align_asof(left, right, "t", 4).collect()}
    assert got == {t: None if t < 3 else "a" if t < 11 else "c" for t in range(20)}


@pytest.mark.parametrize("values", ["-1L, 1L", "cast(null as bigint), 1L", "-2L, -1L", "0L, null"])
def test_cells_without_a_place_are_not_dense(spark, values):
    assert dense_check(spark.sql(f"select explode(array({values})) as d0"), ["d0"]).first().dense is False
