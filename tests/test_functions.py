import datetime as dt
import math
import random
import struct

from pyspark.sql import functions as F

from slabwise.functions import (
    c_number,
    decode_int,
    delinearize,
    fits_type_name,
    fixed_string,
    from_timestamp,
    linearize,
    sanitize_name,
    slab_number,
    slab_origin,
    to_timestamp,
)
from slabwise.sources.fits import value_type


def test_c_number_is_percent_g(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.5, 999999.5, 9999995.0, 1e-5, 1e-4, 123456.5, 123457.5, 12345.65, 1e100, 1e-300]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(3000)]
    values += [round(rng.uniform(0, 1e6), 2) for _ in range(3000)]
    values += [struct.unpack("<f", struct.pack("<f", rng.gauss(0, 1)))[0] for _ in range(1000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", c_number(F.col("v")).alias("t"))
    assert [r for r in rows.collect() if r.t != "%g" % r.v] == []


def test_c_number_special(spark):
    rows = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (None,)], "v double")
    assert [r[0] for r in rows.select(c_number(F.col("v"))).collect()] == ["nan", "inf", "-inf", None]


def test_decode_int_against_struct(spark):
    rng = random.Random(3)
    data = [bytes(rng.randrange(256) for _ in range(8)) for _ in range(200)] + [b"\xff" * 8, b"\x80" + b"\0" * 7]
    rows = spark.createDataFrame([(bytearray(d),) for d in data], "b binary")
    for size, letter in ((1, "b"), (2, "h"), (4, "i"), (8, "q")):
        for signed in (True, False):
            for big in (True, False):
                code = (">" if big else "<") + (letter if signed else letter.upper())
                got = rows.select("b", decode_int(F.col("b"), size, signed, big).alias("v")).collect()
                assert all(int(r.v) == struct.unpack_from(code, bytes(r.b))[0] for r in got), code


def test_fixed_string_rules(spark):
    rows = spark.createDataFrame(
        [(bytearray(b"ab\0junk\0"), "nullterm"), (bytearray(b"a b\0\0\0"), "nullpad"), (bytearray(b" a b  "), "spacepad")],
        "b binary, rule string",
    )
    got = [r[0] for r in rows.select(fixed_string(F.col("b"), F.col("rule"))).collect()]
    assert got == ["ab", "a b", " a b"]


def test_names(spark):
    row = spark.createDataFrame([("/Scan:0000/Run.1/image",)], "p string")
    assert row.select(sanitize_name(F.col("p"))).first()[0] == "Scan_0000_Run_1_image"


def test_linearize_round_trip(spark):
    shape = (5, 7, 3)
    cells = spark.range(105).select(*[c.alias(f"c{i}") for i, c in enumerate(delinearize(F.col("id"), shape))], "id")
    again = linearize([F.col(f"c{i}") for i in range(3)], shape)
    assert cells.where(again != F.col("id")).count() == 0
    assert cells.select("c0", "c1", "c2").distinct().count() == 105


def test_slab_order_first_dimension_fastest(spark):
    shape, chunks = (1024, 1024, 2), (512, 1024, 1)
    rows = spark.createDataFrame([(0, 0, 0), (512, 0, 0), (0, 0, 1), (512, 0, 1)], "a long, b long, c long")
    number = slab_number([F.col(c) for c in "abc"], shape, chunks)
    assert [r[0] for r in rows.select(number).collect()] == [0, 1, 2, 3]
    assert spark.range(1).select(slab_origin(F.lit(1023), 512)).first()[0] == 512


def test_fits_type_rule_agrees_with_the_scan(spark):
    cases = [
        (bits, scale, zero)
        for bits in (8, 16, 32, 64, -32, -64)
        for scale in (1.0, 0.5, 2.0)
        for zero in (0.0, -128.0, 32768.0, 2.0**31, 2.0**63, 10.0)
    ]
    rows = spark.createDataFrame(cases, "p int, s double, z double")
    got = rows.select("p", "s", "z", fits_type_name(F.col("p"), F.col("s"), F.col("z")).alias("t")).collect()
    assert [r for r in got if r.t != value_type(r.p, r.s, r.z)] == []
    named = {(r.p, r.s, r.z): r.t for r in got}
    assert named[(16, 1.0, 32768.0)] == "uint16" and named[(64, 1.0, 2.0**63)] == "uint64"
    assert named[(8, 1.0, 0.0)] == "uint8" and named[(8, 1.0, -128.0)] == "int8"
    assert named[(16, 0.5, 0.0)] == "double" and named[(-32, 1.0, 0.0)] == "float"


def test_frame_time_round_trip(spark):
    rows = spark.createDataFrame([(1342000000, 123456000), (0, 0), (-1, 999999000)], "s long, n long")
    stamped = rows.withColumn("t", to_timestamp(F.col("s"), F.col("n")))
    seconds, nanos = from_timestamp(F.col("t"))
    assert stamped.where((seconds != F.col("s")) | (nanos != F.col("n"))).count() == 0
    utc = stamped.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    expected = dt.datetime.fromtimestamp(1342000000, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S") + ".123456"
    assert utc == expected
