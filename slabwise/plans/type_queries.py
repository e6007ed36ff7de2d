"""Element types, raw bytes and physical values.

Tables stand in for large attribute catalogues: every row gives one type
descriptor through its columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from slabwise.functions import (
    class_supported,
    decode_int,
    enum_label,
    fits_type_name,
    fixed_string,
    float_type_name,
    int_type_name,
    physical_value,
    spark_type_name,
)
from slabwise.functions.types import TYPE_CLASSES
from slabwise.plans.registry import query, table

EVENT_CODES = {"click": 1, "error": 2, "purchase": 5, "signup": 9, "view": 12}


@query(
    "type_int",
    """
    SELECT bytes, signed, type_name,
           CASE type_name WHEN 'int8' THEN 'tinyint' WHEN 'int16' THEN 'smallint' WHEN 'int32' THEN 'int'
             WHEN 'int64' THEN 'bigint' WHEN 'uint8' THEN 'smallint' WHEN 'uint16' THEN 'int'
             WHEN 'uint32' THEN 'bigint' WHEN 'uint64' THEN 'decimal(20,0)' END AS spark_type,
           count(*) AS n
    FROM (SELECT bytes, signed, (CASE WHEN signed THEN 'int' ELSE 'uint' END) || (bytes * 8) AS type_name
          FROM (SELECT (1 << (l_linenumber % 4))::BIGINT AS bytes, l_suppkey % 2 = 0 AS signed FROM lineitem))
    GROUP BY ALL
    """,
)
def _type_int(spark, sf_dir):
    described = table(spark, sf_dir, "lineitem").select(
        F.element_at(F.array(*[F.lit(b).cast("bigint") for b in (1, 2, 4, 8)]), F.col("l_linenumber") % 4 + 1).alias("bytes"),
        (F.col("l_suppkey") % 2 == 0).alias("signed"),
    )
    named = described.withColumn("type_name", int_type_name(F.col("bytes"), F.col("signed")))
    named = named.withColumn("spark_type", spark_type_name(F.col("type_name")))
    return named.groupBy("bytes", "signed", "type_name", "spark_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "type_float",
    """
    SELECT bytes, CASE bytes WHEN 4 THEN 'float' WHEN 8 THEN 'double' ELSE 'float' || (bytes * 8) END AS type_name,
           CASE bytes WHEN 2 THEN 'float' WHEN 4 THEN 'float' WHEN 8 THEN 'double' END AS spark_type, count(*) AS n
    FROM (SELECT (l_linenumber * 2)::BIGINT AS bytes FROM lineitem) GROUP BY ALL
    """,
)
def _type_float(spark, sf_dir):
    sizes = table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") * 2).cast("bigint").alias("bytes"))
    named = sizes.withColumn("type_name", float_type_name(F.col("bytes")))
    named = named.withColumn("spark_type", spark_type_name(F.col("type_name")))
    return named.groupBy("bytes", "type_name", "spark_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "type_fits",
    """
    SELECT bitpix, bscale, bzero, count(*) AS n,
           CASE WHEN bscale <> 1 THEN 'double'
                WHEN bzero = 0 THEN CASE bitpix WHEN 8 THEN 'uint8' WHEN 16 THEN 'int16' WHEN 32 THEN 'int32'
                                    WHEN 64 THEN 'int64' WHEN -32 THEN 'float' ELSE 'double' END
                WHEN bitpix = 16 AND bzero = 32768 THEN 'uint16'
                WHEN bitpix = 32 AND bzero = 2147483648 THEN 'uint32'
                WHEN bitpix = 8 AND bzero = -128 THEN 'int8'
                ELSE 'double' END AS type_name
    FROM (SELECT CASE l_linenumber WHEN 1 THEN 8 WHEN 2 THEN 16 WHEN 3 THEN 32 WHEN 4 THEN 64
                   WHEN 5 THEN -32 ELSE -64 END AS bitpix,
                 CASE l_suppkey % 3 WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS bscale,
                 CASE l_partkey % 5 WHEN 1 THEN 32768.0::DOUBLE WHEN 2 THEN 2147483648.0::DOUBLE
                   WHEN 3 THEN (-128.0)::DOUBLE ELSE 0.0::DOUBLE END AS bzero FROM lineitem)
    GROUP BY ALL
    """,
)
def _type_fits(spark, sf_dir):
    line, part = F.col("l_linenumber"), F.col("l_partkey") % 5
    bitpix = F.when(line == 5, -32).when(line > 5, -64)
    for number, bits in ((1, 8), (2, 16), (3, 32), (4, 64)):
        bitpix = bitpix.when(line == number, bits)
    cards = table(spark, sf_dir, "lineitem").select(
        bitpix.alias("bitpix"),
        F.when(F.col("l_suppkey") % 3 == 0, 0.5).otherwise(1.0).alias("bscale"),
        F.when(part == 1, 32768.0).when(part == 2, 2147483648.0).when(part == 3, -128.0).otherwise(0.0).alias("bzero"),
    )
    kind = fits_type_name(F.col("bitpix"), F.col("bscale"), F.col("bzero")).alias("type_name")
    return cards.groupBy("bitpix", "bscale", "bzero").agg(F.count(F.lit(1)).alias("n")).select("*", kind)


@query(
    "type_support",
    """
    SELECT code, class, class IN ('INTEGER', 'FLOAT', 'COMPOUND', 'ARRAY') AS supported, count(*) AS n
    FROM (SELECT user_id % 12 AS code,
                 coalesce(['INTEGER', 'FLOAT', 'TIME', 'STRING', 'BITFIELD', 'OPAQUE', 'COMPOUND', 'REFERENCE',
                           'ENUM', 'VLEN', 'ARRAY'][user_id % 12 + 1], 'UNKNOWN') AS class FROM events)
    GROUP BY ALL
    """,
)
def _type_support(spark, sf_dir):
    code = (F.col("user_id") % 12).alias("code")
    classes = F.create_map(*[F.lit(x) for item in TYPE_CLASSES.items() for x in item])
    name = F.coalesce(F.try_element_at(classes, F.col("code").cast("int")), F.lit("UNKNOWN"))
    rows = table(spark, sf_dir, "events").select(code).withColumn("class", name)
    rows = rows.withColumn("supported", class_supported(F.col("class")))
    return rows.groupBy("code", "class", "supported").agg(F.count(F.lit(1)).alias("n"))


@query(
    "fixed_string",
    """
    SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 2 THEN rtrim(p_type, ' ') ELSE p_type END AS p_type,
           length(p_name) AS chars FROM part
    """,
)
def _fixed_string(spark, sf_dir):
    """Names as 40-byte fields under three padding rules, and back."""
    rule = F.element_at(F.array(F.lit("nullterm"), F.lit("nullpad"), F.lit("spacepad")), (F.col("p_partkey") % 3 + 1).cast("int"))
    pad = F.when(rule == "spacepad", F.lit(" ")).otherwise(F.lit("\0"))
    junk = F.when(rule == "nullterm", F.lit("\0left over")).otherwise(F.lit(""))

    def field(name, size):
        return F.encode(F.rpad(F.concat(F.col(name), junk), size, pad), "UTF-8")

    packed = table(spark, sf_dir, "part").select(
        "p_partkey", rule.alias("rule"), field("p_name", 40).alias("a"), field("p_type", 40).alias("b")
    )
    text = packed.select(
        "p_partkey",
        fixed_string(F.col("a"), F.col("rule")).alias("p_name"),
        fixed_string(F.col("b"), F.col("rule")).alias("p_type"),
    )
    return text.withColumn("chars", F.length("p_name").cast("bigint"))


@query(
    "enum_code",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 5
                       WHEN 'signup' THEN 9 WHEN 'view' THEN 12 END AS code,
           event_type AS label FROM events
    """,
)
def _enum_code(spark, sf_dir):
    codes = F.create_map(*[F.lit(x) for item in EVENT_CODES.items() for x in item])
    coded = table(spark, sf_dir, "events").select("event_id", F.try_element_at(codes, F.col("event_type")).alias("code"))
    return coded.withColumn("label", enum_label(F.col("code"), EVENT_CODES))


@query("calibrate", "SELECT p_partkey, 10.0 + 0.5 * p_size::DOUBLE AS value FROM part")
def _calibrate(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", physical_value(F.col("p_size"), 0.5, 10.0).alias("value"))


@query(
    "decode_bytes",
    """
    SELECT event_id, (event_id * 7919) % 65536 AS u16,
           CASE WHEN (event_id * 7919) % 65536 >= 32768 THEN (event_id * 7919) % 65536 - 65536
                ELSE (event_id * 7919) % 65536 END AS i16,
           CASE WHEN event_id % 2 = 0 THEN -event_id * 900001 ELSE event_id * 900001 END AS i64,
           CASE WHEN event_id % 2 = 0 THEN -event_id * 900001 ELSE event_id * 900001 END AS i64_swapped,
           (18446744073709551615::HUGEINT - event_id)::VARCHAR AS u64
    FROM events
    """,
)
def _decode_bytes(spark, sf_dir):
    """Numbers laid out as bytes in both orders, then decoded."""
    n = F.col("event_id")
    signed = F.when(n % 2 == 0, -n * 900001).otherwise(n * 900001)
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.unhex(F.lpad(F.hex(n * 7919 % 65536), 4, "0")).alias("short"),
        F.unhex(F.lpad(F.hex(signed), 16, "0")).alias("long"),
        F.unhex(F.lpad(F.hex(F.bitwise_not(n)), 16, "0")).alias("top"),
    )
    swapped = F.unhex(F.concat(*[F.hex(F.substring("long", i, 1)) for i in range(8, 0, -1)]))
    return raw.select(
        "event_id",
        decode_int(F.col("short"), 2, signed=False, big_endian=True).alias("u16"),
        decode_int(F.col("short"), 2, signed=True, big_endian=True).alias("i16"),
        decode_int(F.col("long"), 8, signed=True, big_endian=True).alias("i64"),
        decode_int(swapped, 8, signed=True, big_endian=False).alias("i64_swapped"),
        decode_int(F.col("top"), 8, signed=False, big_endian=True).cast("string").alias("u64"),
    )
