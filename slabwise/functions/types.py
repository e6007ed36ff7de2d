"""Names and sizes of element types, as Columns over catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Array type name -> (Spark type, bytes in the file).  Unsigned
# types widen to the next signed type so that no value is lost.
SPARK_TYPES = {
    "int8": (T.ByteType(), 1),
    "int16": (T.ShortType(), 2),
    "int32": (T.IntegerType(), 4),
    "int64": (T.LongType(), 8),
    "uint8": (T.ShortType(), 1),
    "uint16": (T.IntegerType(), 2),
    "uint32": (T.LongType(), 4),
    "uint64": (T.DecimalType(20, 0), 8),
    "float16": (T.FloatType(), 2),
    "float": (T.FloatType(), 4),
    "double": (T.DoubleType(), 8),
}

# Element classes by class code, and those that load as arrays.
TYPE_CLASSES = {
    0: "INTEGER",
    1: "FLOAT",
    2: "TIME",
    3: "STRING",
    4: "BITFIELD",
    5: "OPAQUE",
    6: "COMPOUND",
    7: "REFERENCE",
    8: "ENUM",
    9: "VLEN",
    10: "ARRAY",
}
LOADABLE_CLASSES = ("INTEGER", "FLOAT", "COMPOUND", "ARRAY")


def int_type_name(size: Column, signed: Column) -> Column:
    """``int``/``uint`` plus the number of bits."""
    prefix = F.when(signed, F.lit("int")).otherwise(F.lit("uint"))
    return F.concat(prefix, (size * 8).cast("string"))


def float_type_name(size: Column) -> Column:
    """``float`` (4 bytes), ``double`` (8 bytes), else ``float`` plus the bits."""
    return (
        F.when(size == 4, F.lit("float"))
        .when(size == 8, F.lit("double"))
        .otherwise(F.concat(F.lit("float"), (size * 8).cast("string")))
    )


def spark_type_name(type_name: Column) -> Column:
    """Spark type of an array type; null where there is none."""
    table = {name: dtype.simpleString() for name, (dtype, _) in SPARK_TYPES.items()}
    return _lookup(table, type_name)


def type_bytes(type_name: Column) -> Column:
    """Bytes per element in the file; null for an unknown type."""
    return _lookup({name: size for name, (_, size) in SPARK_TYPES.items()}, type_name)


def fits_type_name(bitpix: Column, bscale: Column, bzero: Column) -> Column:
    """Type of the physical values of an image with these header values.

    Unit scale and zero offset keep the stored type.  An offset of half the
    range marks the other signedness.  Any other scaling gives doubles.
    """
    unit = bscale == 1
    plain = unit & (bzero == 0)
    half = F.pow(F.lit(2.0), bitpix - 1)
    return (
        F.when(plain & (bitpix == 8), F.lit("uint8"))
        .when(unit & (bitpix == 8) & (bzero == -128), F.lit("int8"))
        .when(plain & bitpix.isin(16, 32, 64), F.concat(F.lit("int"), bitpix.cast("string")))
        .when(
            unit & bitpix.isin(16, 32, 64) & (bzero == half),
            F.concat(F.lit("uint"), bitpix.cast("string")),
        )
        .when(plain & (bitpix == -32), F.lit("float"))
        .when(bitpix.isin(8, 16, 32, 64, -32, -64), F.lit("double"))
    )


def class_supported(class_name: Column) -> Column:
    return class_name.isin(*LOADABLE_CLASSES)


def enum_label(code: Column, members: dict[str, int]) -> Column:
    """Member name of an enum code; null for a code outside the member table."""
    return _lookup({value: name for name, value in members.items()}, code)


def _lookup(table: dict, key: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)
