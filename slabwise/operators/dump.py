"""Text forms of schemas, records and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from slabwise.functions.text import c_number, c_numbers, sanitize_name

# Limits that a text dump may be given, and the text that marks the last one.
OUTER_LIMIT = 500
INNER_LIMIT = 2000
FRAME_BYTES_LIMIT = 128 * 1024 * 1024
TOO_LARGE = "Array to read is too large"


def show_schema(bounds: DataFrame, name: str, attrs: list[tuple[str, str]]) -> DataFrame:
    """Schema text of an array from its ``dim_bounds`` rows."""
    attr_text = ",".join(f"{a}:{t} NOT NULL" for a, t in attrs)
    dim_text = F.format_string(
        "%s=%d:%d,%d,%d", "dim", "min", "max", "chunk", "overlap"
    )
    ordered = F.array_sort(F.collect_list(F.struct("position", dim_text.alias("text"))))
    listed = F.array_join(ordered["text"], ",")
    return bounds.agg(F.concat(F.lit(f"{name}<{attr_text}> ["), listed, F.lit("]")).alias("schema"))


def value_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.concat(F.lit('"'), column, F.lit('"'))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c_number(column)
    return column.cast("string")


def dump_records(records: DataFrame, dim: str, dataset: str) -> DataFrame:
    """Lines ``#n: {a, b, "s"}`` of a 1-D compound, after a ``Data for`` line.

    Rows are ``(record, line)``; the heading has record -1.  Order the lines by
    ``record`` when writing; nothing is sorted here.
    """
    members = [
        value_text(F.col(f"`{f.name}`"), f.dataType) for f in records.schema.fields if f.name != dim
    ]
    body = F.concat_ws(", ", *[F.coalesce(m, F.lit("")) for m in members])
    number = F.col(dim).cast("bigint")
    lines = records.select(
        number.alias("record"),
        F.concat(F.lit("#"), number.cast("string"), F.lit(": {"), body, F.lit("}")).alias("line"),
    )
    heading = records.sparkSession.range(1).select(
        F.lit(-1).cast("bigint").alias("record"), F.lit(f"Data for {dataset}").alias("line")
    )
    return heading.unionByName(lines)


def dump_frames(
    frames: DataFrame,
    dim: str,
    values: str,
    shape,
    type_bytes: int,
    outer_limit: int | None = None,
    inner_limit: int | None = None,
    frame_limit: int | None = None,
) -> DataFrame:
    """One line per outer element, its values separated by spaces.

    Everything is shown.  On request, only the first ``outer_limit`` elements,
    the first ``inner_limit`` values of each, or a notice instead of frames of
    more than ``frame_limit`` bytes.
    """
    size = type_bytes
    for extent in shape:
        size *= extent
    element = frames.schema[values].dataType.elementType
    number = F.col(dim).cast("bigint")
    kept = frames if outer_limit is None else frames.where(F.col(dim) < outer_limit)
    if frame_limit is not None and size > frame_limit:
        return kept.select(number.alias("record"), F.lit(TOO_LARGE).alias("line"))
    shown = F.col(values) if inner_limit is None else F.slice(F.col(values), 1, inner_limit)
    if isinstance(element, (T.FloatType, T.DoubleType)):
        texts = c_numbers(shown)
    else:
        texts = F.transform(shown, lambda v: value_text(v, element))
    extents = ", ".join(str(n) for n in shape)
    line = F.concat(
        number.cast("string"),
        F.lit(f": {{array [{extents}], {size}}} is "),
        F.array_join(texts, " "),
    )
    if inner_limit is not None:
        over = F.size(values) > inner_limit
        line = F.concat(line, F.when(over, F.lit(f" <limit {inner_limit} reached>")).otherwise(""))
    return kept.select(number.alias("record"), line.alias("line"))


def array_ddl(catalog: DataFrame) -> DataFrame:
    """``CREATE ARRAY`` text per dataset of an HDF5 catalogue.

    Needs ``path``, ``attrs`` (structs with ``name`` and ``ddl_type``) and
    ``dims`` (structs with ``limit``, null when extendable).
    """
    attrs = F.transform(
        "attrs",
        lambda a: F.concat(
            F.lit("\n    "),
            a["ddl_type"],
            F.when(a["name"] != "", F.concat(F.lit("::"), a["name"])).otherwise(""),
        ),
    )
    dims = F.transform(
        "dims", lambda d: F.concat(F.lit("0:"), F.coalesce(d["limit"].cast("string"), F.lit("*")))
    )
    text = F.concat(
        F.lit("CREATE ARRAY "),
        sanitize_name(F.col("path")),
        F.lit(" ("),
        F.array_join(attrs, ","),
        F.lit("\n) ["),
        F.array_join(dims, ", "),
        F.lit("];"),
    )
    return catalog.withColumn("ddl", text)


def write_lines(lines: DataFrame, path: str, text: str = "line", order: str | None = None, mode: str = "errorifexists") -> None:
    """Lines to text files.  With ``order`` files and their lines follow that column.

    Ordering is by range, many files in parallel; reading them by name gives
    the whole text.
    """
    if order is not None:
        lines = lines.repartitionByRange(order).sortWithinPartitions(order)
    lines.select(F.col(text).alias("value")).write.mode(mode).text(path)
