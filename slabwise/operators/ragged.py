"""Ragged arrays: lists of any length as blocks of values and a table of offsets.

All lists lie one behind the other, in the order of their row; blocks have the same number
of values, so a long list is several rows and several tasks, and short ones share a row.
Places come from prefix sums of the lengths, made in three levels so that no task sees
more than a bounded number of sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from slabwise.functions.coords import integer_div
from slabwise.schema import ArrayError

#: Values of one block.
BLOCK_VALUES = 65_536
#: Rows that share one sum, and sums that share one of the next level.
SPAN = 4096


def prefix_sums(rows: DataFrame, order: str, size: str, start: str = "start") -> DataFrame:
    """``rows`` with ``start``: the sum of ``size`` over all rows with a smaller ``order``.

    ``order`` must be distinct and not negative.  Spans of ``SPAN`` numbers are summed first,
    then spans of spans; only the upper level, a row per 16 million numbers, is one task's work.
    """
    span, wide = integer_div(F.col(order), SPAN), integer_div(F.col(order), SPAN * SPAN)
    keyed = rows.withColumns({"_span": span, "_wide": wide})

    def before(window):
        return F.coalesce(F.sum("_sum").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("bigint")

    spans = keyed.groupBy("_wide", "_span").agg(F.sum(size).alias("_sum"))
    wides = spans.groupBy("_wide").agg(F.sum("_sum").alias("_sum")).select("_wide", before(Window.orderBy("_wide")).alias("_far"))
    spans = spans.select("_wide", "_span", before(Window.partitionBy("_wide").orderBy("_span")).alias("_near"))
    bases = spans.join(wides, "_wide").select("_span", (F.col("_far") + F.col("_near")).alias("_base"))
    own = Window.partitionBy("_span").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(size).over(own), F.lit(0)).cast("bigint")
    return keyed.withColumn("_within", within).join(bases, "_span").withColumn(start, F.col("_base") + F.col("_within")).drop("_span", "_wide", "_base", "_within")


def pack_ragged(rows: DataFrame, outer: str, values: str, block: int = BLOCK_VALUES) -> tuple[DataFrame, DataFrame]:
    """Offsets ``(outer, start, length)`` and blocks ``(block_no, first, values)`` of a list per row.

    ``outer`` numbers the rows from 0 on, each number once; gaps are allowed.  A null list is
    an empty one.  Lists are exchanged once to meet their offsets, then cut where they are.
    """
    if block < 1:
        raise ArrayError("a block has one value at least")
    number = F.col(outer).cast("bigint")
    shown = F.concat(F.lit(f"{outer} is negative or null: "), F.coalesce(number.cast("string"), F.lit("null")))
    checked = F.when(F.coalesce(number >= 0, F.lit(False)), number).otherwise(F.raise_error(shown))
    lists = rows.select(checked.alias(outer), F.coalesce(F.col(values), F.array().cast(rows.schema[values].dataType)).alias(values))
    sized = lists.select(outer, F.size(values).cast("bigint").alias("length"))
    offsets = prefix_sums(sized, outer, "length").select(outer, "start", "length")
    met = offsets.where("length > 0").join(lists, outer)
    parts = met.select(F.inline(F.transform(_blocks_of(block), lambda at: _share(at, block, F.col(values)))))
    cut = parts.select("block_no", (F.col("start") + F.col("begun")).alias("at"), "part")
    ordered = F.array_sort(F.collect_list(F.struct("at", "part")))
    blocks = cut.groupBy("block_no").agg(ordered.alias("_parts"))
    return offsets, blocks.select("block_no", (F.col("block_no") * block).alias("first"), F.flatten(F.col("_parts.part")).alias(values))


def unpack_ragged(offsets: DataFrame, blocks: DataFrame, outer: str, values: str, dim: str, block: int = BLOCK_VALUES) -> DataFrame:
    """Cells ``(outer, dim, values)``; a list of many blocks is the work of many tasks."""
    touched = offsets.where("length > 0").select(outer, "start", "length", F.explode(_blocks_of(block)).alias("block_no"))
    # Every list of a block has one value there at least, so a block's lists are bounded, too.
    held = touched.groupBy("block_no").agg(F.collect_list(F.struct(outer, "start", "length")).alias("_lists"))

    def share(x):
        low, n = _bounds(F.col("block_no"), block, x["start"], x["length"])
        return F.struct(x[outer].alias(outer), low.alias("begun"), F.slice(values, (x["start"] + low - F.col("first") + 1).cast("int"), n.cast("int")).alias("part"))

    parts = held.join(blocks, "block_no").select(F.inline(F.transform("_lists", share)))
    cells = parts.select(outer, "begun", F.posexplode("part").alias("_at", "_value"))
    return cells.select(outer, (F.col("begun") + F.col("_at")).alias(dim), F.col("_value").alias(values))


def _blocks_of(block: int):
    """The numbers of the blocks that a list lies in."""
    last = F.col("start") + F.col("length") - 1
    return F.sequence(integer_div(F.col("start"), block), integer_div(last, block))


def _bounds(at, block: int, start, length):
    """Where a block's share of a list begins within the list, and how many values it has."""
    low = F.greatest(at * block - start, F.lit(0).cast("bigint"))
    return low, F.least((at + 1) * block - start, length) - low


def _share(at, block: int, values):
    low, n = _bounds(at, block, F.col("start"), F.col("length"))
    return F.struct(at.alias("block_no"), F.col("start").alias("start"), low.alias("begun"), F.slice(values, (low + 1).cast("int"), n.cast("int")).alias("part"))


def unpack_lists(offsets: DataFrame, blocks: DataFrame, outer: str, values: str, block: int = BLOCK_VALUES) -> DataFrame:
    """The rows again: one list per row, empty ones too."""
    cells = unpack_ragged(offsets, blocks, outer, values, "_pos", block)
    lists = cells.groupBy(outer).agg(F.array_sort(F.collect_list(F.struct("_pos", values))).alias("_cells"))
    empty = F.array().cast(blocks.schema[values].dataType)
    return offsets.select(outer).join(lists, outer, "left").select(outer, F.coalesce(F.col(f"_cells.{values}"), empty).alias(values))
