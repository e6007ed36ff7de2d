"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source wants the same level of words per weight; a source whose cap lies below its
share is clamped at the cap and the rest is dealt again by weight.  Clamping one source
after the other in the order of cap / weight leaves a running sum and one comparison per
source, so the rounds are one window over the table of sources.

Documents of a source are taken in the order of a seeded hash: each one the whole number
of epochs, and the first of them once more until the fraction is used up; the document on
the border is taken in part.  The order is cut into hash bins, whose sums are counted
first, so no source is sorted as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabwise.llm.common import word_count

WEIGHTS = (3, 1, 2)
#: Bins of the hash order of one source.
BINS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from a table of sources and sizes.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times
    the sum of all sizes, each at most ``max_epochs`` times its own.  Its windows go over
    the whole table, which has one small row per source.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number - 1) % len(weights) + 1)
    cap = (F.col("source_size") * max_epochs).cast("double")
    table = sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    order = Window.orderBy("ratio", F.asc_nulls_last("source"))
    before = F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")
    weights_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * share
    level = (total - before) / weights_left
    table = table.withColumn("level", level).withColumn("place", F.row_number().over(order))
    # The first source that is not clamped sets the level of all that follow.
    free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("place", "ratio", "level"))).over(everything)
    target = F.when(free.isNull() | (F.col("ratio") < free["ratio"]), F.col("cap")).otherwise(F.col("weight") * free["level"])
    return table.select("source", "source_size", target.alias("target"))


def _order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_epochs: int = 2, seed: str = "mix", more: tuple[str, ...] = ()
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per input row: ``doc_id``, ``source`` and the columns named in
    ``more``, ``size`` (words), ``source_size``, ``target`` (words of its source) and
    ``taken`` (words, repeats counted; at most ``max_epochs`` times the size).  The words
    taken of a source add up to its target, rounded.

    Null and empty texts have size 0 and nothing is taken of them; rows without a source
    are one source, which comes last.  Documents with equal ids are taken in the order of
    their texts; of equal rows any comes first.  Sources without words have target 0.
    Reruns give the same.  Columns not named are ignored; an empty table gives an empty result.
    """
    key = _order(F.col("doc_id"), seed)
    kept = list(dict.fromkeys(["doc_id", "source", *more]))
    rows = docs.select(
        *kept,
        word_count("text").alias("_size"),
        key.alias("_key"),
        F.xxhash64("text").alias("_tie"),
        (F.conv(F.substring(key, 1, 3), 16, 10).cast("int") % BINS).alias("_bin"),
    )
    bins = rows.groupBy("source", "_bin").agg(F.sum("_size").alias("_bin_size"))
    earlier = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("_before", F.sum("_bin_size").over(earlier) - F.col("_bin_size"))
    targets = source_targets(bins.groupBy("source").agg(F.sum("_bin_size").alias("source_size")), weights, share, max_epochs)
    plan = bins.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
    plan = plan.select(F.col("b.source").alias("_source"), F.col("_bin").alias("_b"), "_before", "source_size", "target")
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("long")
    rest = F.floor(F.col("target") - whole * F.col("source_size") + F.lit(0.5)).cast("long")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bin") == F.col("_b")))
    running = Window.partitionBy("_source", "_b").orderBy("_key", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("_before") + F.sum("_size").over(running) - F.col("_size")
    part = F.greatest(F.lit(0), F.least(F.col("_size"), rest - start))
    return joined.select(*kept, F.col("_size").alias("size"), "source_size", "target", (whole * F.col("_size") + part).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as it takes them.

    Whole repetitions come whole.  A document that is taken in part comes once more if that
    part is half of it at least, and not otherwise, so no text is cut.  Options as ``mix``.
    """
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))  # no name can clash inside
    counted = mix(rows, more=("row",), **options)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    return counted.select("row", F.explode(F.array_repeat(F.lit(1), times)).alias("one")).select("row.*")
