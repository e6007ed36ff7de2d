"""Moments beside stored slabs, and box statistics that read only the slabs a box cuts.

``with_synopses`` adds one small record per slab and attribute: count, mean, sum of squared
deviations, minimum and maximum.  They merge, so a slab that lies in the box as a whole
counts with its record; its cells stay unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from slabwise.operators.query import subarray_slabs, touching_slabs
from slabwise.schema import ArrayError, ArraySchema


def synopsis_name(attr: str) -> str:
    return f"moments_{attr}"


def moments(values: Column) -> Column:
    """``n, mean, m2, min, max`` of an array column in one pass; nulls do not count."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(acc, value):
        delta = value.cast("double") - acc["mean"]
        mean = acc["mean"] + delta / (acc["n"] + 1)
        grown = F.struct((acc["n"] + 1).alias("n"), mean.alias("mean"), (acc["m2"] + delta * (value.cast("double") - mean)).alias("m2"))
        return F.when(value.isNull(), acc).otherwise(grown)

    def with_range(acc):
        return F.struct(
            acc["n"].alias("n"), acc["mean"].alias("mean"), acc["m2"].alias("m2"),
            F.array_min(values).cast("double").alias("min"), F.array_max(values).cast("double").alias("max"),
        )

    return F.aggregate(values, start, add, with_range)


def with_synopses(slabs: DataFrame, schema: ArraySchema, attrs: list[str] | None = None) -> DataFrame:
    """The slabs with a record of moments for every numeric attribute (or those of ``attrs``)."""
    kinds = {f.name: f.dataType.elementType for f in slabs.schema.fields if f.name in schema.attr_names}
    wanted = attrs or [a for a, kind in kinds.items() if isinstance(kind, T.NumericType)]
    for attr in wanted:
        if attr not in kinds or not isinstance(kinds[attr], T.NumericType):
            raise ArrayError(f"{attr} is no numeric attribute")
    return slabs.withColumns({synopsis_name(a): moments(F.col(a)) for a in wanted})


def box_stats(slabs: DataFrame, schema: ArraySchema, lo, hi, attr: str, by: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of a box, per coordinate of ``by``.

    ``slabs`` are stored slabs with synopses.  Bounds are inclusive, ``None`` leaves a side
    open.  Slabs inside the box are read as records only, without the attribute's column;
    cells come from the slabs that the box cuts.  A slab can stand for one coordinate of
    ``by`` only if its chunk is one cell long there.  Nulls do not count; a box without cells
    has a row with count 0, or no rows if there is a ``by``.
    """
    by = by or []
    record = synopsis_name(attr)
    if record not in slabs.columns:
        raise ArrayError(f"no synopsis of {attr}; store the slabs with_synopses")
    steps = {d.name: d.step for d in schema.dims}
    if wide := [d for d in by if steps[d] != 1]:
        raise ArrayError(f"slabs span several coordinates of {', '.join(wide)}; use stats_by_dim")
    near = touching_slabs(slabs, schema, lo, hi)
    within = F.lit(True)
    for dim, low, high in zip(schema.dim_names, lo, hi, strict=True):
        if low is not None:
            within = within & (F.col(f"origin_{dim}") >= low)
        if high is not None:
            within = within & (F.col(f"last_{dim}") <= high)
    fields = ("n", "mean", "m2", "min", "max")
    whole = near.where(within).select(*[F.col(f"origin_{d}").alias(d) for d in by], *[F.col(record)[f].alias(f) for f in fields])
    # Deviations are summed around a number near the mean, so no digits cancel.
    pivot = near.agg(F.avg(F.nanvl(F.col(record)["mean"], F.lit(None)))).first()[0] or 0.0
    cells = subarray_slabs(near.where(~within), schema, lo, hi).select(*by, F.col(attr).cast("double").alias(attr))
    cut = cells.groupBy(*by).agg(
        F.count(attr).alias("n"), F.avg(attr).alias("mean"), (F.var_pop(attr) * F.count(attr)).alias("m2"),
        F.min(attr).alias("min"), F.max(attr).alias("max"),
    )
    off = F.col("mean") - F.lit(pivot)
    sums = whole.unionByName(cut).where("n > 0").groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.sum(F.col("n") * off).alias("_first"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("_second"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )
    spread = F.greatest(F.col("_second") - F.col("_first") * F.col("_first") / F.col("count"), F.lit(0.0))
    return sums.select(
        *by, "count", (F.col("_first") / F.nullif("count", F.lit(0)) + pivot).alias("avg"),
        F.when(F.col("count") > 1, F.sqrt(spread / (F.col("count") - 1))).alias("stdev"), "min", "max",
    )
