"""Slab grids, sizes, bounds and the dense-array check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slabwise.functions.coords import integer_div, linearize
from slabwise.schema import UNLIMITED, ArraySchema, chunk_plan_column
from slabwise.session import task_count

# Slabs generated per row before the rows are spread over the cluster.
GRID_BLOCK = 16_384
# Bits of one word of the density checks.
WORD_BITS = 64


def _fold_product(values: Column) -> Column:
    return F.aggregate(values, F.lit(1).cast("bigint"), lambda acc, x: acc * x.cast("bigint"))


def _spread_range(df: DataFrame, count: str, name: str, block: int = GRID_BLOCK) -> DataFrame:
    """Each row repeated ``count`` times with ``name`` = 0..count-1.

    Numbers are made in two steps, blocks first, so that one array with a huge
    grid is generated by many tasks.  Blocks, not arrays, are the shuffle key.
    """
    blocks = integer_div(F.col(count) + (block - 1), block)
    coarse = df.where(F.col(count) > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("_block")
    )
    start = F.col("_block") * block
    stop = F.least(start + block, F.col(count)) - 1
    spread = coarse.repartition(task_count(df.sparkSession), *[F.col(c) for c in coarse.columns])
    return spread.select("*", F.explode(F.sequence(start, stop)).alias(name)).drop("_block")


def slab_grid(arrays: DataFrame, rank: int, dims: str = "dims", chunks: str = "chunks") -> DataFrame:
    """All slabs of each array: ``slab_no``, origins and clipped cell count.

    ``arrays`` carries one row per array with extents and chunk lengths as
    ``array<bigint>`` columns.  The first dimension moves fastest.
    """
    others = [c for c in arrays.columns if c not in (dims, chunks)]
    n = [F.get(F.col(dims), i).cast("bigint") for i in range(rank)]
    step = [F.get(F.col(chunks), i).cast("bigint") for i in range(rank)]
    per_dim = [integer_div(a + b - 1, b) for a, b in zip(n, step)]
    total = per_dim[0]
    for count in per_dim[1:]:
        total = total * count
    flat = arrays.select(
        *others,
        *[a.alias(f"_n{i}") for i, a in enumerate(n)],
        *[b.alias(f"_c{i}") for i, b in enumerate(step)],
        total.alias("_total"),
    )
    numbered = _spread_range(flat, "_total", "slab_no")
    origins, rest = [], F.col("slab_no")
    for i in range(rank):
        size, chunk = F.col(f"_n{i}"), F.col(f"_c{i}")
        along = integer_div(size + chunk - 1, chunk)
        origins.append((rest % along) * chunk)
        rest = integer_div(rest, along)
    cells = F.lit(1).cast("bigint")
    for i, origin in enumerate(origins):
        cells = cells * F.least(F.col(f"_c{i}"), F.col(f"_n{i}") - origin)
    return numbered.select(
        *others, "slab_no", *[o.alias(f"origin_{i}") for i, o in enumerate(origins)], cells.alias("cells")
    )


def slab_bytes(cells: Column, type_sizes: list[Column | int]) -> tuple[list[Column], Column]:
    """Bytes of a slab per attribute and over all attributes; ``cells`` is clipped at the array's edge."""
    sizes = [s if isinstance(s, Column) else F.lit(s) for s in type_sizes]
    per_attr = [cells * s.cast("bigint") for s in sizes]
    total = per_attr[0]
    for more in per_attr[1:]:
        total = total + more
    return per_attr, total


def buffer_bytes(chunks: Column, type_sizes: list[Column | int]) -> tuple[list[Column], Column]:
    """Bytes that hold any slab of an array: whole chunks, not clipped at the edge.

    Readers and writers set aside this much per slab; ``slab_bytes`` is what a slab has.
    ``chunks`` is an ``array<bigint>`` of the chunk lengths.
    """
    return slab_bytes(_fold_product(chunks), type_sizes)


def array_size(
    arrays: DataFrame, dims: str = "dims", sizes: str = "type_sizes", gcount: str | None = None,
    pcount: str | None = None,
) -> DataFrame:
    """Rank, attribute count, element count and footprint per catalogue row.

    ``footprint = bytes * gcount * (elements + pcount)``.
    """
    elements = _fold_product(F.col(dims))
    width = F.aggregate(F.col(sizes), F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))
    groups = F.col(gcount).cast("bigint") if gcount else F.lit(1).cast("bigint")
    extra = F.col(pcount).cast("bigint") if pcount else F.lit(0).cast("bigint")
    return arrays.select(
        "*",
        F.size(dims).cast("bigint").alias("rank"),
        F.size(sizes).cast("bigint").alias("attr_count"),
        elements.alias("elements"),
        (width * groups * (elements + extra)).alias("footprint"),
    )


def dim_bounds(cells: DataFrame, dims: list[str], extendable: bool = False) -> DataFrame:
    """Bounds per dimension: ``min start end max chunk overlap``, one pass over the cells.

    The chunk is that of the default plan; ``extendable`` leaves the slowest
    dimension without an upper limit.
    """
    ends = [f(d).cast("bigint").alias(f"_{k}{i}") for i, d in enumerate(dims) for k, f in (("lo", F.min), ("hi", F.max))]
    extents = F.array(*[F.col(f"_hi{i}") - F.col(f"_lo{i}") + 1 for i in range(len(dims))])
    row = cells.agg(*ends).withColumn("_plan", chunk_plan_column(extents))

    def bounds(i, dim):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        limit = F.lit(UNLIMITED).cast("bigint") if extendable and i == 0 else high
        return F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(dim).alias("dim"),
            low.alias("min"),
            low.alias("start"),
            high.alias("end"),
            limit.alias("max"),
            F.get("_plan", i).alias("chunk"),
            F.lit(0).cast("bigint").alias("overlap"),
        )

    return row.select(F.inline(F.array(*[bounds(i, d) for i, d in enumerate(dims)])))


def dense_check(cells: DataFrame, dims: list[str]) -> DataFrame:
    """Cells, distinct coordinates, box size and whether each is present exactly once.

    The box reaches from 0 to the largest coordinates.  A cell with a negative or null
    coordinate has no place in it, so its array is not dense.  Copies of a coordinate merge
    map-side, so a hot coordinate stays small.
    """
    merged = cells.groupBy(*[F.col(d).cast("bigint").alias(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    sums = merged.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("cells"),
        F.count(F.lit(1)).alias("distinct_cells"),
        *[F.max(d).alias(f"_hi{i}") for i, d in enumerate(dims)],
        F.coalesce(F.bool_and(F.least(*[F.coalesce(F.col(d), F.lit(-1)) for d in dims], F.lit(0)) >= 0), F.lit(True)).alias("_placed"),
    )
    box = F.lit(1).cast("bigint")
    for i in range(len(dims)):
        box = box * (F.col(f"_hi{i}") + 1)
    checked = sums.select("cells", "distinct_cells", F.coalesce(box, F.lit(0)).alias("box_cells"), "_placed")
    dense = (F.col("cells") == F.col("distinct_cells")) & (F.col("cells") == F.col("box_cells")) & F.col("_placed")
    return checked.withColumn("dense", dense).drop("_placed")


def _words(rows: DataFrame, place: Column, *more: Column) -> DataFrame:
    """Places as words of 64 bits: ``_word``, ``_bits`` and further aggregates.

    Words are numbers, so they merge map-side in a hash aggregate, without a sort.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % WORD_BITS).cast("int"))
    return rows.groupBy(integer_div(place, WORD_BITS).alias("_word")).agg(F.bit_or(bit).alias("_bits"), *more)


def dense_check_box(cells: DataFrame, schema: ArraySchema) -> DataFrame:
    """The same check against a declared box, exchanging words of bits instead of cells.

    Cells set bits by row-major offset, 64 to a word, and words merge map-side.
    Stored arrays keep neighbours together, so a task sends one row per 64 cells.
    """
    dims, shape = schema.dim_names, schema.shape
    inside = F.lit(True)
    for dim, size in zip(dims, shape, strict=True):
        inside = inside & F.col(dim).between(0, size - 1)
    placed = cells.select(F.when(inside, linearize([F.col(d) for d in dims], shape)).alias("_place"))
    words = _words(placed, F.col("_place"), F.count("_place").alias("_in"), F.count(F.lit(1)).alias("_all"))
    total = F.lit(schema.cell_count).cast("bigint")
    sums = words.agg(
        F.coalesce(F.sum("_all"), F.lit(0)).cast("bigint").alias("cells"),
        F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("bigint").alias("distinct_cells"),
        F.coalesce(F.sum(F.col("_all") - F.col("_in")), F.lit(0)).cast("bigint").alias("outside"),
    ).withColumn("box_cells", total)
    dense = (F.col("cells") == total) & (F.col("distinct_cells") == total) & (F.col("outside") == 0)
    return sums.withColumn("dense", dense)


def holes(cells: DataFrame, dim: str) -> DataFrame:
    """Missing coordinates of a one-dimensional array, 0 to its largest coordinate.

    Present coordinates become words of 64 bits that merge map-side, so copies
    cost nothing and sparse coordinates one row each at most.  Only words that
    lack a bit are expanded.  A negative or null coordinate fails by name.
    """
    coord = F.col(dim).cast("bigint")
    wrong = F.raise_error(F.concat(F.lit(f"{dim} is negative or null: "), F.coalesce(coord.cast("string"), F.lit("null"))))
    rows = cells.select(F.when(F.coalesce(coord >= 0, F.lit(False)), coord).otherwise(wrong).alias("_coord"))
    present = _words(rows, F.col("_coord"))
    top = rows.agg(F.max("_coord").alias("_last"))
    parts = top.select("_last", (integer_div(F.col("_last"), WORD_BITS) + 1).alias("_words"))
    start = F.col("_word") * WORD_BITS
    expected = _spread_range(parts, "_words", "_word").select(
        "_word", F.least(F.lit(WORD_BITS).cast("bigint"), F.col("_last") + 1 - start).alias("_size")
    )
    found = F.coalesce(F.bit_count("_bits"), F.lit(0))
    short = expected.join(present, "_word", "left").where(found < F.col("_size"))
    places = F.sequence(F.lit(0), F.col("_size").cast("int") - 1)
    bits = F.coalesce("_bits", F.lit(0).cast("bigint"))
    missing = short.select("_word", F.explode(F.filter(places, lambda p: F.getbit(bits, p) == 0)).alias("_place"))
    return missing.select((start + F.col("_place")).alias(dim))
