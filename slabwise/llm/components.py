"""Connected components: forests within tasks, then alternating stars, cut off from their history."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabwise.llm.common import cut, prepare

#: Nodes that a task connects before it passes them on.
FOREST_NODES = 1_000_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: every node with the smallest it is connected to here."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def stars() -> pa.RecordBatch:
        found = [(x, r) for x in root if (r := find(x)) != x]
        return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([r for _, r in found], pa.int64())})

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            low, high = sorted((find(a), find(b)))
            root[high] = low
        if len(root) > FOREST_NODES:  # what is passed on here connects with the rest later
            yield stars()
            root.clear()
    yield stars()


def _star_rounds(edges: DataFrame) -> DataFrame:
    """Links of every node to the smallest of its component, by alternating stars."""
    state, seen = cut(edges.where("a <> b").distinct()), None
    while True:
        now = state.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
        if now == seen or not now["n"]:
            return state
        seen = now
        state = cut(_small_star(_large_star(state)))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component, for every node of ``edges(a, b)``.

    A link from a node to itself adds nothing; nodes without another link have no row.
    Tasks join their links to forests, and once more where all links of a node meet: then
    nearly every node has one link, to a root.  Only roots that are linked among themselves
    go through the rounds of stars, whose number grows with the logarithm of the longest
    path; only two numbers a round reach the driver.
    """
    prepare(edges.sparkSession)
    tasks = max(1, edges.sparkSession.sparkContext.defaultParallelism)
    links = edges.select("a", "b").where("a <> b").coalesce(tasks)
    met = links.mapInArrow(_forest, "a long, b long").repartition("a").mapInArrow(_forest, "a long, b long")
    # A node has more than one link only where a task passed forests on before its end.
    stars = met.groupBy("a").agg(F.array_sort(F.collect_set("b")).alias("bs"))
    held = cut(stars.select("a", F.col("bs")[0].alias("b"), F.slice("bs", F.lit(2), F.size("bs")).alias("more")))
    roots = held.select(F.col("b").alias("root")).distinct()
    upper = held.join(roots, F.col("a") == F.col("root"), "left_semi").select("a", "b")
    top = _star_rounds(upper.unionByName(held.select(F.explode("more").alias("a"), "b"))).toDF("root", "component")
    found = held.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.join(held.select("a"), F.col("a") == F.col("root"), "left_anti").select(F.col("root").alias("node"), "root")
    )
    return found.join(top, "root", "left").select("node", F.coalesce("component", "root").alias("component"))
